"""Quality rules with adaptive thresholds.

Each document gets integer measures. Their distribution per language and source is kept in
mergeable quantile sketches: counts of values rounded down to their six leading binary digits, so
two sketches merge by adding counts and every quantile is at most 1/32 below the true one. The
sketches give fences per measure, around the median and as wide as the half of the documents that
junk does not reach: an upper fence by the lower quartile, a lower one by the upper quartile; so a
third of junk hardly moves them. A group's fences are the narrowest of its own, its language's and
the whole corpus's, so a group can't excuse what is far from all others by having much of it.
Documents beyond a fence, or failing the fixed base rules, are not kept. All arithmetic is on
integers, so reruns agree.

Defined cases: a null text has no words; null languages and sources form groups of their own;
repeated rows count each; a value on a fence is inside; very long texts are counted whole, in memory
of their own size; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from postern.llm.common import NOT_SPACE, set_aside, written
from postern.llm.tokens import give_back

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]

#: Measures per mille, or hundredths of a character, and the least half-spreads above and below the
#: median that a group is taken to have (None: no fence on that side), so that a group of documents
#: that are all alike doesn't reject slight differences.
MEASURES = {
    "symbol_rate": ("1000 * n_symbols div greatest(word_chars, 1)", 20, None),
    "dup_line_rate": ("1000 * n_dup_lines div greatest(n_lines, 1)", 90, None),
    "repeat_rate": ("1000 * n_repeat_words div greatest(n_words, 1)", 90, None),
    "word_length": ("100 * word_chars div greatest(n_words, 1)", 150, 60),
}
#: A fence lies this many spreads (twice the distance of median and quartile) from the median.
FENCE = 4
#: Groups and languages of fewer documents have no fences of their own.
MIN_GROUP = 50
#: Leading binary digits that the sketch keeps.
DIGITS = 6


def text_counts(text: str | None) -> tuple[int, ...]:
    """COUNTS of a whole text."""
    if not text:
        return (0,) * len(COUNTS)
    words = re.findall(NOT_SPACE, text)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    symbols = sum(text.count(c) for c in SYMBOLS)
    repeated = 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        covered = bytearray(len(words))
        for i, window in enumerate(windows):
            if times[window] > 1:
                covered[i : i + 3] = b"\1\1\1"
        repeated = sum(covered)
    return (
        len(words),
        sum(map(len, words)),
        symbols,
        len(lines),
        len(lines) - len(set(lines)),
        repeated,
    )


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus a struct ``_counts`` of COUNTS."""
    kept = docs.columns
    fields = [pa.field(name, pa.int64()) for name in COUNTS]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_counts(x.as_py()) for x in batch.column(batch.schema.get_field_index(text))]
            columns = list(zip(*rows, strict=True)) or [()] * len(COUNTS)
            counts = pa.StructArray.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], fields=fields
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, counts], [*kept, "_counts"])
            give_back()

    counts = StructType([StructField(c, LongType()) for c in COUNTS])
    return docs.mapInArrow(count, StructType([*docs.schema.fields, StructField("_counts", counts)]))


def _measured(counted: DataFrame) -> DataFrame:
    """Columns of COUNTS and MEASURES, and whether the base rules fail."""
    out = counted.select("*", *[F.col(f"_counts.{c}").alias(c) for c in COUNTS]).drop("_counts")
    for name, (measure, *_) in MEASURES.items():
        out = out.withColumn(name, F.expr(measure))
    return out.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


def sketches(measured: DataFrame) -> DataFrame:
    """Mergeable sketches: rows (lang, source, measure, value, n), added up to merge."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("measure"), F.col(name).alias("value"))
            for name in MEASURES
        ]
    )
    low = f"greatest(length(bin(value)) - {DIGITS}, 0)"
    return (
        measured.filter(~F.col("base_failed"))
        .select("lang", "source", F.inline(pairs))
        .withColumn("value", F.expr(f"shiftleft(shiftright(value, {low}), {low})"))
        .groupBy("lang", "source", "measure", "value")
        .agg(F.count("*").alias("n"))
    )


def _level(sketch: DataFrame, group: list[str]) -> DataFrame:
    """The fences (``most``, ``least``) of each group and measure from its merged sketch."""
    merged = sketch.groupBy(*group, "measure", "value").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*group, "measure")
    upto = whole.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged.select(
        *group,
        "measure",
        "value",
        F.sum("n").over(upto).alias("upto"),
        F.sum("n").over(whole).alias("total"),
    )
    reached = lambda q: F.min(F.when(4 * F.col("upto") >= q * F.col("total"), F.col("value")))
    quartiles = ranked.groupBy(*group, "measure").agg(
        reached(1).alias("q1"), reached(2).alias("q2"), reached(3).alias("q3"), F.max("total").alias("n")
    )
    floors = lambda i: F.create_map(
        *[x for m, spec in MEASURES.items() for x in (F.lit(m), F.lit(spec[i]).cast("long"))]
    )[F.col("measure")]
    above, below = F.col("q2") - F.col("q1"), F.col("q3") - F.col("q2")
    known = F.lit(True) if not group else F.col("n") >= MIN_GROUP
    most = F.col("q2") + FENCE * F.greatest(2 * above, floors(1))
    least = F.when(floors(2).isNotNull(), F.col("q2") - FENCE * F.greatest(2 * below, floors(2)))
    return quartiles.select(
        *group, "measure", F.when(known, most).alias("most"), F.when(known, least).alias("least")
    )


def fences(sketch: DataFrame) -> DataFrame:
    """A row for each lang and source, columns for each measure's upper (and lower) fence. Groups
    whose documents all fail the base rules have no row."""
    own = _level(sketch, ["lang", "source"])
    named = lambda df, by: df.withColumnsRenamed({c: f"_{by}_{c}" for c in df.columns})
    wide, all_ = named(_level(sketch, ["lang"]), "lang"), named(_level(sketch, []), "all")
    levels = own.join(
        wide, own["lang"].eqNullSafe(wide["_lang_lang"]) & (own["measure"] == wide["_lang_measure"])
    ).join(all_, own["measure"] == all_["_all_measure"])
    narrowest = levels.select(
        "lang",
        "source",
        "measure",
        F.least("most", "_lang_most", "_all_most").alias("most"),
        F.greatest("least", "_lang_least", "_all_least").alias("least"),
    )
    of = lambda m, c: F.max(F.when(F.col("measure") == m, F.col(c)))
    return narrowest.groupBy("lang", "source").agg(
        *[of(m, "most").alias(f"max_{m}") for m in MEASURES],
        *[of(m, "least").alias(f"min_{m}") for m, (*_, low) in MEASURES.items() if low is not None],
    )


def _judged(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """Join each document to its group's fences; ``kept`` is the verdict. The groups' table is a
    row per language and source; Spark broadcasts it only below its own size threshold, and splits
    a hot group otherwise."""
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = measured.join(
        limits,
        measured["lang"].eqNullSafe(limits["_lang"])
        & measured["source"].eqNullSafe(limits["_source"]),
        "left",
    )
    inside = F.lit(True)
    for m, (*_, low) in MEASURES.items():
        inside = inside & F.coalesce(F.col(m) <= F.col(f"max_{m}"), F.lit(True))
        if low is not None:
            inside = inside & F.coalesce(F.col(m) >= F.col(f"min_{m}"), F.lit(True))
    return joined.withColumn("kept", ~F.col("base_failed") & inside)


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, counts, measures, fences and verdict of every row of ``docs``."""
    slim = docs.select("doc_id", "lang", "source", "text")
    counted = written(with_counts(slim).drop("text"), "quality-counts")
    measured = _measured(counted)
    return _judged(measured, written(fences(sketches(measured)), "quality-fences"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, all columns. The texts are counted twice, once
    for the sketches and once beside the text for the verdict, instead of being shuffled."""
    slim = docs.select("lang", "source", "text")
    measured = _measured(with_counts(slim).drop("text"))
    limits = written(fences(sketches(measured)), "quality-fences")
    rows, back = set_aside(docs, "lang", "source", "text")
    return back(_judged(_measured(with_counts(rows)), limits).filter("kept"))
