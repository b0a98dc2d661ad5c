"""Secret scan with a trigram inverted index, in DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived: alternatives of sets
of trigrams, all of a set being in every text that matches that way. The index holds, for each
trigram that any query asks for, the documents whose lower-cased text has it. Postings are
intersected by counting, per document and set, the trigrams found; where all are there, the
document is a candidate of the rule. Candidates are verified by the regular expression itself, on
the whole text. A rule without mandatory trigrams (long hexadecimal numbers) scans every text.

Spans are matches from the left that don't overlap, rule by rule; those too short are dropped.
Positions count code points, the end is exclusive.

Defined cases: a null text is empty and has no spans; null doc_ids and repeated rows are scanned
like any others; an empty table gives an empty result; other columns are ignored or, in
``redact``, kept.
"""

from __future__ import annotations

import itertools
import re._constants as op
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postern.llm.common import ROW_KEY, set_aside, with_row_key


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: The group whose length counts, and its least number of characters.
    group: int
    least: int


#: In the order of their kinds. Patterns mean the same in Java, RE2 and Python.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # At least 32 in the pattern itself: a run that is too short is no match to be dropped later.
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}", 0, 39),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}", 0, 24),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 27),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}[.]eyJ[A-Za-z0-9_-]{10,}[.][A-Za-z0-9_-]{10,}", 0, 38),
)
RULES = BASE + MORE

#: A query keeps at most so many strings, or sets of trigrams, in hand while it is derived; beyond
#: that it asks for less, which makes more candidates but loses none.
MOST_STRINGS, MOST_SETS = 64, 32

Query = frozenset  # of frozensets of trigrams: one of the sets must be there whole
ALWAYS: Query = frozenset([frozenset()])


def _all_of(a: Query, b: Query) -> Query:
    """Both queries hold."""
    out = frozenset(x | y for x in a for y in b)
    return out if len(out) <= MOST_SETS else min(a, b, key=len)


def _trigrams(strings: set[str]) -> Query:
    sets = frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)
    return ALWAYS if frozenset() in sets or len(sets) > MOST_SETS else sets


def _derive(items) -> tuple[set[str] | None, Query]:
    """Of a sequence: all strings it matches (lower case; None if not a few), and its query."""
    strings, query, whole = {""}, ALWAYS, True
    for kind, value in items:
        own, needs = _derive_item(kind, value)
        if own is not None and len(strings) * len(own) <= MOST_STRINGS:
            strings = {a + b for a, b in itertools.product(strings, own)}
            continue
        # The strings so far end here; what follows starts anew.
        query = _all_of(_all_of(query, _trigrams(strings)), needs)
        strings, whole = own or {""}, False
    if whole:
        return strings, _trigrams(strings)
    return None, _all_of(query, _trigrams(strings))


def _derive_item(kind, value) -> tuple[set[str] | None, Query]:
    if kind is op.LITERAL:
        return {chr(value).lower()}, ALWAYS
    if kind is op.IN:
        out: set[str] = set()
        for k, v in value:
            if k is op.LITERAL:
                out.add(chr(v).lower())
            elif k is op.RANGE and v[1] - v[0] < 8:
                out |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None, ALWAYS
        return out, ALWAYS
    if kind is op.SUBPATTERN:
        return _derive(value[3])
    if kind is op.BRANCH:
        found = [_derive(b) for b in value[1]]
        if all(s is not None for s, _ in found):
            return set().union(*[s for s, _ in found]), ALWAYS
        query = frozenset().union(*[q if s is None else _trigrams(s) for s, q in found])
        return None, ALWAYS if frozenset() in query else query
    if kind is op.MAX_REPEAT:
        least, most, inner = value
        own, needs = _derive(inner)
        if own is not None and most <= 1:
            return own | {""} if least == 0 else own, ALWAYS
        if own is not None and least == most and len(own) ** least <= MOST_STRINGS:
            return {"".join(x) for x in itertools.product(own, repeat=least)}, ALWAYS
        return None, needs if least else ALWAYS
    return None, ALWAYS


def trigram_query(pattern: str) -> list[list[str]] | None:
    """The sets of trigrams one of which every matching text (lower-cased) has whole; None if the
    pattern has no mandatory trigrams."""
    _, query = _derive(parser.parse(pattern))
    if frozenset() in query:
        return None
    least = [s for s in query if not any(t < s for t in query)]
    return sorted(sorted(s) for s in least)


def postings(keyed: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index: ROW_KEY and trigram for each of ``trigrams`` that a text has."""
    low = keyed.select(*ROW_KEY, F.lower(F.col("text")).alias("_low"))
    found = F.array_compact(
        F.array(*[F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in trigrams])
    )
    return low.select(*ROW_KEY, F.explode(found).alias("trigram"))


def candidates(keyed: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """ROW_KEY and _rules, a bit for each rule whose query the text meets."""
    asked = [
        (number, part, trigram, len(some))
        for number, rule in enumerate(rules)
        for part, some in enumerate(trigram_query(rule.pattern) or [])
        for trigram in some
    ]
    spark = keyed.sparkSession
    # As many rows as the rules have trigrams, whatever the corpus.
    queries = spark.createDataFrame(asked, "rule int, part int, trigram string, needs int")
    index = postings(keyed, sorted({t for _, _, t, _ in asked}))
    met = (
        index.join(F.broadcast(queries), "trigram")
        .groupBy(*ROW_KEY, "rule", "part", "needs")
        .agg(F.count_distinct("trigram").alias("n"))
        .filter("n = needs")
    )
    return met.groupBy(*ROW_KEY).agg(F.bit_or(F.expr("shiftleft(1L, rule)")).alias("_rules"))


def _spans(rule: Rule, number: int) -> Column:
    """The rule's spans in column text: an array of (start, rule, end)."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    between = F.split(text, rule.pattern, -1)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    sized = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    rows = F.arrays_zip(
        F.transform(between, F.char_length).alias("gap"),
        F.transform(matches, F.char_length).alias("size"),
        F.transform(sized, F.char_length).alias("own"),
    )
    none = F.array().cast("array<struct<start:int,rule:int,end:int>>")

    def step(state: Column, row: Column) -> Column:
        start = state["at"] + row["gap"]
        end = start + F.coalesce(row["size"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(number).alias("rule"), end.alias("end"))
        grown = F.when(row["own"] >= rule.least, F.concat(state["spans"], F.array(span)))
        return F.struct(end.alias("at"), grown.otherwise(state["spans"]).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.aggregate(rows, begin, step, lambda state: state["spans"])


def with_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` (doc_id, text and others) plus _spans: all rules' spans by start, then rule."""
    keyed = with_row_key(docs)
    found = keyed.join(candidates(keyed, rules), ROW_KEY, "left")
    none = F.array().cast("array<struct<start:int,rule:int,end:int>>")
    parts = []
    for number, rule in enumerate(rules):
        spans = _spans(rule, number)
        if trigram_query(rule.pattern):
            asked = F.col("_rules").bitwiseAND(F.lit(1 << number)) != 0
            spans = F.when(asked, spans).otherwise(none)
        parts.append(F.coalesce(spans, none))
    return found.withColumn("_spans", F.array_sort(F.concat(*parts))).drop(*ROW_KEY, "_rules")


def _listed(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.concat_ws(
        ",",
        F.transform(
            spans, lambda s: F.concat_ws(":", kinds[s["rule"]], s["start"].cast("string"), s["end"].cast("string"))
        ),
    )


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, counts of the base kinds, hash of the base spans, and all spans as text."""
    found = with_spans(docs.select("doc_id", "text"), rules)
    count = lambda i: F.size(F.filter("_spans", lambda s: s["rule"] == i)).cast("long")
    base = F.filter("_spans", lambda s: s["rule"] < len(BASE))
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)],
        F.sha2(_listed(base, rules), 256).alias("base_sha256"),
        _listed(F.col("_spans"), rules).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every span (overlapping ones joined) replaced by ``mark`` and n_chars, if
    there, counted anew; all rows and columns stay."""
    rows, back = set_aside(docs, "doc_id", "text", "n_chars")

    def step(state: Column, span: Column) -> Column:
        apart = span["start"] >= state["at"]
        gap = F.substring(F.col("text"), state["at"] + 1, span["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(apart, F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"]).alias("out"),
        )

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def rest(state: Column) -> Column:
        return F.concat(state["out"], F.substring(F.col("text"), state["at"] + 1, F.char_length("text")))

    clean = F.when(F.size("_spans") > 0, F.aggregate("_spans", begin, step, rest)).otherwise(F.col("text"))
    out = with_spans(rows).withColumn("text", clean)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        counted = F.when(F.size("_spans") > 0, F.char_length("text").cast(kind))
        out = out.withColumn("n_chars", counted.otherwise(F.col("n_chars")))
    return back(out)
