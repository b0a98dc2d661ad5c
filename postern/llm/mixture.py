"""Mixing sources to target weights.

Each source's documents, in doc_id order, are one stream of words, packed into blocks of a fixed
number of words: 64, or fewer for a source of fewer than 64 times as many words, so that rounding to
blocks keeps near its target (a source's last block may be shorter). A source draws as many slots as its target
needs; its slots fall on output shards by a seeded hash, so its counts over the shards are one
multinomial draw with the target as its fixed total. A slot's number, within its pass over the
source, goes through a pseudorandom permutation of the source's block numbers (a Feistel network,
walked until it stays below the number of blocks), which names the block it takes: no two slots of
a pass take the same block. Slots and blocks are then joined by block number. Everything follows
from the seed, so reruns agree, and neither a hot source nor a long document meets in one task.

Targets: sources by code point, null last, weigh 5, 2, 1, repeating, and share 150% of all words;
no target exceeds twice its source's words, and the excess is shared again by weight.

Defined cases: a null or empty text has size 0 and is never taken; a null source is a source; null
doc_ids come first in their source; repeated rows are documents of their own; an empty table, or
one without any words, gives targets of 0; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postern.llm.common import NOT_SPACE, ROW_KEY, set_aside, with_row_key, with_starts, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK = 64
SEED = 42
#: Slots of an output shard, and slots that one row of the slot plan stands for.
SHARD, CHUNK = 8192, 65_536


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and a row number of every document, from a written table."""
    counted = docs.select(
        "doc_id",
        "source",
        F.expr(f"coalesce(regexp_count(text, r'{NOT_SPACE}'), 0)").cast("long").alias("size"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
    )
    return written(counted.withColumn("row", F.monotonically_increasing_id()), "sizes")


def targets(sized: DataFrame) -> DataFrame:
    """A row per source: source_no (rank from 0), source, source_size, weight, target, block.

    Sharing again takes a round for each set of sources that newly reach their limit; a round
    brings one row, the two sums, to the driver."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Null is last: a flag sorts before the name. Strings sort by UTF-8 bytes, that is code points.
    ranked = with_starts(
        totals.withColumn("_null", F.col("source").isNull().cast("int")).withColumn("_one", F.lit(1)),
        "_one",
        ["_null", "source"],
        start="source_no",
    )
    weight = F.element_at(
        F.array(*map(F.lit, WEIGHTS)), (F.col("source_no") % len(WEIGHTS) + 1).cast("int")
    )
    rows = written(
        ranked.select("source_no", "source", "source_size", weight.alias("weight")), "sources"
    )
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    wanted, per_weight = SHARE * total, 0.0
    full = F.lit(False)
    while True:
        # Limits only rise above a share that grows, so full sources stay full.
        at_limit, weights = rows.agg(
            F.sum(F.when(full, MOST * F.col("source_size")).otherwise(0)),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))),
        ).first()
        if not weights:
            break
        per_weight = (wanted - at_limit) / weights
        now_full = F.col("weight") * F.lit(per_weight) > MOST * F.col("source_size")
        if not rows.filter(now_full & ~full).take(1):
            break
        full = full | now_full
    target = F.when(full, (MOST * F.col("source_size")).cast("double")).otherwise(
        F.col("weight") * F.lit(per_weight)
    )
    short = F.greatest(F.lit(1), F.expr("source_size div 64"))
    return rows.withColumn("target", target).withColumn("block", F.least(F.lit(BLOCK), short))


def placed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """``sized`` with source_no, source_size, target, block and start, a document's place in its source's
    stream. The table of sources is joined by size: Spark broadcasts it only if small."""
    starts = with_starts(sized, "size", ["doc_id", "text_hash", "row"], group="source")
    names = sources.withColumnRenamed("source", "_source")
    return starts.join(names, starts["source"].eqNullSafe(names["_source"])).drop("_source")


def _mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """The places of ``index`` under a pseudorandom permutation of 0..n-1 given by ``key``."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = _mix(np.arange(1, 5, dtype=np.uint64) + np.uint64(key % (1 << 62)))
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & mask
        for k in keys:
            left, right = right, left ^ (_mix(right ^ k) & mask)
        out[todo] = (left << shift) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def slots(sources: DataFrame, seed: int = SEED) -> DataFrame:
    """Every drawn slot: its output shard, the slot (its number in a pass over the source), source_no,
    pass (0 or 1) and the block_no that it takes."""
    n_blocks = F.ceil(F.col("source_size") / F.col("block"))
    drawn = F.least(
        F.round(F.col("target") * n_blocks / F.col("source_size")), MOST * n_blocks
    ).cast("long")
    plan = sources.filter("source_size > 0").select(
        "source_no", n_blocks.alias("n_blocks"), drawn.alias("n_slots")
    )
    total = plan.agg(F.sum("n_slots")).first()[0] or 0
    n_shards = max(1, -(-total // SHARD))
    passes = plan.withColumn(
        "pass", F.explode(F.sequence(F.lit(0), F.lit(MOST - 1)))
    ).withColumn("n", F.least(F.col("n_slots") - F.col("pass") * F.col("n_blocks"), F.col("n_blocks")))
    chunks = (
        passes.filter("n > 0")
        .withColumn("from", F.explode(F.expr(f"sequence(0L, n - 1, {CHUNK}L)")))
        .withColumn("to", F.expr(f"least(n, from + {CHUNK})"))
        .repartition("source_no", "pass", "from")
    )

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                at = np.arange(r["from"], r["to"])
                key = int(_mix(np.array([seed * 1_000_003 + 2 * r["source_no"] + r["pass"]], np.uint64))[0])
                with np.errstate(over="ignore"):
                    falls = _mix(at.astype(np.uint64) + np.uint64(key))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at), r["source_no"])),
                        pa.array(np.full(len(at), r["pass"], np.int32)),
                        pa.array(permuted(at, r["n_blocks"], key)),
                        pa.array((falls % np.uint64(n_shards)).astype(np.int64)),
                        pa.array(at),
                    ],
                    ["source_no", "pass", "block_no", "shard", "slot"],
                )

    return chunks.select("source_no", "n_blocks", "pass", "from", "to").mapInArrow(
        draw, "source_no long, pass int, block_no long, shard long, slot long"
    )


def blocks(documents: DataFrame) -> DataFrame:
    """The parts of documents in blocks: row, source_no, block_no and the part's words
    [word_from, word_to), counted in the document."""
    return (
        documents.filter("size > 0")
        .withColumn(
            "block_no",
            F.explode(F.expr("sequence(start div block, (start + size - 1) div block)")),
        )
        .select(
            "row",
            "source_no",
            "block_no",
            F.greatest(F.lit(0), F.expr("block_no * block - start")).alias("word_from"),
            F.least(F.col("size"), F.expr("(block_no + 1) * block - start")).alias("word_to"),
        )
    )


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target of its source, and taken, the words that the mix takes."""
    sized = sizes(docs)
    sources = written(targets(sized), "targets")
    documents = written(placed(sized, sources), "placed")
    times = slots(sources).groupBy("source_no", "block_no").agg(F.count("*").alias("times"))
    taken = (
        blocks(documents)
        # Slots come from a table of a few rows, so Spark takes them for few too.
        .join(times.hint("merge"), ["source_no", "block_no"])
        .groupBy("row")
        .agg(F.sum(F.expr("times * (word_to - word_from)")).alias("taken"))
    )
    return documents.join(taken, "row", "left").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each pass in which a document has
    words taken, its text cut to the blocks taken (neighbouring blocks keep the white space
    between them, others are joined by a line end) and n_chars, if there, counted anew."""
    rows, back = set_aside(docs, "doc_id", "source", "text", "n_chars")
    sized = sizes(rows)
    sources = written(targets(sized), "targets")
    documents = written(placed(sized, sources), "placed")
    parts = (
        blocks(documents)
        .join(slots(sources).hint("merge"), ["source_no", "block_no"])
        .groupBy("row", "pass")
        .agg(F.array_sort(F.collect_list(F.struct("word_from", "word_to"))).alias("_parts"))
    )
    # Rows that agree in doc_id and text are told apart by a number; they have the same source, or
    # else the words of one stand for those of the other.
    chosen = (
        documents.withColumn("_null", F.col("doc_id").isNull())
        .withColumn("_id", F.coalesce("doc_id", F.lit(0)))
        .withColumn("_hash", F.col("text_hash"))
        .withColumn("_copy", F.row_number().over(Window.partitionBy(*ROW_KEY).orderBy("row")))
        .join(parts, "row")
        .select(*ROW_KEY, "_copy", "_parts")
    )
    numbered = with_row_key(rows).withColumn(
        "_copy", F.row_number().over(Window.partitionBy(*ROW_KEY).orderBy(F.lit(0)))
    )
    cut = numbered.join(chosen, [*ROW_KEY, "_copy"]).withColumn(
        "text", _cut_text()(F.col("text"), F.col("_parts"))
    )
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.char_length("text").cast(kind))
    return back(cut)


def shards(docs: DataFrame) -> DataFrame:
    """The mix as output shards: a row for each slot, with its shard, source_no, pass, slot, block_no and
    the block's words, joined by spaces. Parts of documents are cut out where the texts are read and
    meet by block, so a block, never a source or a shard, is what one group holds."""
    rows = docs.select("doc_id", "source", "text").withColumn("row", F.monotonically_increasing_id())
    numbered = written(rows, "numbered")
    counted = numbered.select(
        "doc_id",
        "source",
        F.expr(f"coalesce(regexp_count(text, r'{NOT_SPACE}'), 0)").cast("long").alias("size"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        "row",
    )
    sources = written(targets(counted), "targets")
    documents = placed(counted, sources).select("row", "source_no", "start", "block")
    words = F.expr(f"regexp_extract_all(text, r'{NOT_SPACE}', 0)")
    drawn = slots(sources)
    cut = (
        numbered.select("row", words.alias("words"))
        .filter(F.size("words") > 0)
        .join(documents, "row")
        .withColumn("block_no", F.explode(F.expr("sequence(start div block, (start + size(words) - 1) div block)")))
        .withColumn("from", F.greatest(F.lit(0), F.expr("block_no * block - start")))
        .withColumn("n", F.least(F.size("words"), F.expr("(block_no + 1) * block - start")) - F.col("from"))
        .select(
            "source_no",
            "block_no",
            F.struct("start", "row", F.expr("slice(words, CAST(from + 1 AS INT), CAST(n AS INT))").alias("words")).alias("part"),
        )
    )
    parts = cut.groupBy("source_no", "block_no").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    joined = F.array_join(F.flatten(F.transform("parts", lambda p: p["words"])), " ")
    return drawn.hint("merge").join(parts, ["source_no", "block_no"]).select(
        "shard", "source_no", "pass", "slot", "block_no", joined.alias("words")
    )


def write_shards(docs: DataFrame, folder: str) -> None:
    """``shards`` as a table with a folder per shard, in the order of sources, passes and slots."""
    order = ["shard", "source_no", "pass", "slot"]
    ranged = shards(docs).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.write.partitionBy("shard").parquet(folder)


def _cut_text():
    """The words of parts [(from, to)] of each text, as an Arrow function."""

    @F.udf("string", useArrow=True)
    def cut(text: str, parts: list) -> str:
        import re

        words = [m.span() for m in re.finditer(NOT_SPACE, text)]
        out, last = [], None
        for part in parts:
            start, end = part["word_from"], part["word_to"]
            if start == last:
                out.append(text[words[start - 1][1] : words[end - 1][1]])
            else:
                out.append("\n" * (last is not None) + text[words[start][0] : words[end - 1][1]])
            last = end
        return "".join(out)

    return cut
