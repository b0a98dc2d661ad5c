"""Best-fit packing of documents into sequences of a fixed number of tokens.

Each document's ids, with the end id, are cut into pieces of at most a sequence's length; only the
first piece of a long document is shorter. Pieces are dealt by hash into buckets whose number
follows the total of tokens, so that a bucket is a bounded piece of work; pieces that are equal in
all that is hashed, as of repeated rows, are told apart by task and number in it. Within a bucket, pieces
arrive in hash order and bounded-space online best-fit places them: a fixed number of open
sequences, in a bitset keyed by free space; a piece goes to the fullest open sequence that takes
it; if none does, a new one is opened, for which the fullest open one closes when all are in use.

Defined cases: a null or empty text is the end id alone; null doc_ids and repeated rows are packed
like any others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postern.llm.common import written
from postern.llm.tokens import encoder, give_back

LENGTH = 1024
OPEN = 2048
#: Full sequences that a bucket holds on the mean. What stays half empty when a bucket ends is a
#: few sequences, below a thousandth of them.
BUCKET = 4096
#: Pieces that a task remembers to find those equal to earlier ones.
KNOWN = 1 << 16
#: Characters that a task encodes at a time; the pipeline's executors have little memory left.
CUT = 2_000_000


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids."""
    first = n % length
    starts = ([0] if first else []) + list(range(first, n, length))
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], n], strict=True)]


def best_fit(lengths: list[int], length: int = LENGTH, n_open: int = OPEN) -> list[tuple[int, int]]:
    """For each piece in order its sequence (from 0) and its offset there."""
    free_mask = 0  # bit f: some open sequence has f tokens free
    by_free: dict[int, list[int]] = {}
    count = opened = 0
    out = []
    for size in lengths:
        fits = free_mask >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            own = by_free[free]
            sequence = own.pop()
            if not own:
                free_mask ^= 1 << free
            opened -= 1
        else:
            if opened == n_open:
                fullest = (free_mask & -free_mask).bit_length() - 1
                by_free[fullest].pop()
                if not by_free[fullest]:
                    free_mask ^= 1 << fullest
                opened -= 1
            sequence, free, count = count, length, count + 1
        out.append((sequence, length - free))
        if free > size:
            by_free.setdefault(free - size, []).append(sequence)
            free_mask |= 1 << (free - size)
            opened += 1
    return out


def pieces(docs: DataFrame, tokenizer: str, kind: str, end_id: int, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """The pieces of every whole text: doc_id, piece, start, length, CRC-32 of the ids as unsigned
    32-bit integers, ``_copy`` and with ``with_ids`` the ids. ``_copy`` is 0 for a piece that its task
    has not met before, else a number of its own; it is fixed only when the pieces are written."""
    end = np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "_copy"] + ["ids"] * with_ids
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, kind)
        task, count = TaskContext.get().partitionId() << 33, 0
        known: set[tuple] = set()
        for batch in batches:
            rows = []
            texts = own.encode(batch.column(1), CUT)
            for doc_id, raw in zip(batch.column(0).to_pylist(), texts, strict=True):
                raw += end
                for i, (start, n) in enumerate(cut(len(raw) // 4, length)):
                    cut_out = raw[4 * start : 4 * (start + n)]
                    row = (doc_id, i, start, zlib.crc32(cut_out))
                    count += 1
                    copy = task + count if row in known else 0
                    if len(known) >= KNOWN:
                        known.clear()
                    known.add(row)
                    rows.append([*row[:3], n, row[3], copy] + [np.frombuffer(cut_out, "<u4").tolist()] * with_ids)
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )
            give_back()

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, _copy long"
    return docs.select("doc_id", "text").mapInArrow(run, schema + ", ids array<bigint>" * with_ids)


def pack(cut_up: DataFrame, length: int = LENGTH, n_open: int = OPEN) -> DataFrame:
    """Add sequence_id and offset to rows of ``pieces``, which must be written."""
    total = cut_up.agg(F.sum("length")).first()[0] or 0
    buckets = max(1, round(total / (length * BUCKET)))
    placed = cut_up.drop("_copy")
    columns = placed.columns
    mixed = F.xxhash64("doc_id", "piece", "start", "ids_crc32", "_copy")

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["_order", "doc_id", "piece"], kind="stable")
        places = best_fit(frame["length"].tolist(), length, n_open)
        bucket = int(frame["_bucket"].iloc[0])
        frame["sequence_id"] = [(bucket << 32) + s for s, _ in places]
        frame["offset"] = [o for _, o in places]
        return frame[[*columns, "sequence_id", "offset"]]

    dealt = cut_up.withColumn("_order", mixed).drop("_copy").withColumn("_bucket", F.expr(f"pmod(_order, {buckets})"))
    inner = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in placed.schema)
    return dealt.groupBy("_bucket").applyInPandas(place, f"{inner}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, kind: str, end_id: int) -> DataFrame:
    """All documents packed; pieces are written once, so that texts are encoded once."""
    return pack(written(pieces(docs, tokenizer, kind, end_id), "pieces"))


def sequences(docs: DataFrame, tokenizer: str, kind: str, end_id: int) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (at most LENGTH), and the pieces they hold as
    (offset, length, doc_id, piece)."""
    packed = pack(written(pieces(docs, tokenizer, kind, end_id, with_ids=True), "pieces"))
    part = F.struct("offset", "length", "doc_id", "piece", "ids")
    ordered = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    names = ("offset", "length", "doc_id", "piece")
    return ordered.select(
        "sequence_id",
        F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"),
        F.transform("parts", lambda p: F.struct(*[p[n].alias(n) for n in names])).alias("pieces"),
    )
