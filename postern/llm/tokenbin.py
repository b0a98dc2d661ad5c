"""Token ids as flat binary files.

The file format. A dataset is a folder with ``tokens-*.bin`` files, each nothing but unsigned
little-endian integers (16 bits if every id fits, else 32), one document's ids after the other in
ascending doc_id order; and beside each an ``.idx`` file:

    8 bytes   magic ``TOKENIDX``
    8 bytes   bytes of one id (2 or 4)
    8 bytes   n, the number of documents
    n+1 x 8   offsets of the documents in the .bin file, counted in ids; the last is its length
    n x 8     doc_ids (0 where null)
    n bytes   1 where the doc_id is not null

all unsigned or signed 64-bit little-endian. The ``manifest`` table has a row per file with its
number of documents and ids and its base, the number of ids in all files before it, which is the
prefix sum over files. Files are range partitions of doc_id, so no task sees more than its range.
A task names its files by its attempt, and the manifest lists those of the attempts that counted.

Defined cases: a null or empty text has the end id alone; a null doc_id comes before all others;
rows that share a doc_id follow each other in the order of their texts (from the 65th character on,
of a hash of them) and may lie in several files; very long texts are encoded whole; an empty table gives a dataset without files; other
columns are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postern.llm.files import new_file, opened
from postern.llm.tokens import encoder

MAGIC = b"TOKENIDX"
FILE = "part int, file string, n_docs long, n_tokens long"


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, kind: str, end_id: int, vocabulary: int) -> DataFrame:
    """Encode every text of ``docs`` (doc_id, text), append ``end_id``, write the dataset to
    ``folder``, and return its manifest. ``vocabulary``: all ids are below it."""
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, ids = [0], []
        name = f"{folder}/tokens-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:8]}"
        out = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                out = new_file(f"{name}.bin")
                sink = out.__enter__()
            ids += batch.column(0).to_pylist()
            for raw in encoder(tokenizer, kind).encode(batch.column(1)):
                found = np.frombuffer(raw + end, "<u4")
                sink.write(found.astype(f"<u{width}").tobytes())
                lengths.append(len(found))
        if out is None:
            return
        out.__exit__(None, None, None)
        offsets = np.cumsum(lengths, dtype="<i8")
        with new_file(f"{name}.idx") as index:
            index.write(MAGIC + np.array([width, len(ids)], "<i8").tobytes() + offsets.tobytes())
            index.write(np.array([i or 0 for i in ids], "<i8").tobytes())
            index.write(np.array([i is not None for i in ids], "u1").tobytes())
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "part": TaskContext.get().partitionId(),
                    "file": name,
                    "n_docs": len(ids),
                    "n_tokens": int(offsets[-1]),
                }
            ],
            schema=pa.schema(
                [("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]
            ),
        )

    # The text's beginning and hash and the row's number let rows of one doc_id, even equal ones, lie
    # in several ranges, without whole texts in the sample that sets the ranges.
    order = ["doc_id", "_start", "_hash", "_row"]
    ordered = (
        docs.select("doc_id", "text")
        .withColumns(
            {
                "_start": F.substring("text", 1, 64),
                "_hash": F.xxhash64("text"),
                "_row": F.monotonically_increasing_id(),
            }
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    # A row per file comes to the driver, never a row per document.
    files = sorted(ordered.mapInArrow(write, FILE).collect(), key=lambda r: r["part"])
    base, rows = 0, []
    for row in files:
        rows.append((*row, base))
        base += row["n_tokens"]
    spark = docs.sparkSession
    manifest = spark.createDataFrame(rows, FILE + ", base long")
    manifest.coalesce(1).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


class TokenFile:
    """One file of a dataset; memory-mapped where the folder is mounted, else read."""

    def __init__(self, name: str):
        system, path = opened(name)
        with system.open_input_stream(f"{path}.idx") as f:
            raw = f.read()
        if raw[:8] != MAGIC:
            raise ValueError(f"{name}.idx is no token index")
        width, n = (int(x) for x in np.frombuffer(raw, "<i8", 2, 8))
        self.offsets = np.frombuffer(raw, "<i8", n + 1, 24)
        known = np.frombuffer(raw, "u1", n, 24 + 16 * n + 8)
        ids = np.frombuffer(raw, "<i8", n, 24 + 8 * n + 8)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known, strict=True)]
        if os.path.exists(f"{path}.bin"):
            self.ids = np.memmap(f"{path}.bin", f"<u{width}", "r")
        else:
            with system.open_input_stream(f"{path}.bin") as f:
                self.ids = np.frombuffer(f.read(), f"<u{width}")

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.offsets[i] : self.offsets[i + 1]]


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Each document of a dataset: doc_id, start (ids of all documents before it), n_tokens and
    the CRC-32 of its ids as unsigned 32-bit integers; one task per file or several files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = TokenFile(row["file"])
                sums = [
                    zlib.crc32(file.document(i).astype("<u4").tobytes())
                    for i in range(len(file.doc_ids))
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(file.doc_ids, pa.int64()),
                        pa.array(file.offsets[:-1] + row["base"], pa.int64()),
                        pa.array(np.diff(file.offsets), pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    manifest = spark.read.parquet(f"{folder}/manifest")
    spread = manifest.repartition(max(1, manifest.count()), "part")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
