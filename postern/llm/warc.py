"""WARC archives: writing with deduplication by payload digest, reading by boundary chains.

Writing: a page becomes one record, a ``response`` with its payload or, where a payload of at least
``min_bytes`` occurs again, a ``revisit`` that refers to the response (that of the largest page_id).
Digests alone are shuffled for it; pages whose digest is not in a bitmap of the repeated ones are
written where they are read, the others are joined with their response.
Records are plain text files of Spark's own writer, whose line separator is the record separator.

Reading: tasks take chunks of files. Each emits a candidate for every magic line in its chunk that
a header follows, with the offset of its successor (header, content length, separator), and where
the chain from there leaves the chunk. Pointer jumping over these exits, from the start of each
file, finds the offset at which the true chain enters each chunk; so magic lines inside payloads
are never reached. From its entry, a task then walks the chunk's records and reads them.

Defined cases: a null html is an empty payload; a null page_id is the smallest, and a revisit of
its response has a null refers_to; of repeated rows one is the response; line ends in a url are
percent-encoded; an empty table writes no record; other columns are ignored. A record whose
successor doesn't start with the magic line ends its file's chain, as the rest can't be trusted; a
header whose length isn't ASCII digits or reaches beyond its file is none. Very long payloads are
hashed piece by piece.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postern.llm.common import written
from postern.llm.files import opened

MAGIC = b"WARC/1.0\r\n"
END = "\r\n\r\n"
RECORDS_PER_FILE = 20_000
CHUNK = 16 << 20
HEADER = 4096
#: Bits of the bitmap that tells payloads that occur once, and bytes of each of its rows (Spark's).
BITS, BITMAP = 1 << 25, 4096


def base32(hexed: Column) -> Column:
    """Bare upper-case base32 of a SHA-1 in hex: 8 groups of 20 bits, 4 digits each."""
    digits = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for group in range(8):
        bits = F.conv(F.substring(hexed, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            out.append(F.substring(digits, F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)))
    return F.concat(*out)


def _marked(rows: DataFrame, again: DataFrame) -> DataFrame:
    """``rows`` with ``maybe``: whether a bitmap of at most BITS bits over the digests that ``again``
    holds has the row's bit. Without it, the payload occurs once; the bitmap is BITS / 8 bytes at most."""
    bit = F.pmod(F.xxhash64("digest"), F.lit(BITS))
    page = 8 * BITMAP  # bits
    maps = (
        again.select(bit.alias("bit"))
        .groupBy((F.col("bit") / page).cast("int").alias("_page"))
        .agg(F.bitmap_construct_agg(F.col("bit") % page).alias("_map"))
    )
    at = (F.col("_bit") % page).cast("int")
    byte = F.conv(F.hex(F.substring("_map", F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.expr(f"shiftleft(1, CAST(_bit % {page} % 8 AS INT))")) != 0
    return (
        rows.withColumn("_bit", bit)
        .withColumn("_page", (F.col("_bit") / page).cast("int"))
        .join(F.broadcast(maps), "_page", "left")
        .withColumn("maybe", F.coalesce(hit, F.lit(False)))
        .drop("_bit", "_page", "_map")
    )


def records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """One record per page as text, without the separator after it."""
    rows = pages.select(
        F.col("page_id").cast("long"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).withColumns({"bytes": F.octet_length("html").cast("long"), "digest": F.unhex(F.sha1("html"))})
    # The digests alone decide. Payloads that occur once are written by the task that reads them.
    slim = rows.select("page_id", "digest", "bytes").filter(f"bytes >= {min_bytes}").drop("bytes")
    again = written(
        slim.groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1"),
        "again",
    )
    marked = _marked(rows, again)
    once = marked.filter("not maybe").withColumns(
        {"response": F.lit(True), "first": F.lit(None).cast("long")}
    )
    # The others get numbers, fixed by the written table, and join by page, so that no payload's
    # copies meet; of equal rows that with the least number can be the response.
    shared = written(
        marked.filter("maybe").withColumns(
            {
                "_row": F.monotonically_increasing_id(),
                "_null": F.col("page_id").isNull(),
                "_id": F.coalesce("page_id", F.lit(0)),
            }
        ),
        "shared",
    )
    key = ["_null", "_id", "digest"]
    repeats = (
        shared.filter(f"bytes >= {min_bytes}")
        .groupBy(*key)
        .agg(F.min("_row").alias("_least"))
        .join(again.select("digest", "first"), "digest")
    )
    response = F.col("_least").isNull() | (
        F.col("page_id").eqNullSafe(F.col("first")) & (F.col("_row") == F.col("_least"))
    )
    decided = shared.join(repeats, key, "left").withColumn("response", response)
    columns = ["page_id", "url", "html", "bytes", "digest", "response", "first"]
    urn = lambda i: F.concat(F.lit("<urn:page:"), F.coalesce(i.cast("string"), F.lit("")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"\r\n{name}: "), value)
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    record = F.concat(
        F.lit(MAGIC.decode().strip()),
        line("WARC-Type", F.when(F.col("response"), "response").otherwise("revisit")),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.hex("digest")))),
        F.when(F.col("response"), "").otherwise(line("WARC-Refers-To", urn(F.col("first")))),
        line("Content-Length", F.when(F.col("response"), F.col("bytes")).otherwise(0).cast("string")),
        F.lit(END),
        F.when(F.col("response"), F.col("html")).otherwise(""),
    )
    return once.select(*columns).unionByName(decided.select(*columns)).select(record.alias("value"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write the records of all pages to text files under ``folder``."""
    (
        records(pages, min_bytes)
        .write.option("lineSep", END)
        .option("maxRecordsPerFile", records_per_file)
        .text(folder)
    )


#: A length of a file fits 18 digits; other digits than ASCII's are no number here.
_LENGTH = re.compile("[0-9]{1,18}")


def parse_header(raw: bytes) -> dict[str, str] | None:
    """The fields of a header without its final blank line; None if it isn't one."""
    lines = raw.decode("utf-8", "replace").split("\r\n")
    if lines[0] != "WARC/1.0":
        return None
    fields = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
    return fields if _LENGTH.fullmatch(fields.get("Content-Length", "")) else None


class _File:
    """Reads at offsets of one file, in blocks."""

    def __init__(self, uri: str):
        system, path = opened(uri)
        self.file = system.open_input_file(path)
        self.size = self.file.size()

    def at(self, offset: int, n: int) -> bytes:
        return self.file.read_at(n, offset) if n > 0 else b""

    def header(self, offset: int) -> tuple[dict[str, str], int] | None:
        """Fields of the header at an offset, and where its payload starts."""
        n = HEADER
        while True:
            raw = self.at(offset, n)
            end = raw.find(END.encode())
            if end >= 0 or len(raw) < n or not raw.startswith(MAGIC):
                break
            n *= 4
        fields = parse_header(raw[:end]) if end >= 0 else None
        return fields and (fields, offset + end + len(END))

    def record(self, offset: int) -> tuple[dict[str, str], int, int] | None:
        """Fields of the record at an offset, where its payload starts, and its successor's offset;
        None if its length reaches beyond the file."""
        found = self.header(offset)
        if found is None:
            return None
        after = found[1] + int(found[0]["Content-Length"]) + len(END)
        return (*found, after) if after <= self.size else None


def chunks(spark: SparkSession, folder: str, chunk: int = CHUNK) -> DataFrame:
    """file, chunk start and end of all archives under ``folder``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)
    return (
        files.select(F.col("path").alias("file"), "length")
        .filter("length > 0")
        .withColumn("start", F.explode(F.expr(f"sequence(0L, length - 1, {chunk}L)")))
        .withColumn("end", F.expr(f"least(length, start + {chunk})"))
        .repartition("file", "start")
    )


def candidates(parts: DataFrame) -> DataFrame:
    """Each magic line that a header follows: file, its chunk (start, end), its offset, and the
    first offset beyond the chunk on the chain from there."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file, start, end = _File(row["file"]), row["start"], row["end"]
                raw = file.at(start, end - start + len(MAGIC) - 1)
                offsets = [start + m.start() for m in re.finditer(re.escape(MAGIC), raw)]
                del raw
                exits: dict[int, int] = {}
                for offset in reversed(offsets):
                    found = file.record(offset)
                    if found is not None:
                        after = found[2]
                        exits[offset] = exits.get(after, after if after >= end else -1)
                leaving = sorted((o, e) for o, e in exits.items() if e >= 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["file"]] * len(leaving), pa.string()),
                        pa.array([o for o, _ in leaving], pa.int64()),
                        pa.array([e for _, e in leaving], pa.int64()),
                    ],
                    ["file", "offset", "exit"],
                )

    return parts.select("file", "start", "end").mapInArrow(
        scan, "file string, offset long, exit long"
    )


def entries(parts: DataFrame) -> DataFrame:
    """file and offset where the chain from each file's start first enters each of its chunks.

    Jumps double in each round, so the rounds are the logarithm of a file's number of chunks."""
    jumps = written(candidates(parts), "jumps")
    most = parts.groupBy("file").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    reached = parts.filter("start = 0").select("file", F.lit(0).cast("long").alias("offset"))
    for _ in range(max(0, (most - 1).bit_length())):
        ahead = reached.join(jumps, ["file", "offset"]).select("file", F.col("exit").alias("offset"))
        reached = written(reached.unionByName(ahead).distinct(), "reached")
        far = jumps.select("file", F.col("offset").alias("exit"), F.col("exit").alias("far"))
        jumps = written(
            jumps.join(far, ["file", "exit"], "left")
            .filter("far is not null")
            .select("file", "offset", F.col("far").alias("exit")),
            "jumps",
        )
    return reached


def read_archives(spark: SparkSession, folder: str, chunk: int = CHUNK) -> DataFrame:
    """All true records: page_id, record_type, payload_digest as stated, refers_to, payload_bytes
    and whether payload and stated digest agree (responses only)."""
    parts = written(chunks(spark, folder, chunk), "chunks")
    entered = entries(parts).withColumn("start", F.expr(f"offset - offset % {chunk}"))
    todo = entered.join(parts, ["file", "start"]).select("file", "offset", "end")

    def page(urn: str | None) -> int | None:
        digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if re.fullmatch("-?[0-9]{1,19}", digits) else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file, offset, out = _File(row["file"]), row["offset"], []
                while offset < row["end"] and (found := file.record(offset)):
                    fields, body, after = found
                    n = after - len(END) - body
                    stated = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
                    kind = fields.get("WARC-Type")
                    sha = hashlib.sha1()
                    for at in range(0, n, CHUNK):
                        sha.update(file.at(body + at, min(CHUNK, n - at)))
                    true = base64.b32encode(sha.digest()).decode()
                    out.append(
                        {
                            "page_id": page(fields.get("WARC-Record-ID")),
                            "record_type": kind,
                            "payload_digest": true if kind == "response" else stated,
                            "refers_to": page(fields.get("WARC-Refers-To")),
                            "payload_bytes": n if kind == "response" else None,
                            "agrees": true == stated if kind == "response" else None,
                        }
                    )
                    offset = after
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("record_type", pa.string()),
            ("payload_digest", pa.string()),
            ("refers_to", pa.int64()),
            ("payload_bytes", pa.int64()),
            ("agrees", pa.bool_()),
        ]
    )
    return todo.repartition("file", "offset").mapInArrow(
        read,
        "page_id long, record_type string, payload_digest string, refers_to long, payload_bytes long, agrees boolean",
    )


def resolved(read: DataFrame) -> DataFrame:
    """Records with payload_bytes of revisits filled in from the response they refer to."""
    read = written(read, "records")
    answers = read.filter("record_type = 'response'").select(
        F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes")
    ).distinct()
    revisits = read.filter("record_type = 'revisit'").join(
        answers, F.col("payload_digest") == F.col("_digest")
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (
        read.filter("record_type = 'response'")
        .select(*columns)
        .unionByName(
            revisits.withColumn("payload_bytes", F.col("_bytes")).select(*columns)
        )
    )
