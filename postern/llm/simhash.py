"""SimHash near-duplicates by vantage-point trees.

Fingerprints are grouped first, so copies count once. A vantage-point tree over a bounded sample
of fingerprints deals all fingerprints into shards: at a node, those within the median distance of
its vantage point go inside, the others outside. Distances obey the triangle inequality, so two
fingerprints within r bits lie on different sides only if the inner one is within r bits of the
border; those visit the outside shards too, and from there every shard their ball meets. Each shard
goes on splitting by vantage points of its own, pruning by the same bounds, down to small leaves
in which every own fingerprint is compared with every fingerprint that came. So every pair within
the bound meets. A shard reports a spanning set of its links, not all pairs.

Defined cases: a null or empty text has fingerprint zero, linked like any other; rows with a null
doc_id take part, and a component's id is its smallest doc_id that is not null (null if none);
repeated rows are copies; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postern.llm.common import ROW_KEY, set_aside, with_row_key, written
from postern.llm.graph import components

SHINGLE = 3
BITS = 2
#: The tree is built on at most so many fingerprints; shards have about so many of their own, but
#: there are at most 2 ** MAX_DEPTH of them (larger shards split on in their tasks).
SAMPLE, SHARD, MAX_DEPTH = 8192, 512, 12
LEAF = 256


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a whole text, as a signed integer."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, 42) for s in shingles], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        some = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash and fp of every row, from a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, pa.int64())],
                ["doc_id", "text_hash", "fp"],
            )

    slim = docs.select(
        F.col("doc_id").cast("long"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")
    )
    return written(slim.mapInArrow(run, "doc_id long, text_hash long, fp long"), "fingerprints")


def _distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


def build(points: np.ndarray, depth: int) -> dict | None:
    """A tree of ``depth`` levels: vantage point, median distance, inside and outside."""
    if depth <= 0 or len(points) < 2:
        return None
    # Of a few candidates, the vantage point whose median leaves the fewest points at the border.
    best = None
    for at in np.linspace(0, len(points) - 1, 8).astype(int):
        d = _distance(points, points[at])
        mu = int(np.median(d))
        if mu == d.max():
            mu -= 1
        border = np.mean(np.abs(d - mu) <= BITS) + 2 * abs(np.mean(d <= mu) - 0.5)
        if best is None or border < best[0]:
            best = (border, points[at], mu, d)
    _, vantage, mu, d = best
    return {
        "vantage": vantage,
        "mu": mu,
        "inside": build(points[d <= mu], depth - 1),
        "outside": build(points[d > mu], depth - 1),
    }


def _sides(points: np.ndarray, own: np.ndarray, vantage: np.uint64, mu: int, bits: int):
    """For inside and outside: which points go there, and which of them live there."""
    d = _distance(points, vantage)
    home_in, home_out = own & (d <= mu), own & (d > mu)
    # Inner points near the border visit the outside; visitors go wherever their ball reaches.
    visits_in = ~own & (d - bits <= mu)
    visits_out = (home_in & (d + bits > mu)) | (~own & (d + bits > mu))
    return (home_in | visits_in, home_in), (home_out | visits_out, home_out)


def route(tree: dict | None, points: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, points, which of them live there), in numbers from 0 in the tree's order."""
    number = 0

    def walk(node: dict | None, points: np.ndarray, own: np.ndarray):
        nonlocal number
        if node is None:
            yield number, points, own
            number += 1
            return
        for side, (goes, home) in zip(
            ("inside", "outside"), _sides(points, own, node["vantage"], node["mu"], bits), strict=True
        ):
            yield from walk(node[side], points[goes], home[goes])

    yield from walk(tree, points, np.ones(len(points), bool))


def _spanning(points: np.ndarray, own: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links (a, b) that connect what the pairs of own points and all points connect."""
    label = np.arange(len(points))
    homes = np.flatnonzero(own)
    for at in range(0, len(homes), 256):
        rows = homes[at : at + 256]
        near = np.bitwise_count(points[rows, None] ^ points[None, :]) <= bits
        for i in np.flatnonzero(near.sum(axis=1) > 1):
            labels = np.unique(label[near[i]])
            if len(labels) > 1:
                label[np.isin(label, labels[1:])] = labels[0]
    moved = label != np.arange(len(points))
    return [(points[moved], points[label[moved]])]


def links_of(points: np.ndarray, own: np.ndarray, bits: int, leaf: int = LEAF) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning links of a shard, splitting it by vantage points while that helps."""
    homes = points[own]
    if not len(homes):
        return []
    if len(homes) > leaf:
        vantage = homes[len(homes) // 2]
        d = _distance(homes, vantage)
        mu = int(np.median(d))
        mu -= int(mu == d.max())
        if 0.1 < np.mean(d <= mu) < 0.9:
            out = []
            for goes, home in _sides(points, own, vantage, mu, bits):
                out += links_of(points[goes], home[goes], bits, leaf)
            return out
    return _spanning(points, own, bits)


def linked(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that connect exactly those with a
    chain of steps of at most ``bits`` differing bits between them."""
    n = distinct.count()
    depth = min(MAX_DEPTH, max(0, int(n // SHARD).bit_length()))
    sample = distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toArrow().column("fp").to_numpy()
    tree = build(sample.view(np.uint64), depth)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for shard, some, own in route(tree, points, bits):
                if len(some):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(some), shard, np.int64)),
                            pa.array(some.view(np.int64)),
                            pa.array(own),
                        ],
                        ["shard", "fp", "own"],
                    )

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        points = frame["fp"].to_numpy().view(np.uint64)
        found = links_of(points, frame["own"].to_numpy(), bits)
        a, b = (np.concatenate([f[i] for f in found] or [points[:0]]).view(np.int64) for i in (0, 1))
        return pd.DataFrame({"a": a, "b": b}).drop_duplicates()

    dealt = distinct.select("fp").mapInArrow(deal, "shard long, fp long, own boolean")
    return dealt.groupBy("shard").applyInPandas(search, "a long, b long")


def near_duplicates(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """fp, component (a fingerprint) and component_id of each distinct fingerprint of ``prints``."""
    distinct = written(
        prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints"
    )
    found = components(linked(distinct, bits)).withColumnRenamed("node", "fp")
    named = distinct.join(found, "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return written(named.join(ids, "component").select("fp", "component", "component_id"), "components")


def find_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row of ``docs``."""
    prints = fingerprints(docs, shingle)
    return prints.join(near_duplicates(prints, bits), "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id's (a null one counts last), of
    several such rows the one with the smallest hash of its text."""
    prints = fingerprints(docs, shingle)
    classes = near_duplicates(prints, bits).select("fp", "component")
    # null sorts first in a struct, so the flag before it makes a null doc_id the last choice.
    key = F.struct(
        F.col("doc_id").isNull().alias("col1"),
        F.coalesce("doc_id", F.lit(0)).alias("col2"),
        F.col("text_hash").alias("col3"),
    )
    first = (
        prints.join(classes, "fp")
        .groupBy("component")
        .agg(F.min(key).alias("first"))
        .select(*[F.col(f"first.col{i + 1}").alias(c) for i, c in enumerate(ROW_KEY)])
    )
    rows, back = set_aside(docs, "doc_id", "text")
    kept = with_row_key(rows).join(first, ROW_KEY)
    like = Window.partitionBy(*ROW_KEY).orderBy(F.lit(0))
    return back(kept.withColumn("_copy", F.row_number().over(like)).filter("_copy = 1"))
