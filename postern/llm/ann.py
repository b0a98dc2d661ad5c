"""Approximate nearest neighbours by learned partitions.

On a bounded sample of the distinct vectors, the graph of nearest neighbours (largest inner
product) is cut into balanced parts by recursive bisection: an initial half by projection, then
swaps of those nodes that have most neighbours on the other side, always as many from either side.
A softmax classifier learns the parts from the vectors. Every vector is then indexed in its most
probable partition, and a query goes to its several most probable ones, whose vectors are all
reranked by the exact measure. How many partitions a query probes is set on the sample, by the
recall of held-out queries against brute force.

Copies of a vector are one entry with the smallest ids that a query can need, and equal queries are
searched once. A partition is searched in blocks of bounded size by groups of the queries that probe
it, so a hot one is shared by tasks.

Defined cases: vectors that are null, empty, all zero, or with null or non-finite components take no
part, neither as queries nor as candidates; vectors of different lengths have no inner product, so
each length is a search of its own, with its own router; products beyond the largest double are
infinite, and one that is no number (infinities of both signs) counts as minus infinity; ties go to
the smaller id; a null id takes no part; rows that repeat an id are one; very long vectors are rows
like any others; an empty table gives an empty result; with fewer candidates than k all are returned;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postern.llm.common import written

#: The sample that graph and classifier are fitted on, of which every HELD-th is held out.
SAMPLE, HELD = 8192, 8
#: Vectors per partition aimed at, the most partitions, vectors and queries of a search block.
PART, MOST_PARTS, BLOCK, QUERIES = 2048, 256, 8192, 16_384
GRAPH = 16
RECALL = 0.94


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; first scaled by their largest component, whose square may overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@dataclass
class Router:
    """The classifier: probabilities rise with x @ weights + bias; probes: partitions per query."""

    weights: np.ndarray
    bias: np.ndarray
    probes: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _unit(x) @ self.weights + self.bias

    def best(self, x: np.ndarray, n: int) -> np.ndarray:
        """The n most probable partitions of each row, best first."""
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, :n]


def neighbour_graph(x: np.ndarray, k: int = GRAPH) -> np.ndarray:
    """The k rows with the largest inner product with each row, itself left out."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 512):
        near = x[at : at + 512] @ x.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        out[at : at + 512] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def bisect(x: np.ndarray, graph: np.ndarray, rows: np.ndarray, seed: int, rounds: int = 12) -> np.ndarray:
    """Which of ``rows`` go right; halves differ by one at most, few graph edges are cut."""
    rng = np.random.default_rng(seed)
    sub = x[rows] - x[rows].mean(axis=0)
    axis = rng.standard_normal(x.shape[1])
    for _ in range(10):
        axis = sub.T @ (sub @ axis)
        axis /= max(np.linalg.norm(axis), 1e-30)
    right = np.zeros(len(rows), bool)
    right[np.argsort(sub @ axis, kind="stable")[len(rows) // 2 :]] = True
    place = np.full(len(x), -1)
    place[rows] = np.arange(len(rows))
    near = place[graph[rows]]
    here = near >= 0
    one = np.repeat(np.arange(len(rows)), here.sum(axis=1))
    other = near[here]
    for step in range(rounds):
        # Edges count in both directions. A node's gain: its edges that a move would mend.
        cut = np.where(right[one] != right[other], 1, -1)
        gain = np.bincount(one, cut, len(rows)) + np.bincount(other, cut, len(rows))
        left_best = np.flatnonzero(~right)[np.argsort(-gain[~right], kind="stable")]
        right_best = np.flatnonzero(right)[np.argsort(-gain[right], kind="stable")]
        n = min(len(left_best), len(right_best))
        # Swapped together, pairs may undo each other's gain; so only a share moves in a round.
        wins = np.flatnonzero(gain[left_best[:n]] + gain[right_best[:n]] > 0)
        move = max(1, int(len(wins) * 0.5 * (1 - step / rounds))) if len(wins) else 0
        if not move:
            break
        right[left_best[:move]], right[right_best[:move]] = True, False
    return right


def partition_graph(x: np.ndarray, graph: np.ndarray, depth: int) -> np.ndarray:
    """2 ** depth balanced parts of the sample."""
    part = np.zeros(len(x), np.int64)
    for level in range(depth):
        for p in range(1 << level):
            rows = np.flatnonzero(part == p)
            right = bisect(x, graph, rows, seed=(level << 16) + p)
            part[rows] = p | (right.astype(np.int64) << level)
    return part


def fit_classifier(x: np.ndarray, part: np.ndarray, n_parts: int, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression by gradient steps with momentum on all rows of the sample."""
    unit = _unit(x)
    weights, bias = np.zeros((x.shape[1], n_parts)), np.zeros(n_parts)
    moved_w, moved_b = np.zeros_like(weights), np.zeros_like(bias)
    rng = np.random.default_rng(7)
    for step in range(steps):
        some = rng.integers(0, len(x), min(len(x), 1024))
        score = unit[some] @ weights + bias
        p = np.exp(score - score.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(some)), part[some]] -= 1
        rate = 8.0 * (1 - step / steps)
        moved_w = 0.9 * moved_w + unit[some].T @ p / len(some)
        moved_b = 0.9 * moved_b + p.mean(axis=0)
        weights -= rate * moved_w
        bias -= rate * 0.1 * moved_b
    return weights, bias


def fit(sample: np.ndarray, n_vectors: int, k: int = 20, recall: float = RECALL) -> Router:
    """Partition and classifier from a sample of distinct vectors, and the probes that reach
    ``recall`` on its held-out rows."""
    depth = int(np.ceil(np.log2(max(1, min(n_vectors / PART, MOST_PARTS, len(sample) / 32)))))
    n_parts = 1 << depth
    if n_parts == 1:
        return one_part(sample.shape[1])
    # Products keep their order, but can't overflow.
    with np.errstate(over="ignore"):
        unit = _unit(sample)
        norms = np.abs(sample).max(axis=1) / np.abs(unit).max(axis=1)
        sample = unit * np.minimum(norms / np.median(norms), 1e100)[:, None]
    held = np.arange(len(sample)) % HELD == 0
    train = sample[~held]
    part = partition_graph(train, neighbour_graph(train), depth)
    router = Router(*fit_classifier(train, part, n_parts), 1)
    home = router.best(train, 1)[:, 0]
    queries = sample[held]
    # At which probe of its query each true neighbour is found.
    probe = np.empty((len(queries), n_parts), np.int64)
    order = router.best(queries, n_parts)
    probe[np.arange(len(queries))[:, None], order] = np.arange(n_parts)
    near = np.argsort(-(queries @ train.T), axis=1, kind="stable")[:, :k]
    found = np.sort(probe[np.arange(len(queries))[:, None], home[near]].ravel())
    router.probes = int(found[max(0, int(np.ceil(recall * len(found))) - 1)]) + 1
    return router


def one_part(width: int) -> Router:
    return Router(np.zeros((width, 1)), np.zeros(1), 1)


def fit_widths(entries: DataFrame, k: int) -> dict[int, Router]:
    """A router for each length of the distinct vectors. Only lengths with more vectors than one
    partition holds are sampled."""
    routers = {}
    for width, n in entries.groupBy(F.size("vector")).count().collect():
        if n <= PART:
            routers[width] = one_part(width)
            continue
        alike = entries.filter(F.size("vector") == width)
        sample = alike.orderBy(F.xxhash64("entry"), "entry").limit(SAMPLE).select("vector").toArrow()
        routers[width] = fit(_stack(sample.column("vector").combine_chunks()), n, k)
    return routers


def _routed(routers: dict[int, Router], vectors: pa.Array, probes: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, partition) of each vector, its best or all that it probes. A partition's number has the
    vectors' length in its upper half."""
    lists = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    widths = lists.value_lengths().to_numpy(zero_copy_only=False)
    rows, parts = [], []
    for width in np.unique(widths).tolist():
        if width not in routers:  # a query without candidates of its length
            continue
        at = np.flatnonzero(widths == width)
        router = routers[width]
        best = router.best(_stack(lists.take(pa.array(at))), router.probes if probes else 1)
        rows.append(np.repeat(at, best.shape[1]))
        parts.append(best.ravel() + (width << 32))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(parts)


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    )
    bad = F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    zero = ~F.exists("vector", lambda v: v != 0)
    return rows.filter("vec_id is not null and size(vector) > 0").filter(~bad & ~zero)


def _stack(column: pa.Array | pd.Series) -> np.ndarray:
    if isinstance(column, pd.Series):
        return np.stack(column.to_list()) if len(column) else np.zeros((0, 1))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _least_ids(rows: DataFrame, n: int) -> DataFrame:
    """Each distinct vector's n smallest ids. Ranks are cut before the shuffle too, so a vector
    with a third of all rows is a few rows by then."""
    order = Window.partitionBy("vector").orderBy("vec_id")
    return (
        rows.withColumn("_n", F.row_number().over(order))
        .filter(F.col("_n") <= n)
        .groupBy("vector")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    )


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest vectors found for each query. ``queries``
    has the same columns; a query never finds its own id."""
    rows = usable(vectors, vec_id, vector).distinct()
    entries = written(
        _least_ids(rows, k + 1).withColumn("entry", F.element_at("ids", 1)), "entries"
    )
    routers = fit_widths(entries, k)

    def indexing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, part = _routed(routers, batch.column(2), probes=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), *batch.take(pa.array(at)).columns], ["part", "entry", "ids", "vector"]
            )

    def probing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, part = _routed(routers, batch.column(1), probes=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), *batch.take(pa.array(at)).columns], ["part", "query", "vector"]
            )

    def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, n = np.unique(_routed(routers, batch.column(0), probes=True)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(parts), pa.array(n)], ["part", "n"])

    index = written(
        entries.select("entry", "ids", "vector").mapInArrow(
            indexing, "part long, entry long, ids array<bigint>, vector array<double>"
        ),
        "index",
    )
    asked = usable(queries, vec_id, vector).withColumnRenamed("vec_id", "query_id").distinct()
    distinct = written(asked.groupBy("vector").agg(F.min("query_id").alias("query")), "queries")
    # A partition's blocks follow its size, its groups the queries that probe it.
    probed = distinct.select("vector").mapInArrow(counting, "part long, n long").groupBy("part")
    sizes = (
        index.groupBy("part")
        .agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"))
        .join(probed.agg(F.ceil(F.sum("n") / QUERIES).cast("long").alias("groups")), "part")
    )
    sizes = F.broadcast(sizes)  # at most MOST_PARTS rows for each length of vectors
    probes = (
        distinct.select("query", "vector")
        .mapInArrow(probing, "part long, query long, vector array<double>")
        .join(sizes, "part")
        .withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .select("part", "block", F.expr("pmod(xxhash64(query), groups)").alias("group"), "query", "vector")
    )
    stored = index.join(sizes, "part").select(
        "part",
        F.expr("pmod(xxhash64(entry), blocks)").alias("block"),
        F.explode(F.expr("sequence(0L, groups - 1)")).alias("group"),
        "entry",
        "ids",
        "vector",
    )

    def rerank(ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        with np.errstate(over="ignore", invalid="ignore"):
            return ranked(ours, theirs)

    def ranked(ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(ours) and len(theirs):
            part = int(ours["part"].iloc[0])
            theirs = theirs.sort_values("entry")
            x, ids = _stack(theirs["vector"]), theirs["ids"].to_numpy()
            longest = np.linalg.norm(x, axis=1).max()
            for at in range(0, len(ours), 512):
                some = ours.iloc[at : at + 512]
                q = _stack(some["vector"])
                score = q @ x.T
                margins = 1e-12 * np.linalg.norm(q, axis=1) * longest
                for i, query in enumerate(some["query"]):
                    row, n = score[i], min(k + 1, len(x))
                    # All that may be among the best in exact arithmetic, ties included.
                    known = np.where(np.isnan(row), -np.inf, row)
                    least = np.partition(known, len(row) - n)[len(row) - n]
                    near = np.flatnonzero(~(row < least - margins[i]))
                    exact = (x[near] * q[i]).sum(axis=1)
                    exact[np.isnan(exact)] = -np.inf
                    best = np.lexsort((theirs["entry"].to_numpy()[near], -exact))[: k + 1]
                    hits = sorted((-exact[b], j) for b in best for j in ids[near[b]])[: k + 1]
                    out.append((query, part, [h[0] for h in hits], [int(h[1]) for h in hits]))
        return pd.DataFrame(out, columns=["query", "part", "away", "ids"])

    key = ["part", "block", "group"]
    found = (
        probes.groupBy(*key)
        .cogroup(stored.groupBy(*key))
        .applyInPandas(rerank, "query long, part long, away array<double>, ids array<bigint>")
    )
    # Lists of the best are merged twice, by partition and by query; none is longer than a query's
    # blocks times k + 1.
    best = F.slice(F.array_sort(F.flatten(F.collect_list("hits"))), 1, k + 1).alias("hits")
    top = (
        found.select("query", "part", F.arrays_zip("away", "ids").alias("hits"))
        .groupBy("query", "part")
        .agg(best)
        .groupBy("query")
        .agg(best)
    )
    named = asked.join(distinct, "vector").select("query_id", "query").join(top, "query")
    without = F.slice(F.filter("hits", lambda s: s["ids"] != F.col("query_id")), 1, k)
    return named.select("query_id", F.posexplode(without).alias("pos", "hit")).select(
        "query_id",
        (F.col("pos") + 1).alias("rank"),
        F.col("hit.ids").alias("vec_id"),
        (-F.col("hit.away")).alias("score"),
    )
