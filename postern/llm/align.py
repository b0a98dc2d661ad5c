"""Alignment of the tokens of two tokenizers over the same texts, and how often their ids meet.

Both tokenizers cut the same bytes, so a text's tokens are two rising lists of end offsets. The lists
of many texts stand one after the other and are merged by merge-path partitioning: for equally spaced
diagonals of the merge grid, binary searches (all at once) find how many ends of A and of B lie
before each, which divides the merge into independent pieces of equal work. All pieces step at the
same time; each step emits the overlap of the A and the B token that it stands in, or the end of a
group where both lists end. Pieces count their groups by themselves; prefix sums of these counts
stitch groups that reach over a border of pieces, and texts, into one numbering.

Counts over the corpus: a task works on chunks of bounded text and emits a chunk's distinct id pairs
with the number of its documents that hold them, so what is shuffled is one row per pair and chunk,
whatever a pair's frequency. Counts and each A id's best count go back to the chunks by the same
rows, where each document's links are looked up.

Defined cases: a text that is null or empty, or whose tokens' bytes are not space+text, has no
tokens (zeros, empty digest). Very long texts are a chunk of their own. Documents are rows: repeated
rows and null doc_ids count each. Ties of counts are all best. An empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postern.llm.common import table_of, written
from postern.llm.sentencepieces import Spelling, model
from postern.llm.tokens import Encoder

#: Steps of one piece of the merge.
STEPS = 256
#: Characters of texts that are aligned together, and those whose id pairs are counted together.
BLOCK, CHUNK = 2_000_000, 8_000_000


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable characters of
    Latin-1 stand for themselves, the other bytes follow from U+0100 in order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Tokenizers:
    """Tokenizer A (byte-level BPE, given space+text) and tokenizer B (pieces, adds the space)."""

    def __init__(self, path_a: str, path_b: str):
        self.a = Encoder(path_a, "byte")
        self.a.tokenizer.encode_special_tokens = True
        self.b = model(path_b)
        decode = byte_level()
        names = sorted(self.a.tokenizer.get_vocab(with_added_tokens=True).items(), key=lambda x: x[1])
        self.bytes_a = Spelling([bytes(decode[c] for c in name) for name, _ in names])
        self.decimals = Spelling([b"%d," % i for i in range(max(len(names), len(self.b.names)))])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A's ids of the texts one after the other and how many each text has, and the same of B;
        texts whose bytes differ have none."""
        raw = list(self.a.encode(pa.array([" " + t if t else "" for t in texts], pa.string())))
        a = np.frombuffer(b"".join(raw), "<u4")
        n_a = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        b, n_b = self.b.encode_texts(texts)
        wanted = [b" " + t.encode() if t else b"" for t in texts]
        good = _equal(wanted, self.bytes_a, a, n_a) & _equal(wanted, self.b.surface, b, n_b)
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        return a, n_a * good, b, n_b * good


def _equal(wanted: list[bytes], spelling: Spelling, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    spelled = spelling.spell(ids)
    ends = np.append(0, np.cumsum(spelling.sizes[ids]))[np.cumsum(counts)].tolist()
    starts = [0, *ends[:-1]]
    return np.array([spelled[s:e].tobytes() == w for s, e, w in zip(starts, ends, wanted, strict=True)], bool)


@lru_cache(maxsize=1)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def merge_path(ends_a: np.ndarray, ends_b: np.ndarray, steps: int = STEPS):
    """Merge two rising lists of end offsets whose last values are equal. For each step of the merge
    (A's end first where both are equal): the A and the B token it stands in, whether it ends the A
    token (else it ends the B token), whether the two tokens overlap there, and its group."""
    n_a, n_b = len(ends_a), len(ends_b)
    total = n_a + n_b
    if not total:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(bool), none.astype(bool), none
    top = np.iinfo(np.int64).max
    a, b = np.append(ends_a, top), np.append(ends_b, top)
    # How many ends of A lie before each diagonal: the least i with a[i] > b[diagonal - 1 - i].
    diagonal = np.arange(0, total, steps)
    low, high = np.maximum(0, diagonal - n_b), np.minimum(diagonal, n_a)
    while (low < high).any():
        open_ = low < high
        middle = (low + high) // 2
        before = a[middle] <= b[np.maximum(diagonal - 1 - middle, 0)]
        low = np.where(open_ & before, middle + 1, low)
        high = np.where(open_ & ~before, middle, high)
    i, j = low, diagonal - low
    at_a = np.empty((steps, len(diagonal)), np.int64)
    at_b, takes_a = np.empty_like(at_a), np.empty(at_a.shape, bool)
    ends_group = np.empty(at_a.shape, bool)
    for t in range(steps):
        of_a, of_b = a[i], b[j]
        is_a = of_a <= of_b
        at_a[t], at_b[t], takes_a[t] = i, j, is_a
        # A border between pieces may part two equal ends; the end before it tells.
        ends_group[t] = ~is_a & (i > 0) & (a[i - 1] == of_b)
        i = np.minimum(i + is_a, n_a)
        j = np.minimum(j + ~is_a, n_b)
    flat = lambda x: x.T.reshape(-1)[:total]
    at_a, at_b, takes_a = flat(at_a), flat(at_b), flat(takes_a)
    # Groups by piece; the last piece's steps beyond the end are not counted by later ones.
    own = np.cumsum(ends_group, axis=0) - ends_group
    ended = ends_group.sum(axis=0)
    group = flat(own + (np.cumsum(ended) - ended))
    return at_a, at_b, takes_a, ~flat(ends_group), group


class Aligned:
    """Some texts' tokens, overlaps and groups."""

    def __init__(self, own: Tokenizers, texts: list[str]):
        self.own = own
        self.a, self.n_a, self.b, self.n_b = own.encode(texts)
        self.at_a, self.at_b, self.takes_a, self.links, self.group = merge_path(
            np.cumsum(own.bytes_a.sizes[self.a]), np.cumsum(own.b.surface.sizes[self.b])
        )
        #: Steps, links and groups before each text and before the end.
        self.step_ends = np.append(0, np.cumsum(self.n_a + self.n_b))
        self.link_ends = np.append(0, np.cumsum(self.links))[self.step_ends]
        self.group_ends = np.append(0, np.cumsum(~self.links))[self.step_ends]

    def id_pairs(self) -> np.ndarray:
        """(A id << 32) + B id of each link."""
        a, b = self.a[self.at_a[self.links]], self.b[self.at_b[self.links]]
        return (a.astype(np.int64) << 32) + b

    def group_strings(self) -> Iterator[bytes]:
        """Each text's groups, as ``a1,a2|b1;a3|b2,b3`` in ids."""
        n = int(self.group_ends[-1])
        of_a, of_b = self.group[self.takes_a], self.group[~self.takes_a]
        per_a, per_b = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
        ends_a, ends_b = np.cumsum(per_a), np.cumsum(per_b)
        ids = np.empty(len(self.a) + len(self.b), np.int64)
        ids[np.arange(len(self.a)) + (ends_b - per_b)[of_a]] = self.a
        ids[np.arange(len(self.b)) + ends_a[of_b]] = self.b
        spelled = self.own.decimals.spell(ids)
        ends = np.cumsum(self.own.decimals.sizes[ids])
        spelled[ends[ends_a + ends_b - per_b - 1] - 1] = ord("|")
        spelled[ends[ends_a + ends_b - 1] - 1] = ord(";")
        text_ends = np.append(0, ends)[self.step_ends].tolist()
        for begin, end in zip(text_ends, text_ends[1:], strict=False):
            yield spelled[begin : max(begin, end - 1)].tobytes()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """doc_ids and texts (null: empty) of about BLOCK characters."""
    ids: list = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        column = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
        for doc_id, text in zip(batch.column(0).to_pylist(), column.to_numpy(zero_copy_only=False), strict=True):
            if texts and size + len(text) > BLOCK:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
    if texts:
        yield ids, texts


def links(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row per document: its ids by A and by B, the number of A and B tokens in each group, and its
    links as places among its A and B tokens."""
    kinds = [("doc_id", pa.int64())]
    kinds += [(c, pa.list_(pa.int32())) for c in ("a", "b", "group_a", "group_b", "link_a", "link_b")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizers(path_a, path_b)
        for doc_ids, texts in _blocks(batches):
            found = Aligned(own, texts)
            ends_a, ends_b = (np.append(0, np.cumsum(n)) for n in (found.n_a, found.n_b))
            n = int(found.group_ends[-1])
            of_a = np.bincount(found.group[found.takes_a], minlength=n)
            of_b = np.bincount(found.group[~found.takes_a], minlength=n)
            link_a = found.at_a[found.links] - np.repeat(ends_a[:-1], np.diff(found.link_ends))
            link_b = found.at_b[found.links] - np.repeat(ends_b[:-1], np.diff(found.link_ends))
            lists = [(ends_a, found.a), (ends_b, found.b), (found.group_ends, of_a), (found.group_ends, of_b)]
            lists += [(found.link_ends, link_a), (found.link_ends, link_b)]
            columns = [pa.array(doc_ids, pa.int64())]
            columns += [
                pa.ListArray.from_arrays(pa.array(e.astype(np.int32)), pa.array(v.astype(np.int32))) for e, v in lists
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(kinds))

    schema = ", ".join(["doc_id long"] + [f"{c} array<int>" for c, _ in kinds[1:]])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


_ALIGNED = [
    ("chunk", pa.int64()),
    ("doc_id", pa.int64()),
    ("n_a", pa.int64()),
    ("n_b", pa.int64()),
    ("n_groups", pa.int64()),
    ("n_links", pa.int64()),
    ("groups_sha256", pa.string()),
    ("places", pa.binary()),
    ("times", pa.binary()),
    ("keys", pa.binary()),
    ("docs", pa.binary()),
]


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row per document, and (with ``keys``) a row per chunk. ``keys`` are a chunk's distinct id
    pairs in order and ``docs`` how many of its documents link them; ``places`` are a document's
    distinct pairs as places among these, and ``times`` how often it links each. Places and keys are
    stored as differences."""
    names = [c for c, _ in _ALIGNED]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, (_, k) in zip(columns, _ALIGNED, strict=True)], names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizers(path_a, path_b)
        chunk = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0

        def finish() -> Iterator[pa.RecordBatch]:
            keys, place = np.unique(np.concatenate([k for *_, k, _ in held]), return_inverse=True)
            times = np.concatenate([t for *_, t in held]).astype("<u4")
            at, rows = 0, []
            for doc_id, n_a, n_b, n_groups, n_links, digests, counts in (r for r, *_ in held):
                for i, n in enumerate(counts.tolist()):
                    places = np.diff(place[at : at + n], prepend=0).astype("<u4").tobytes()
                    row = (doc_id[i], n_a[i], n_b[i], n_groups[i], n_links[i], digests[i])
                    rows.append((chunk, *row, places, times[at : at + n].tobytes(), None, None))
                    at += n
            per_key = np.bincount(place, minlength=len(keys)).astype("<u4").tobytes()
            delta = np.diff(keys, prepend=0).astype("<i8").tobytes()
            rows.append((chunk, *[None] * 8, delta, per_key))
            yield batch(rows)

        for doc_ids, texts in _blocks(batches):
            found = Aligned(own, texts)
            per_doc = np.diff(found.link_ends)
            # Distinct pairs of each document, in order within it.
            doc = np.repeat(np.arange(len(texts)), per_doc)
            block_keys, place = np.unique(found.id_pairs(), return_inverse=True)
            own_pair, times = np.unique(doc * max(1, len(block_keys)) + place, return_counts=True)
            counts = np.bincount(own_pair // max(1, len(block_keys)), minlength=len(texts))
            digests = [
                hashlib.sha256(s).hexdigest() if n else ""
                for s, n in zip(found.group_strings(), found.n_a.tolist(), strict=True)
            ]
            row = (doc_ids, found.n_a, found.n_b, np.diff(found.group_ends), per_doc, digests, counts)
            held.append((row, block_keys[own_pair % max(1, len(block_keys))], times))
            size += sum(map(len, texts))
            if size >= CHUNK:
                yield from finish()
                held, size, chunk = [], 0, chunk + 1
        if held:
            yield from finish()

    return docs.select("doc_id", "text").mapInArrow(run, table_of(_ALIGNED))


def count_links(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: n_a, n_b, n_groups, n_links, n_best (links whose id pair is linked in as many
    documents as any pair of its A id), count_sum (documents that hold a link's pair, over all links)
    and groups_sha256."""
    rows = written(aligned(docs, path_a, path_b), "aligned", compression="zstd")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, keys, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = np.cumsum(np.frombuffer(keys, "<i8"))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(key), chunk)),
                        pa.array(key),
                        pa.array(np.frombuffer(n, "<u4").astype(np.int64)),
                    ],
                    ["chunk", "key", "n"],
                )

    chunks = rows.filter("keys IS NOT NULL").select("chunk", "keys", "docs")
    pairs = chunks.mapInArrow(spread, "chunk long, key long, n long")
    counts = written(pairs.groupBy("key").agg(F.sum("n").alias("count")), "counts")
    a_id = F.shiftright("key", 32)
    best = counts.groupBy(a_id.alias("a")).agg(F.max("count").alias("best"))
    scored = counts.join(best, a_id == best["a"]).select(
        "key", "count", (F.col("count") == F.col("best")).alias("is_best")
    )
    known = pairs.select("chunk", "key").join(scored, "key")
    of_chunk = known.select("chunk", "key", "count", "is_best").groupBy("chunk")

    def score(own: pa.Table, pairs: pa.Table) -> pa.Table:
        pairs = pairs.sort_by("key")
        count = pairs.column("count").to_numpy()
        is_best = pairs.column("is_best").to_numpy().astype(np.int64)
        sums, bests = [], []
        for places, times in zip(own.column("places").to_pylist(), own.column("times").to_pylist(), strict=True):
            at = np.cumsum(np.frombuffer(places, "<u4").astype(np.int64))
            n = np.frombuffer(times, "<u4").astype(np.int64)
            sums.append(int(n @ count[at]) if len(at) else 0)
            bests.append(int(n @ is_best[at]) if len(at) else 0)
        kept = own.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        kept = kept.append_column("n_best", pa.array(bests, pa.int64()))
        kept = kept.append_column("count_sum", pa.array(sums, pa.int64()))
        return kept.append_column("groups_sha256", own.column("groups_sha256"))

    of_docs = rows.filter("keys IS NULL").drop("keys", "docs").groupBy("chunk")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    return of_docs.cogroup(of_chunk).applyInArrow(score, schema + "groups_sha256 string")
