"""Removal of repeated substrings, judged by suffix order.

A string of LENGTH bytes that also starts earlier, in a smaller doc_id or further left in the same
document, has all its bytes removed. Steps:

1. Every window of LENGTH bytes has a key: the least hash of its GRAM-byte substrings. Neighbouring
   windows of one key make a run. Equal windows have equal keys, so only runs of one key can share
   a window, and a key with a single run holds no repeat.
2. A run whose bytes (by key, length and a hash of 64 bits) start earlier elsewhere is removed as a
   whole. Each task does this for the rows it has, so a passage in a third of all documents leaves
   it a few times only; then it is done per key.
3. Of a key's different runs, one of each goes on to the key's shard, which sorts all their
   suffixes by induced sorting (``induced.py``). This also gives the prefix that each suffix has in
   common with the one before; suffixes that share LENGTH bytes stand together, and all but the
   earliest of them are removed. Keys are sorted a bounded number of bytes at a time.
4. A key with more than SPLIT bytes is split: each of its windows goes on by itself, keyed by its
   own hash, which equal windows share, and of equal windows only the earliest stays. Each task does
   this for the windows it has first; then a window's rows pass by with one of them in memory.

Defined cases: a null text is empty; texts shorter than LENGTH keep everything; a null doc_id comes
after all others; rows that share a doc_id are documents of their own, ordered by the hash of their
texts, as are rows with a null doc_id, each of which is spread by itself (copies by their place in
the input); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postern.llm.induced import sort_suffixes

LENGTH, GRAM = 100, 40
#: Levels of names after which names stand for LENGTH bytes at least.
LEVELS = 7
#: Bytes of text hashed at once, of runs sorted at once (and one key's more), and of a key's runs
#: above which it is split into windows.
BUFFER, SHARD, SPLIT = 1 << 20, 8 << 20, 2 << 20
#: Windows of split keys compared at once in a task.
WINDOWS = 1 << 16
#: Low bits of the number of a row with a null doc_id that tell copies of a text apart.
COPIES = (1 << 20) - 1

#: An odd number, the base of the hash of a run.
BASE = 0x9FB21C651E98DF25

PLACE = "_null boolean, _id long, _sub int"


def _hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each substring of ``gram`` bytes."""
    with np.errstate(over="ignore"):
        factor = np.uint64(0x9E3779B97F4A7C15)
        out, width = data.astype(np.uint64) + np.uint64(1), 1
        total, at = None, 0
        while True:
            if gram & width:
                piece = out[at:]
                if total is None:
                    total = out
                else:
                    power = np.uint64(pow(int(factor), width, 1 << 64))
                    n = min(len(total), len(piece))
                    total = total[:n] * power + piece[:n]
                at += width
            if 2 * width > gram:
                break
            power = np.uint64(pow(int(factor), width, 1 << 64))
            out = out[:-width] * power + out[width:]
            width *= 2
        total = total[: len(data) - gram + 1]
        total = (total ^ (total >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return total ^ (total >> np.uint64(29))


def _sliding(pick: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """The least or greatest (``pick``) of each ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        x = pick(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return pick(x[:-rest], x[rest:]) if rest else x


def _groups(sizes: list[int]) -> Iterator[list[int]]:
    """Numbers of the texts that have a window, in groups of about BUFFER bytes."""
    group, total = [], 0
    for i, n in enumerate(sizes):
        if n < LENGTH:
            continue
        group.append(i)
        total += n
        if total >= BUFFER:
            yield group
            group, total = [], 0
    if group:
        yield group


def runs(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Of texts: number of the text, key, hash of the bytes, start, number of bytes, and 1 where the
    run may repeat a window within itself, else 0, for each run of windows."""
    none = np.zeros(0, np.int64)
    out = [(none,) * 6]
    reach = LENGTH - GRAM  # a window has reach + 1 substrings
    for group in _groups([len(t) for t in texts]):
        data = np.frombuffer(b"".join(texts[i] for i in group), np.uint8)
        ends = np.cumsum([len(texts[i]) for i in group])
        begins = np.append(0, ends[:-1])
        hashes = _hashes(data, GRAM)
        key = _sliding(np.minimum, hashes, reach + 1)
        # Windows that begin in one text and end in another are none.
        real = np.zeros(len(key) + 1, np.int64)
        real[begins] = 1
        np.add.at(real, ends - LENGTH + 1, -1)
        real = np.cumsum(real[:-1]) > 0
        edge = np.ones(len(key), bool)
        edge[1:] = (key[1:] != key[:-1]) | (real[1:] != real[:-1])
        edge[begins] = True
        first = np.flatnonzero(edge)
        last = np.append(first[1:], len(key)) - 1
        first, last = first[real[first]], last[real[first]]
        # Equal windows of one run have its key's substring in two places next to each other among
        # the places of any window's least substring.
        around = np.concatenate([np.zeros(reach, key.dtype), key, np.zeros(reach, key.dtype)])
        places = np.flatnonzero(_sliding(np.maximum, around, reach + 1) == hashes)
        twice = (np.diff(places) <= reach + 1) & (hashes[places[1:]] == hashes[places[:-1]])
        marks = places[:-1][twice]
        own = np.searchsorted(marks, last + reach, "right") > np.searchsorted(marks, first)
        text = np.searchsorted(ends, first, "right")
        # A polynomial of the substrings' hashes, brought to its first power by the inverse.
        with np.errstate(over="ignore"):
            up = np.full(len(hashes), BASE, np.uint64)
            down = np.full(len(hashes), pow(BASE, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            sums = np.append(np.uint64(0), np.cumsum(hashes * np.cumprod(up)))
            what = (sums[last + reach + 1] - sums[first]) * np.cumprod(down)[first]
        out.append(
            (
                np.array(group)[text],
                key[first].view(np.int64),
                what.view(np.int64),
                first - begins[text],
                last - first + LENGTH,
                own.astype(np.int64),
            )
        )
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _spread(i: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Keys that spread rows without a key over the tasks by their place."""
    with np.errstate(over="ignore"):
        out = i.astype(np.uint64) * np.uint64(BASE) + start.astype(np.uint64)
        return ((out ^ (out >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (PLACE, text): every run, and whether the batch has its bytes in an earlier place."""
    for batch in batches:
        text, key, what, start, size, twice = runs(batch.column(3).to_pylist())
        null, i, sub = (batch.column(c).to_numpy(zero_copy_only=False)[text] for c in range(3))
        order = np.lexsort((start, sub, i, null, size, what, key))
        same = np.zeros(len(order), bool)
        one, other = order[1:], order[:-1]
        same[1:] = (key[one] == key[other]) & (what[one] == what[other]) & (size[one] == size[other])
        again = np.zeros(len(order), bool)
        again[order] = same
        key = np.where(again, _spread(i, start), key)
        what = np.where(again, 0, what)
        columns = [
            (null, pa.bool_()),
            (i, pa.int64()),
            (sub, pa.int32()),
            (key, pa.int64()),
            (what, pa.int64()),
            (start, pa.int32()),
            (size, pa.int32()),
            (twice > 0, pa.bool_()),
            (again, pa.bool_()),
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c).cast(k) for c, k in columns],
            ["_null", "_id", "_sub", "key", "what", "start", "size", "twice", "again"],
        )


#: What becomes of a run: it goes as a whole, it is sorted, its windows are compared one by one.
REPEAT, SORTED, APART = range(3)


def _key(window: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "little", signed=True)


_CUT = pa.schema(
    [
        ("key", pa.int64()),
        ("_null", pa.bool_()),
        ("_id", pa.int64()),
        ("_sub", pa.int32()),
        ("start", pa.int32()),
        ("size", pa.int32()),
        ("data", pa.binary()),
    ]
)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (PLACE, text, runs): the bytes of the runs to sort; of runs to split, each window (size 0);
    whole repeats go along without bytes, those that overlap as one."""
    windows: dict[bytes, tuple] = {}
    again: dict[tuple, list[tuple[int, int]]] = {}

    def kept() -> list[tuple]:
        """The windows so far, the earliest of equal ones; the others are repeats."""
        rows = [(_key(w), *place, 0, w) for w, place in windows.items()]
        for place, own in again.items():
            rows += passed(list(place), own)
        windows.clear()
        again.clear()
        return rows

    def passed(place: list, own: list[tuple[int, int]]) -> list[tuple]:
        return [
            (int(_spread(np.array([place[1]]), np.array([s]))[0]), *place, s, e - s, None)
            for s, e in joined(own)
        ]

    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            lists = batch.column(4)
            offsets = lists.offsets.to_numpy()
            offsets = offsets - offsets[0]
            sub, key, start, size, sort = (
                c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten()
            )
            rows: list[tuple] = []
            for r in range(batch.num_rows):
                place = [batch.column(c)[r].as_py() for c in range(3)]
                text = batch.column(3)[r].as_py()
                own = np.arange(offsets[r], offsets[r + 1])
                own = own[sub[own] == place[2]]
                for k in own[sort[own] == SORTED].tolist():
                    s, n = int(start[k]), int(size[k])
                    rows.append((int(key[k]), *place, s, n, text[s : s + n]))
                for k in own[sort[own] == APART].tolist():
                    for s in range(int(start[k]), int(start[k] + size[k]) - LENGTH + 1):
                        new = (*place, s)
                        first = windows.setdefault(text[s : s + LENGTH], new)
                        if first != new:
                            if new < first:
                                windows[text[s : s + LENGTH]] = new
                            later = max(first, new)
                            again.setdefault(later[:3], []).append((later[3], LENGTH))
                    if len(windows) >= WINDOWS:
                        rows += kept()
                repeats = own[sort[own] == REPEAT]
                rows += passed(place, list(zip(start[repeats].tolist(), size[repeats].tolist(), strict=True)))
            rows += kept()
            columns = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, _CUT.types, strict=True)], _CUT.names
            )


def repeated(places: list[tuple], data: list[bytes]) -> list[tuple]:
    """(run, start in it, bytes) of all stretches of a shard's runs covered by strings that start
    earlier too; ``places`` tells the order of the runs' starts."""
    order = sorted(range(len(data)), key=places.__getitem__)
    if not order:
        return []
    raw = np.frombuffer(b"".join(x for i in order for x in (data[i], b"\0")), np.uint8)
    sizes = np.array([len(data[i]) for i in order])
    begins = np.cumsum(sizes + 1) - sizes - 1
    # UTF-8 has no bytes above 0xF4, so two symbols are left for the ends of runs and of the shard.
    t = np.empty(len(raw) + 1, np.uint8 if raw.max() < 254 else np.uint16)
    t[:-1] = raw
    t[:-1] += 2
    t[begins + sizes] = 1
    t[-1] = 0
    del raw
    suffixes, common = sort_suffixes(t, LENGTH, LEVELS)
    heads = np.flatnonzero(common < LENGTH)
    # Of each group with LENGTH symbols in common, all but the one that starts first. A group whose
    # strings reach over a run's end has one such end in all of them, and is no string of the text.
    later = np.ones(len(t), bool)
    later[np.minimum.reduceat(suffixes, heads)] = False
    del suffixes, common, heads
    hits = np.flatnonzero(later)
    run = np.searchsorted(begins, hits, "right") - 1
    inside = begins[run] + sizes[run] - hits >= LENGTH
    hits, run = hits[inside], run[inside]
    if not len(hits):
        return []
    new = np.append(True, (np.diff(hits) > 1) | (run[1:] != run[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(hits)) - 1
    return [
        (order[run[f]], int(hits[f] - begins[run[f]]), int(hits[e] - hits[f]) + LENGTH)
        for f, e in zip(first, last, strict=True)
    ]


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of runs in order of their keys: the stretches to remove. Repeats pass through; of the windows
    of split keys, those with one hash stand together."""
    places: list[tuple] = []
    data: list[bytes] = []
    key = total = 0
    hashed, windows = None, {}

    def sort() -> pa.RecordBatch:
        found = repeated(places, data)
        return _stretches([(*places[i][:3], places[i][3] + start, n) for i, start, n in found])

    for batch in batches:
        rows = batch.to_pydict()
        at = list(zip(*[rows[c] for c in ("_null", "_id", "_sub", "start")], strict=True))
        passed = []
        for k, place, n, own in zip(rows["key"], at, rows["size"], rows["data"], strict=True):
            if own is None:
                passed.append((*place, n))
                continue
            if n == 0:
                if k != hashed:
                    hashed, windows = k, {}
                first = windows.setdefault(own, place)
                if first != place:
                    windows[own] = min(first, place)
                    passed.append((*max(first, place), LENGTH))
                continue
            if k != key and total >= SHARD:
                yield sort()
                places, data, total = [], [], 0
            places.append(place)
            data.append(own)
            total += len(own)
            key = k
        yield _stretches(passed)
    yield sort()


def _stretches(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 5
    kinds = [pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        ["_null", "_id", "_sub", "start", "size"],
    )


def joined(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(start, end) of maximal runs of stretches (start, size) that overlap or touch."""
    out: list[list[int]] = []
    for start, size in sorted(stretches):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], start + size)
        else:
            out.append([start, start + size])
    return [(s, e) for s, e in out]


def _numbered(docs: DataFrame) -> DataFrame:
    """PLACE and text (bytes) of every row; _sub numbers the rows that share a doc_id. Rows without
    one are numbered by the hash of their text and, in its last bits, their place in the input."""
    copy = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit(COPIES))
    unnamed = F.xxhash64("text").bitwiseAND(F.lit(~COPIES)).bitwiseOR(copy)
    order = Window.partitionBy("_null", "_id").orderBy("_hash")
    return (
        docs.select(
            F.col("doc_id").isNull().alias("_null"),
            F.coalesce(F.col("doc_id"), F.lit(0)).cast("long").alias("_id"),
            F.coalesce("text", F.lit("")).cast("binary").alias("text"),
        )
        .withColumn("_id", F.when(F.col("_null"), unnamed).otherwise(F.col("_id")))
        .withColumn("_hash", F.xxhash64("text"))
        .withColumn("_sub", F.row_number().over(order))
        .select("_null", "_id", "_sub", "text")
    )


def _to_compare(texts: DataFrame) -> DataFrame:
    """The rows of _CUT: runs to sort, windows of split keys, and repeats, of PLACE and text."""
    located = texts.mapInArrow(
        _located,
        f"{PLACE}, key long, what long, start int, size int, twice boolean, again boolean",
    )
    one = Window.partitionBy("key", "what", "size")
    ranked = located.withColumns(
        {
            "rank": F.row_number().over(one.orderBy("_null", "_id", "_sub", "start")),
            "kinds": F.max("what").over(Window.partitionBy("key"))
            != F.min("what").over(Window.partitionBy("key")),
            "sizes": F.max("size").over(Window.partitionBy("key"))
            != F.min("size").over(Window.partitionBy("key")),
            "bytes": F.sum(F.when(~F.col("again"), F.col("size"))).over(Window.partitionBy("key")),
        }
    )
    whole = F.col("again") | (F.col("rank") > 1)
    compared = F.col("twice") | F.col("kinds") | F.col("sizes")
    way = F.when(whole, REPEAT).when(F.col("bytes") > SPLIT, APART).otherwise(SORTED)
    lists = (
        ranked.filter(whole | compared)
        .withColumn("sort", way.cast("tinyint"))
        .groupBy("_null", "_id")
        .agg(F.collect_list(F.struct("_sub", "key", "start", "size", "sort")).alias("_runs"))
    )
    return (
        texts.join(lists, ["_null", "_id"])
        .select("_null", "_id", "_sub", "text", "_runs")
        .mapInArrow(_cut, f"key long, {PLACE}, start int, size int, data binary")
    )


def with_stretches(docs: DataFrame) -> DataFrame:
    """PLACE, text (bytes) and _stretches: array of (_sub, start, size) to remove from the rows of
    a doc_id. The texts are shuffled once, by doc_id; all that needs them reads that shuffle."""
    texts = _numbered(docs)
    cut = _to_compare(texts).repartition("key").sortWithinPartitions("key")
    found = cut.mapInArrow(_shard, f"{PLACE}, start int, size int")
    removed = found.groupBy("_null", "_id").agg(
        F.collect_list(F.struct("_sub", "start", "size")).alias("_stretches")
    )
    return texts.join(removed, ["_null", "_id"], "left")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for null, i, sub, text, own in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                spans = joined([(x["start"], x["size"]) for x in own or [] if x["_sub"] == sub])
                kept, at = hashlib.sha256(), 0
                for start, end in spans:
                    kept.update(text[at:start])
                    at = end
                kept.update(text[at:])
                out.append(
                    {
                        "doc_id": None if null else i,
                        "n_bytes": len(text),
                        "n_removed": sum(e - s for s, e in spans),
                        "n_spans": len(spans),
                        "kept_sha256": kept.hexdigest(),
                        "spans": [{"start": s, "end": e} for s, e in spans],
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_bytes", pa.int64()),
            ("n_removed", pa.int64()),
            ("n_spans", pa.int64()),
            ("kept_sha256", pa.string()),
            ("spans", pa.list_(span)),
        ]
    )
    return (
        with_stretches(docs)
        .select("_null", "_id", "_sub", "text", "_stretches")
        .mapInArrow(
            run,
            "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
            "spans array<struct<start:bigint,end:bigint>>",
        )
    )
