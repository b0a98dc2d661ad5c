"""Repair of conversations: the cheapest edits that make their roles alternate.

A conversation's rows, by turn, must give role initials ``(s?(ua)+)?``, which four states tell. Rows
are kept, deleted, given another role, or empty rows are put in between; blank and duplicate rows
must go, truncated ones cost more if they stay. The cost of the cheapest edits from each state to the
end is a vector of four numbers, and each row turns the vector after it into the one before it.

Four-Russians block tables: of vectors less their least entry only a few exist, and a row counts as
one of nine symbols. For every block of BLOCK symbols and every such vector, tables hold the vector
before the block, what to add, and the state in which the edits leave the block. Rows are processed
from the last to the first a block at a time by lookup. Then blocks are expanded row by row from the
first: of all edits that keep to the cheapest cost, the ASCII-least goes next, so ties are settled
over the whole audit.

No conversation is gathered in one task: rows are dealt by range of (conversation, turn, row), so a
large one lies in several partitions, in chunks of at most CHUNK_ROWS rows and CHUNK_SIZE characters.
A conversation that lies within a partition and a chunk is finished there. For all others, equal rows
of different chunks meet by a hash, each chunk gives the tables of all its rows (for every vector and
state), the chunks' tables are put together per conversation, and each chunk is then expanded from its
own state. Only the SHA-256 of a conversation is one sequence; it is streamed chunk by chunk.

Defined cases: null roles and texts are one space, in keys too; null conv_ids are one conversation;
null turns come first; rows of one turn are in order of role, the first 64 characters and a hash of
their text, so repeated rows are adjacent. Very long texts are a chunk of their own. A conversation
that has lost all its rows has zeros, an empty audit and the hash of nothing; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postern.llm.common import table_of, written

#: Symbols in a block of the tables.
BLOCK = 4
#: Rows and characters of a chunk; a longer row is a chunk by itself.
CHUNK_ROWS, CHUNK_SIZE = 1 << 16, 4_000_000

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
# Faults of a row.
NONE, BLANK, DUPLICATE, CUT = range(4)
# States: nothing yet, after the system's, the user's, the assistant's row. Where keeping a row of an
# initial leads, and where a new or another role leads.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = [
    {START: SYSTEM},
    {START: USER, SYSTEM: USER, ASSISTANT: USER},
    {USER: ASSISTANT},
    {},
]
INITIALS = "sua"
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Symbols: 0 for a row that must go, else 1 + 2 * place of its initial (3 for others) + truncated.
SYMBOLS = 9


def _with_inserts(vector: list[int]) -> list[int]:
    for _ in vector:
        vector = [min(vector[q], INSERT + vector[NEXT[q]]) for q in range(4)]
    return vector


END = tuple(_with_inserts([0, 99, 99, 0]))


def _moves(symbol: int, q: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, next state) for a row of a symbol in a state, in ASCII order."""
    yield "D", DELETE, q
    if symbol:
        initial, truncated = divmod(symbol - 1, 2)
        if q in KEPT[initial]:
            yield "K", KEEP + TRUNCATED * truncated, KEPT[initial][q]
        yield "R", REROLE + TRUNCATED * truncated, NEXT[q]


class Tables:
    """Transitions of normalised cost vectors, by symbol and by block.

    ``edits[symbol][v][q]`` are the edits up to a row of the symbol from state q, and the state after
    them, where v is the vector after the row. ``before[code, v]`` is the vector before a block,
    ``extra[code, v]`` what its entries are less than the costs, ``state[code, v, q]`` the state after
    the block; ``code`` reads the block's symbols as digits."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors = [END]
        number = {END: 0}
        rows: list[list[tuple[int, int]]] = []
        self.edits: list[list[list[tuple[str, int]]]] = [[] for _ in range(SYMBOLS)]
        for after in self.vectors:  # grows while vectors are found
            row = []
            for symbol in range(SYMBOLS):
                costs = [min(c + after[to] for _, c, to in _moves(symbol, q)) for q in range(4)]
                costs = _with_inserts(costs)
                least = min(costs)
                vector = tuple(c - least for c in costs)
                if vector not in number:
                    number[vector] = len(self.vectors)
                    self.vectors.append(vector)
                row.append((number[vector], least))
                self.edits[symbol].append([self._edits(symbol, costs, after, q) for q in range(4)])
            rows.append(row)
        table = np.array(rows, np.int64)  # vector, symbol, (before, extra)
        self.step, self.more = table[:, :, 0].T, table[:, :, 1].T
        self.moved = np.array([[[q for _, q in e] for e in of] for of in self.edits], np.int64)
        # Blocks of one symbol more: what follows the first symbol is known.
        self.before, self.extra, self.state = self.step, self.more, self.moved
        first = np.arange(SYMBOLS)[:, None, None]
        lanes = np.arange(len(self.vectors))[:, None]
        for _ in range(block - 1):
            middle = self.before[None]
            rests = np.arange(middle.shape[1])[:, None, None]
            state = self.state[rests, lanes, self.moved[first, middle]]
            self.state = state.reshape(-1, *state.shape[2:])
            self.extra = (self.extra[None] + self.more[first, middle]).reshape(-1, len(lanes))
            self.before = self.step[first, middle].reshape(-1, len(lanes))

    @staticmethod
    def _edits(symbol: int, costs: list[int], after: tuple, q: int) -> tuple[str, int]:
        out = ""
        while True:
            ways = [(e, to) for e, c, to in _moves(symbol, q) if costs[q] == c + after[to]]
            if costs[q] == INSERT + costs[NEXT[q]]:
                ways.append(("I", NEXT[q]))
            edit, q = min(ways)
            out += edit
            if edit != "I":
                return out, q

    def _codes(self, symbols: np.ndarray) -> tuple[list[int], list[int]]:
        """The symbols before the first whole block, and the codes of the blocks."""
        head = len(symbols) % self.block
        digits = symbols[head:].reshape(-1, self.block).astype(np.int64)
        weights = SYMBOLS ** np.arange(self.block - 1, -1, -1)
        return symbols[:head].tolist(), (digits @ weights).tolist()

    def _backward(self, symbols: np.ndarray, after):
        """From the last row to the first: the vectors after each block and after each row before
        the first block, the vector before all rows, and what its entries are less than the costs."""
        head, codes = self._codes(symbols)
        extra, rights = 0, []
        for numbers, before, more in ((codes, self.before, self.extra), (head, self.step, self.more)):
            right = []
            for code in reversed(numbers):
                right.append(after)
                extra = extra + more[code, after]
                after = before[code, after]
            rights.append(list(zip(numbers, reversed(right), strict=True)))
        return rights[0], rights[1], after, extra

    def transition(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each vector after these rows: the vector before them, what to add, and the state after
        them for each state before them."""
        n = len(self.vectors)
        blocks, head, before, extra = self._backward(symbols, np.arange(n))
        state = np.tile(np.arange(4), (n, 1))
        for symbol, v in head:
            state = self.moved[symbol, v[:, None], state]
        for code, v in blocks:
            state = self.state[code, v[:, None], state]
        return before, extra + np.zeros(n, np.int64), state

    def expand(self, symbols: np.ndarray, after: int, q: int) -> tuple[list[str], int, int]:
        """The edits up to each row from state q, the state after all rows, and their cost from q to
        the end if the vector after them is the costs after them."""
        blocks, head, before, extra = self._backward(symbols, after)
        cost = self.vectors[before][q] + int(extra)
        edits = []
        for symbol, v in head:
            edit, q = self.edits[symbol][v][q]
            edits.append(edit)
        for code, v in blocks:
            inner = []
            for _ in range(self.block):
                code, symbol = divmod(code, SYMBOLS)
                inner.append((symbol, v))
                v = self.step[symbol, v]
            for symbol, v in reversed(inner):
                edit, q = self.edits[symbol][v][q]
                edits.append(edit)
        return edits, q, cost


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def closing(q: int) -> str:
    """Edits after the last row."""
    return {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[q]


def rewritten(edits: list[str], roles: list[str], texts: list[str], q: int) -> list[str]:
    """The rows that edits leave, from state q, as ``role:text``."""
    out = []
    for edit, role, text in zip(edits, roles, texts, strict=True):
        for e in edit:
            if e == "D":
                continue
            if e == "K":
                q = KEPT[INITIALS.find(role[:1]) if role else 3][q]
                out.append(f"{role}:{text}")
            else:
                q = NEXT[q]
                out.append(f"{ROLE[q]}:{text if e == 'R' else ''}")
    return out


def damage(rows: DataFrame) -> DataFrame:
    """Rows damaged by crc32(``conv_id:turn``) % 20: ``gone`` (0), empty text (1), text without
    ``[.!?]`` (2), repeated (3), role user (4). Gone rows stay, marked, so that their conversation
    is known."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text = (
        F.when(fault == 1, "").when(fault == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    )
    return rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(shown("role")).alias("role"),
        text.alias("text"),
        (fault == 0).alias("gone"),
        F.explode(F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


_SUMS = ["n_rows", "blank", "duplicate", "truncated", "illegal"]
_DONE = [("conv_id", pa.int64())] + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
_DONE += [("audit", pa.string()), ("repaired_sha256", pa.string())]
_OPEN = [
    ("chunk", pa.int64()),
    ("faults", pa.binary()),
    ("initials", pa.binary()),
    ("turns", pa.list_(pa.int64())),
    ("keys", pa.list_(pa.int64())),
    ("others", pa.list_(pa.int64())),
    ("places", pa.list_(pa.int64())),
    ("roles", pa.list_(pa.string())),
    ("texts", pa.list_(pa.string())),
]


def _batch(rows: list[tuple], columns: list[tuple]) -> pa.RecordBatch:
    values = list(zip(*rows, strict=True)) or [()] * len(columns)
    return pa.RecordBatch.from_arrays(
        [pa.array(v, k) for v, (_, k) in zip(values, columns, strict=True)], [c for c, _ in columns]
    )


class _Chunk:
    """Rows of one conversation, in order."""

    def __init__(self):
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.faults = bytearray()
        self.initials = bytearray()
        self.seen: dict[tuple[int, int], int] = {}
        self.turns: list[int] = []  # first, last, distinct
        self.size = 0

    def add(self, turn: int | None, role: str, text: str, fault: int, key: tuple[int, int]) -> None:
        if fault != BLANK:
            if key in self.seen:
                fault = DUPLICATE
            else:
                self.seen[key] = len(self.roles)
        if turn is not None:
            first, last, distinct = self.turns or (turn, None, 0)
            self.turns = [first, turn, distinct + (turn != last)]
        self.roles.append(role)
        self.texts.append(text)
        self.faults.append(fault)
        self.initials.append(INITIALS.find(role[0]) % 4 if role else 3)
        self.size += len(role) + len(text)

    def full(self) -> bool:
        return len(self.roles) >= CHUNK_ROWS or self.size >= CHUNK_SIZE

    def row(self, chunk: int) -> tuple:
        keys = list(self.seen)
        lists = [k for k, _ in keys], [k for _, k in keys], list(self.seen.values())
        return (chunk, bytes(self.faults), bytes(self.initials), self.turns, *lists, self.roles, self.texts)


def symbols(faults: np.ndarray, initials: np.ndarray) -> np.ndarray:
    kept = 1 + 2 * initials.astype(np.int64) + (faults == CUT)
    return np.where((faults == BLANK) | (faults == DUPLICATE), 0, kept)


def sums(faults: np.ndarray, initials: np.ndarray) -> list[int]:
    """Rows, blank, duplicate and truncated ones, and neighbours whose initials are not su, ua, au."""
    a, b = initials[:-1], initials[1:]
    legal = ((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))
    return [len(faults), *(int((faults == f).sum()) for f in (BLANK, DUPLICATE, CUT)), int((~legal).sum())]


def _gaps(first: int, last: int, distinct: int) -> int:
    return last - first + 1 - distinct


def _finished(conv_id: int | None, chunk: _Chunk) -> tuple:
    faults, initials = np.frombuffer(chunk.faults, np.uint8), np.frombuffer(chunk.initials, np.uint8)
    _, *counts = sums(faults, initials)
    edits, q, cost = tables().expand(symbols(faults, initials), 0, START)
    edits.append(closing(q))
    kept = rewritten(edits, [*chunk.roles, ""], [*chunk.texts, ""], START)
    digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
    gaps = _gaps(*chunk.turns) if chunk.turns else 0
    return (conv_id, gaps, *counts, cost, "".join(edits), digest)


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered rows of a partition: conversations that lie within it and within a chunk are finished,
    the first and the last one and those of several chunks become chunks."""
    number = TaskContext.get().partitionId() << 20
    first, within, conv_id, chunk = True, True, None, None
    none_done, none_open = (None,) * (len(_DONE) - 1), (None,) * len(_OPEN)
    out: list[tuple] = []

    def open_chunk() -> tuple:
        nonlocal number
        number += 1
        return (conv_id, *none_done, *chunk.row(number))

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own, turn, role, text, gone, fault, key, other = row
            if chunk is None or own != conv_id:
                if chunk is not None:
                    out.append(open_chunk() if first or not within else (*_finished(conv_id, chunk), *none_open))
                    first = False
                conv_id, chunk, within = own, _Chunk(), True
            elif chunk.full():
                out.append(open_chunk())
                chunk, within = _Chunk(), False
            if not gone:
                chunk.add(turn, role, text, fault, (key, other))
        yield _batch(out, _DONE + _OPEN)
        out = []
    if chunk is not None:
        yield _batch([open_chunk()], _DONE + _OPEN)


_MAP = [("conv_id", pa.int64()), ("chunk", pa.int64()), ("sums", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))]
_MAP += [("turns", pa.list_(pa.int64()))] + [(c, pa.list_(pa.int64())) for c in ("before", "extra", "state")]


def _with_late(faults: bytes, late: list[int] | None) -> np.ndarray:
    found = np.frombuffer(faults, np.uint8).copy()
    if late:
        found[late] = DUPLICATE
    return found


def _transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk's counts, initials at its ends, turns, and transitions for every vector."""
    for batch in batches:
        rows = []
        for conv_id, chunk, faults, initials, turns, late in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found, letters = _with_late(faults, late), np.frombuffer(initials, np.uint8)
            before, extra, state = tables().transition(symbols(found, letters))
            ends = [int(letters[0]), int(letters[-1])] if len(letters) else []
            rows.append((conv_id, chunk, sums(found, letters), ends, turns, before, extra, state.ravel()))
        yield _batch(rows, _MAP)


_PLAN = [("conv_id", pa.int64()), ("chunk", pa.int64()), ("after", pa.int64()), ("q", pa.int64()), ("total", pa.list_(pa.int64()))]


def _plan(rows: pa.Table) -> pa.Table:
    """Put a conversation's chunks together: the vector after each and the state before it; its last
    chunk also has the conversation's gaps, counts and cost."""
    own = rows.sort_by("chunk").to_pylist()
    after, cost, rights = 0, 0, []
    for row in reversed(own):
        rights.append(after)
        cost += row["extra"][after]
        after = row["before"][after]
    cost += tables().vectors[after][START]
    out, q, total, turns, last = [], START, np.zeros(len(_SUMS), np.int64), [], None
    for row, right in zip(own, reversed(rights), strict=True):
        out.append([row["conv_id"], row["chunk"], right, q, None])
        q = row["state"][4 * right + q]
        total += row["sums"]
        if row["ends"]:
            total[-1] += last is not None and (last, row["ends"][0]) not in ((0, 1), (1, 2), (2, 1))
            last = row["ends"][1]
        if row["turns"]:
            begin, end, distinct = row["turns"]
            turns = [turns[0], end, turns[2] + distinct - (turns[1] == begin)] if turns else row["turns"]
    out[-1][-1] = [_gaps(*turns) if turns else 0, *total[1:].tolist(), cost, q]
    return pa.Table.from_batches([_batch([tuple(r) for r in out], _PLAN)])


_PART = [("conv_id", pa.int64()), ("chunk", pa.int64()), ("audit", pa.string()), ("rows", pa.string()), ("total", pa.list_(pa.int64()))]


def _expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk's part of the audit and its repaired rows."""
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            conv_id, chunk, faults, initials, roles, texts, late, after, q, total = row
            found = symbols(_with_late(faults, late), np.frombuffer(initials, np.uint8))
            edits, end, _ = tables().expand(found, after, q)
            if total:
                edits, roles, texts = [*edits, closing(end)], [*roles, ""], [*texts, ""]
            kept = rewritten(edits, roles, texts, q)
            yield _batch([(conv_id, chunk, "".join(edits), "\n".join(kept), total)], _PART)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered parts of whole conversations, whose rows are hashed part by part."""
    sha, empty, audit = hashlib.sha256(), True, []
    for batch in batches:
        out = []
        for conv_id, _, edits, kept, total in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if kept:
                sha.update(("" if empty else "\n").encode() + kept.encode())
                empty = False
            audit.append(edits)
            if total:
                out.append((conv_id, *total[:-1], "".join(audit), sha.hexdigest()))
                sha, empty, audit = hashlib.sha256(), True, []
        yield _batch(out, _DONE)


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text, gone): the missing turns, blank,
    duplicate, truncated and illegal rows, the cost and audit of the cheapest edits, and the SHA-256
    of the repaired rows."""
    parts, done = _parts(rows)
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return done.unionByName(ordered.mapInArrow(_hashed, table_of(_DONE)))


def _parts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    rest = F.rtrim("text", F.lit(SPACES))
    fault = F.when(rest == "", BLANK).when(F.substring(rest, -1, 1).isin(".", "!", "?"), NONE).otherwise(CUT)
    order = ["conv_id", "turn", "role", "_start", "_key", "_row"]
    ordered = (
        rows.select(
            *("conv_id", "turn", "role", "text", "gone"),
            fault.alias("_fault"),
            F.xxhash64("role", "text").alias("_key"),
            F.xxhash64(F.lit("other"), "text", "role").alias("_other"),
            F.substring("text", 1, 64).alias("_start"),
            # Rows that are equal in all else can still lie in several partitions.
            F.monotonically_increasing_id().alias("_row"),
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", "turn", "role", "text", "gone", "_fault", "_key", "_other")
    )
    split = written(ordered.mapInArrow(_split, table_of(_DONE + _OPEN)), "conversations")
    done = split.filter("chunk IS NULL").select(*(c for c, _ in _DONE))
    chunks = split.filter("chunk IS NOT NULL")

    # Rows equal to one of an earlier chunk. A place is unique and rises in the order of rows.
    place = F.col("chunk") * F.lit(1 << 20) + F.col("x.places")
    heads = chunks.select(
        "conv_id", "chunk", F.explode(F.arrays_zip("keys", "others", "places")).alias("x")
    ).select("conv_id", F.col("x.keys").alias("key"), F.col("x.others").alias("other"), place.alias("place"))
    same = ["conv_id", "key", "other"]
    repeated = (
        heads.groupBy(*same)
        .agg(F.min("place").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select(F.col("conv_id").alias("of"), F.col("key").alias("k"), F.col("other").alias("o"), "first")
    )
    late = (
        heads.join(repeated, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("k")) & (F.col("other") == F.col("o")))
        .filter("place > first")
        .groupBy(F.shiftright("place", 20).alias("in_chunk"))
        .agg(F.collect_list((F.col("place") % (1 << 20)).cast("int")).alias("late"))
    )
    late = written(late, "late")
    with_late = lambda df: df.join(late, F.col("chunk") == F.col("in_chunk"), "left")
    slim = with_late(chunks.select("conv_id", "chunk", "faults", "initials", "turns"))
    maps = slim.drop("in_chunk").mapInArrow(_transitions, table_of(_MAP))
    plans = maps.groupBy("conv_id").applyInArrow(_plan, table_of(_PLAN)).drop("conv_id")
    texts = with_late(chunks.select("conv_id", "chunk", "faults", "initials", "roles", "texts")).drop("in_chunk")
    parts = texts.join(plans, "chunk").select(
        "conv_id", "chunk", "faults", "initials", "roles", "texts", "late", "after", "q", "total"
    )
    return parts.mapInArrow(_expanded, table_of(_PART)), done
