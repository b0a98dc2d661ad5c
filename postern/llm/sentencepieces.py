"""SentencePiece encoding (BPE) by vectorised merge rounds, and decoding.

A chunk of texts becomes one flat array of characters. It is cut into words: between two neighbouring
characters that stand together in no piece of the vocabulary no merge can ever happen. Distinct words
are found by Arrow's dictionary encoding. New ones are encoded together in rounds over flat numpy
arrays of symbols: a segmented minimum finds each word's best pair, its leftmost places that don't
overlap are merged at once, the arrays are compacted, and words without a pair leave; until no pair
remains.

One by one, the best pair's leftmost place goes first and what it makes may come before the next
place. That can matter only where a piece that the merge makes is part of a better (or equal) piece,
so for such pairs a round merges the leftmost place of the word alone. In a word of more than LONG
symbols the minimum is that of the pair's surroundings, as no merge reaches further than a piece. The
ids equal those of the sentencepiece library.

Defined cases: a null or empty text has no ids; characters without a piece become their bytes; very
long texts are cut before single spaces and never held as more than a few arrays of a chunk. A word
takes a round per merge at most; of long words only runs of one character are slow, in the worst case
with the square of their length (spaces are not). Ties of score go to the leftmost place. Repeated
rows are encoded like any others, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Words kept by one Python worker; the memory of them starts anew when it is full.
MAX_WORDS = 400_000
#: Bytes of texts that are cut into words together, and ids that are spelled out together.
CUT, BLOCK = 2_000_000, 1 << 20
#: Symbols of a word from which on its pairs wait for those near them only.
LONG = 512
#: The mark that stands for a space in pieces.
SPACE = "▁"
# Fixed values of the model format: the kinds of pieces.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

_NONE = np.int64(1 << 40)


def _fields(raw: bytes) -> Iterator[tuple[int, bytes | int]]:
    """(number, value) of the fields of a protocol buffer message."""

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    at = 0
    while at < len(raw):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind) or number()
        yield tag >> 3, raw[at : at + size]
        at += size


class Spelling:
    """Byte strings by id, to be put together for many ids at once."""

    def __init__(self, strings: list[bytes]):
        self.flat = np.frombuffer(b"".join(strings), np.uint8)
        self.sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def spell(self, ids: np.ndarray) -> np.ndarray:
        """The strings of all ids, one after the other."""
        blocks = []
        for begin in range(0, len(ids), BLOCK):
            some = ids[begin : begin + BLOCK]
            n = self.sizes[some]
            to = np.cumsum(n)
            at = np.repeat(self.starts[some] - (to - n), n)
            at += np.arange(len(at))
            blocks.append(self.flat[at])
        return np.concatenate(blocks) if blocks else np.zeros(0, np.uint8)


class PieceModel:
    """A BPE model of the sentencepiece library, with byte fallback and without a normaliser."""

    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        if library.normalize(" a  b ") != f"{SPACE}{SPACE}a{SPACE}{SPACE}b{SPACE}":
            raise ValueError("only models that leave texts as they are and add a space are known")
        names, scores, kinds = [], [], []
        for number, value in _fields(library.serialized_model_proto()):
            if number == 1:
                piece = dict(_fields(value))
                names.append(piece[1].decode())
                scores.append(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]))
                kinds.append(piece.get(3, NORMAL))
            elif number == 2 and dict(_fields(value)).get(3, 1) != 2:
                raise ValueError("only BPE models are known")
        if {UNUSED, USER_DEFINED} & set(kinds) or kinds.count(BYTE) != 256:
            raise ValueError("only models with byte fallback, without pieces unused or set by a user, are known")
        self.names, self.kinds = names, np.array(kinds)
        self.byte_ids = [i for i, k in enumerate(kinds) if k == BYTE]
        known = {p: i for i, (p, k) in enumerate(zip(names, kinds, strict=True)) if k == NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in known):
            raise ValueError("only models whose pieces hold spaces at their start alone are known")

        # Characters of pieces have classes from 1; all others are of class 0.
        chars = sorted({c for p in known for c in p})
        class_of = {c: i + 1 for i, c in enumerate(chars)}
        self.classes = np.zeros(0x110000, np.int32)
        self.classes[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.classes[ord(" ")] = self.classes[ord(SPACE)]
        self.joins = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for p in known:
            for a, b in zip(p, p[1:], strict=False):
                self.joins[class_of[a], class_of[b]] = True
        # Symbols: ids of pieces, then characters that are no piece by themselves.
        self.symbols = known | {c: len(names) + i for i, c in enumerate(chars) if c not in known}
        self.width = len(names) + len(chars)
        self.gap = next(c for c in map(chr, range(0x10FFFF, 0, -1)) if c not in class_of)

        # Pairs of symbols that make a piece, in order; ranks go up as scores go down.
        levels = {s: r for r, s in enumerate(sorted({scores[i] for i in known.values()}, reverse=True))}
        rank = {p: levels[scores[i]] for p, i in known.items()}
        pairs, shared = [], np.zeros(len(levels) + 1, np.int64)
        single = np.zeros(len(levels) + 1, bool)
        for p, i in known.items():
            shared[rank[p]] += len(p) > 1
            for k in range(1, len(p)):
                a, b = self.symbols.get(p[:k]), self.symbols.get(p[k:])
                if a is not None and b is not None:
                    pairs.append((a * self.width + b, rank[p], i))
                    for part in (p[:k], p[k:]):
                        if part in rank and rank[p] <= rank[part]:
                            single[rank[part]] = True
        found = np.array(sorted(pairs), np.int64).reshape(-1, 3)
        self.pairs, self.ranks, self.made = found.T.copy()
        #: Ranks of which a round merges one place per word.
        self.single = single | (shared > 1)

        self.decimals = Spelling([b"%d," % i for i in range(len(names))])
        surface = {CONTROL: "", UNKNOWN: " ⁇ "}
        self.surface = Spelling(
            [
                bytes([self.byte_ids.index(i)]) if k == BYTE else surface.get(k, p.replace(SPACE, " ")).encode()
                for i, (p, k) in enumerate(zip(names, kinds, strict=True))
            ]
        )
        self.words: dict[str, bytes] = {}
        longest = max(map(len, known))
        self.reach = 3 * longest + 3
        #: Long runs of spaces are cut at multiples of this, if they are encoded so anyway.
        self.run = max((len(p) for p in known if not p.strip(SPACE)), default=0)
        ids = [self._spaces(n) for n in range(5 * self.run + 1)]
        if any(ids[n] != ids[self.run] + ids[n - self.run] for n in range(2 * self.run, len(ids))):
            self.run = 0

    def _spaces(self, n: int) -> list[int]:
        symbols = np.full(n, self.symbols.get(SPACE, 0))
        return self.merge_rounds(symbols, np.zeros(n, np.int64))[0].tolist()

    # -- encoding

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (_NONE where it makes no piece) and its place among the pairs."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], _NONE), at

    def merge_rounds(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the symbols of many words, which follow each other; ``word`` numbers them upwards
        from 0. Returns the symbols that are left, in the same order, and their words."""
        done_symbols, done_words = [], []
        while len(symbols):
            last = np.append(word[1:] != word[:-1], True)
            rank, place = self._pair_ranks(symbols, np.append(symbols[1:], 0))
            rank[last] = _NONE
            starts = np.flatnonzero(np.append(True, last[:-1]))
            sizes = np.diff(np.append(starts, len(symbols)))
            least = np.minimum.reduceat(rank, starts)
            alive = least < _NONE
            if not alive.all():
                stays = np.repeat(alive, sizes)
                done_symbols.append(symbols[~stays])
                done_words.append(word[~stays])
                symbols, word, rank, place = symbols[stays], word[stays], rank[stays], place[stays]
                least, sizes = least[alive], sizes[alive]
                if not len(symbols):
                    break
            clear = rank == np.repeat(least, sizes)
            first = np.zeros(len(rank), bool)
            at = np.flatnonzero(clear)
            first[at[np.append(True, word[at[1:]] != word[at[:-1]])]] = True
            far = np.repeat(sizes > LONG, sizes)
            if far.any():
                clear[far], first[far] = self._windows(rank[far])
            # Of places that overlap in a row every second is taken, from the left.
            n = np.arange(len(rank))
            begins = np.append(True, rank[1:] != rank[:-1])
            start = np.maximum.accumulate(np.where(begins, n, 0))
            taken = clear & clear[start] & ((n - start) % 2 == 0)
            at = np.flatnonzero(taken & (first | ~self.single[np.where(taken, rank, 0)]))
            symbols[at] = self.made[place[at]]
            stays = np.ones(len(symbols), bool)
            stays[at + 1] = False
            symbols, word = symbols[stays], word[stays]
        if not done_words:
            return symbols, word
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def _windows(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """In long words, a pair need not wait for the whole word: it is next if none within ``reach``
        symbols is better, as all that happens before its turn starts from a better pair and ends
        within a piece of that pair. Returns whether a pair is next, and whether it is so alone:
        before it, none within reach is as good."""
        before, after = rank.copy(), rank.copy()
        step = 1
        while step < self.reach:
            np.minimum(before[step:], before[:-step].copy(), out=before[step:])
            np.minimum(after[:-step], after[step:].copy(), out=after[:-step])
            step *= 2
        known = rank < _NONE
        alone = np.append(True, rank[1:] < before[:-1])
        return known & (rank <= before) & (rank <= after), known & alone & (rank <= after)

    def _learn(self, words: list[str]) -> None:
        """Encode new words: characters without a piece, and words to be merged."""
        plain = []
        for w in words:
            if any(c not in self.symbols for c in w):
                self.words[w] = np.array([self.byte_ids[b] for b in w.encode()], "<u4").tobytes()
            else:
                plain.append(w)
        if not plain:
            return
        sizes = np.fromiter(map(len, plain), np.int64, len(plain))
        symbols = np.fromiter(map(self.symbols.__getitem__, "".join(plain)), np.int64, int(sizes.sum()))
        symbols, word = self.merge_rounds(symbols, np.repeat(np.arange(len(plain)), sizes))
        ends = np.cumsum(np.bincount(word, minlength=len(plain))) * 4
        raw = symbols.astype("<u4").tobytes()
        loose = set(word[symbols >= len(self.names)].tolist())  # characters that are no piece
        begin = 0
        for i, (w, end) in enumerate(zip(plain, ends.tolist(), strict=True)):
            self.words[w] = raw[begin:end] if i not in loose else self._with_bytes(raw[begin:end])
            begin = end

    def _with_bytes(self, raw: bytes) -> bytes:
        text_of = {i: c for c, i in self.symbols.items()}
        ids: list[int] = []
        for i in np.frombuffer(raw, "<u4").tolist():
            ids += [i] if i < len(self.names) else [self.byte_ids[b] for b in text_of[i].encode()]
        return np.array(ids, "<u4").tobytes()

    def _ids(self, words: list[str]) -> list[bytes]:
        new = [w for w in words if w not in self.words]
        if len(self.words) + len(new) > MAX_WORDS:
            self.words, new = {}, words
        self._learn(new)
        return [self.words[w] for w in words]

    def _chunk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts that are not empty, one after the other, and how many each has."""
        joined = self.gap.join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        classes = self.classes[points]
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
        starts = np.ones(len(points), bool)
        starts[1:] = ~self.joins[classes[:-1], classes[1:]]
        starts[0] = True
        starts[ends[:-1]] = starts[ends[:-1] + 1] = True
        if self.run and SPACE * (3 * self.run) in joined:
            for match in re.finditer(f"{SPACE}{{{3 * self.run},}}", joined):
                starts[match.start() : match.end() - 2 * self.run : self.run] = True
        at = np.flatnonzero(starts)
        utf8 = np.ones(len(points) + 1, np.int64)
        utf8[1:] += (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        utf8[0] = 0
        byte_at = np.cumsum(utf8)
        offsets = np.append(byte_at[at], byte_at[-1])
        words = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(joined.encode()))
        text_of = np.searchsorted(ends, at)
        own = np.ones(len(at), bool)
        own[np.searchsorted(at, ends[:-1])] = False  # the gaps between texts
        coded = words.dictionary_encode()
        numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[own]
        raw = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(b"".join(raw), "<u4")
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        begins = np.cumsum(sizes) - sizes
        n = sizes[numbers]
        to = np.cumsum(n)
        place = np.repeat(begins[numbers] - (to - n), n)
        place += np.arange(len(place))
        counts = np.bincount(text_of[own], weights=n, minlength=len(texts)).astype(np.int64)
        return flat[place], counts

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of the texts, in their order, by chunks: (the ids of some texts one after the
        other, how many each has). A null text is empty."""
        some: list[str] = []
        size = 0
        for text in pc.fill_null(texts.cast(pa.large_string()), "").to_numpy(zero_copy_only=False):
            if size + len(text) > CUT and some:
                yield self.encode_texts(some)
                some, size = [], 0
            some.append(text)
            size += len(text)
        if some:
            yield self.encode_texts(some)

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts one after the other, and how many each has."""
        blocks, owner = [], []
        for i, text in enumerate(texts):
            if not text:
                continue
            marked = SPACE + text.replace(" ", SPACE)
            for block in _blocks(marked) if len(marked) > CUT else [marked]:
                blocks.append(block)
                owner.append(i)
        if not blocks:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        if len(texts) == 1 and len(blocks) > 1:  # a very long text
            parts = [self._chunk([b])[0] for b in blocks]
            return np.concatenate(parts), np.array([sum(map(len, parts))])
        ids, counts = self._chunk(blocks)
        return ids, np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64)

    # -- decoding

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> Iterator[bytes]:
        """The text of each run of ids, in UTF-8. Bytes that are no character become U+FFFD, as of
        the library; so such runs are decoded part by part."""
        ends = np.cumsum(counts)
        spelled = self.surface.spell(ids)
        byte_ends = np.append(0, np.cumsum(self.surface.sizes[ids]))[ends]
        odd = np.append(0, np.cumsum((self.kinds == BYTE)[ids] | (self.kinds == CONTROL)[ids]))
        begin = at = 0
        for end, byte_end in zip(ends.tolist(), byte_ends.tolist(), strict=True):
            if odd[end] > odd[begin]:
                yield self._decoded(ids[begin:end])
            else:
                raw = spelled[at:byte_end].tobytes()
                # The space that encoding added; the first piece may also be the unknown one.
                known = begin < end and self.kinds[ids[begin]] != UNKNOWN
                yield raw[1:] if known and raw[:1] == b" " else raw
            begin, at = end, byte_end

    def _decoded(self, ids: np.ndarray) -> bytes:
        out: list[bytes] = []
        at_start = True
        is_byte = (self.kinds == BYTE)[ids]
        cuts = np.flatnonzero(np.diff(is_byte)) + 1
        for begin, end in zip([0, *cuts], [*cuts, len(ids)], strict=True):
            if is_byte[begin]:
                out.append(_characters(self.surface.spell(ids[begin:end]).tobytes()))
                at_start = False
                continue
            raw = self.surface.spell(ids[begin:end]).tobytes()
            if at_start:
                seen = np.flatnonzero(self.kinds[ids[begin:end]] != CONTROL)
                if len(seen):
                    at_start = False
                    if self.kinds[ids[begin + seen[0]]] != UNKNOWN and raw[:1] == b" ":
                        raw = raw[1:]
            out.append(raw)
        return b"".join(out)


def _characters(raw: bytes) -> bytes:
    """UTF-8 with U+FFFD for each byte that belongs to no character."""
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as error:
            out.append(raw[at : at + error.start].decode() + "�")
            at += error.start + 1
    return "".join(out).encode()


def _blocks(text: str) -> Iterator[str]:
    """A long text in blocks: no piece reaches over the start of a run of spaces."""
    begin = 0
    for match in re.finditer(f"(?<!{SPACE}){SPACE}", text):
        if match.start() - begin >= CUT:
            yield text[begin : match.start()]
            begin = match.start()
    yield text[begin:]


@lru_cache(maxsize=1)
def model(path: str) -> PieceModel:
    """The worker's model: a worker that runs several tasks keeps its words."""
    return PieceModel(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, the ids of every whole text (without begin or end ids), and the text decoded from
    them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            at = 0
            for ids, counts in own.encode(batch.column(1)):
                offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
                texts = [raw.decode() for raw in own.decode(ids, counts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(counts)), lists, pa.array(texts, pa.string())],
                    ["doc_id", "ids", "decoded"],
                )
                at += len(counts)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the decimal ids joined by commas and of the decoded text,
    without sending ids and texts back to the JVM."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            at = 0
            for ids, counts in own.encode(batch.column(1)):
                decimal = own.decimals.spell(ids)
                ends = np.append(0, np.cumsum(own.decimals.sizes[ids]))[np.cumsum(counts)].tolist()
                numbers, begin = [], 0
                for end in ends:
                    numbers.append(hashlib.sha256(decimal[begin : max(begin, end - 1)]).hexdigest())
                    begin = end
                texts = [hashlib.sha256(raw).hexdigest() for raw in own.decode(ids, counts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(counts)), pa.array(counts), pa.array(numbers), pa.array(texts)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
                at += len(counts)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
