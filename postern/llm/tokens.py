"""Token ids of whole texts by a public tokenizer file, with a bounded cache of pieces.

Prose repeats its words, so texts are cut into pieces at places where the tokenizer itself always
cuts; a batch's distinct pieces are found by Arrow's dictionary encoding, each new one is encoded
once, and the ids of the pieces are put together in order. Where a text holds what could make a
piece depend on its surroundings, the whole text goes to the tokenizer instead; so the ids always
equal those of ``Tokenizer.encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import os
import string
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words and other keys kept by one Python worker (some 200 bytes each), half of them of late.
MAX_PIECES = 400_000
#: Characters of texts cut together, and words encoded as one string.
CUT, JOINED = 4_000_000, 50

# White space of Python that the tokenizers take as ordinary characters, and special tokens' start.
_WHOLE = r"[\x1c-\x1f]|<\|"
# White space before a space: the two may be part of one token.
_SPACE = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_RUN = f"{_SPACE} "
# A line end next to white space, which may change how either is cut.
_TOUCHED = rf"{_SPACE}\n|\n{_SPACE}"
# Punctuation that is cut from the word before it. An apostrophe may begin a token with letters.
_ENDINGS = string.punctuation.replace("'", "")
# Marks cuts; texts that hold it are encoded whole.
_MARK = "\x1f"


def _list(column: pa.Array) -> list:
    """The values as Python's, several times as fast as to_pylist()."""
    return column.to_numpy(zero_copy_only=False).tolist()


def _gather(flat: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` with these numbers, one after the other, and where each ends; ``sizes``
    are those of all runs in ``flat``."""
    begins = np.cumsum(sizes) - sizes
    n = sizes[numbers]
    to = np.cumsum(n)
    return flat[np.repeat(begins[numbers] - (to - n), n) + np.arange(int(to[-1]) if len(to) else 0)], to


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids. Kinds of tokenizers: of "word", white
    space ends every token and is dropped; of "byte", a token takes one space before it,
    and a line end that no white space touches is one."""

    def __init__(self, path: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.word = kind == "word"
        # Lower case of a sigma depends on its place, that of a dotted I has a mark.
        self.plain = r"^[^\PLΣİ]+$" if self.word else r"^ ?\pL+$"
        self.whole = _WHOLE if self.word else f"{_WHOLE}|{_RUN}"
        self.cache: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.line_end = self.tokenizer.token_to_id("Ċ")  # that of "\n"; unused by kind "word"
        # The tokens that end a word (kind "word") or start with a space (kind "byte").
        self.border = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for name, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.border[i] = name.endswith("</w>") if self.word else name.startswith("Ġ")

    def one(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _split(self, pieces: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Plain pieces as a word and the punctuation after it, which makes tokens of its own: the
        distinct keys of these, and the numbers of each piece's two (the second may be empty). A
        plain piece's word is letters, of kind "byte" perhaps after a space, of kind "word" in lower
        case; any other piece is a key as it is."""
        words = pc.utf8_rtrim(pieces, characters=_ENDINGS)
        is_plain = pc.match_substring_regex(words, self.plain)
        n_bytes = pc.if_else(is_plain, pc.binary_length(words), pc.binary_length(pieces))
        keys = pc.if_else(is_plain, pc.utf8_lower(words) if self.word else words, pieces)
        # The rests lie in the pieces' own buffer, each from its word's end to its piece's end.
        starts = np.frombuffer(pieces.buffers()[1], "<i4")[pieces.offset :][: len(pieces) + 1]
        bounds = np.empty(2 * len(pieces) + 1, "<i4")
        bounds[0::2] = starts
        bounds[1::2] = starts[:-1] + n_bytes.to_numpy(zero_copy_only=False)
        halves = pa.StringArray.from_buffers(2 * len(pieces), pa.py_buffer(bounds), pieces.buffers()[2])
        rests = halves.take(pa.array(np.arange(1, 2 * len(pieces), 2)))
        coded = pa.concat_arrays([keys, rests]).dictionary_encode()
        numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        return coded.dictionary, numbers.reshape(2, -1).T

    def _learn(self, new: list[str]) -> None:
        """Encode new keys. Several words make one string, whose ids are cut again at the words'
        borders; if these don't count up, and for keys that are no words, each is encoded by itself."""
        known = self.cache
        given = pa.array(new, pa.string())
        is_plain = pc.match_substring_regex(given, self.plain)
        words, other = _list(given.filter(is_plain)), _list(given.filter(pc.invert(is_plain)))
        encode = lambda x: self.tokenizer.encode_batch_fast(x, add_special_tokens=False)
        # Words without a space before them go with a line end after each, always one token.
        bare = [] if self.word else [w for w in words if w[0] != " "]
        if bare:
            words = [w for w in words if w[0] == " "]
        for some, gap, after in ((words, " " if self.word else "", ""), (bare, "\n", "\n")):
            groups = [some[at : at + JOINED] for at in range(0, len(some), JOINED)]
            for group, found in zip(groups, encode([gap.join(g) + after for g in groups]), strict=True):
                ids = np.array(found.ids, "<u4")
                ends = (ids == self.line_end if after else self.border[ids]).nonzero()[0] * 4
                if len(ends) != len(group):
                    other += group
                    continue
                raw = ids.tobytes()
                if after:
                    starts, stops = [0, *(ends + 4).tolist()], ends.tolist()
                elif self.word:
                    starts, stops = [0, *(ends + 4).tolist()], (ends + 4).tolist()
                else:
                    starts, stops = ends.tolist(), [*ends[1:].tolist(), len(raw)]
                known.update(zip(group, map(raw.__getitem__, map(slice, starts, stops)), strict=True))
        known.update(
            (key, np.array(found.ids, "<u4").tobytes())
            for key, found in zip(other, encode(other), strict=True)
        )

    def _ids(self, keys: list[str]) -> list[bytes]:
        """The ids of distinct keys. Keys used since the older half was set aside make the newer one;
        the older one goes when the newer is full, so frequent keys stay."""
        raw = list(map(self.cache.get, keys))
        at = [i for i, r in enumerate(raw) if r is None]
        missed = [keys[i] for i in at]
        found = list(map(self.older.get, missed))
        self.cache.update((k, r) for k, r in zip(missed, found, strict=True) if r is not None)
        self._learn([k for k, r in zip(missed, found, strict=True) if r is None])
        for i, key in zip(at, missed, strict=True):
            raw[i] = self.cache[key]
        if 2 * len(self.cache) > MAX_PIECES:
            self.older, self.cache = self.cache, {"": b""}
        return raw

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """Where each text's pieces begin, the distinct pieces, and each piece's number in them."""
        if self.word:
            lists = pc.ascii_split_whitespace(texts)
        else:
            # Cuts stand before each space and around each line end that no white space touches.
            marked = pc.replace_substring(texts, " ", f"{_MARK} ")
            lines = pc.replace_substring(marked, "\n", f"{_MARK}\n{_MARK}")
            touched = pc.match_substring_regex(texts, _TOUCHED)
            lists = pc.split_pattern(pc.if_else(touched, marked, lines), _MARK)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.dictionary_encode()
        numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        return offsets, coded.dictionary, numbers

    def encode(self, texts: pa.Array, cut: int = CUT) -> Iterator[bytes]:
        """The ids of each text; a null text is empty. Chunks of ``cut`` characters are held at a time."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        ends = [*np.flatnonzero(np.diff(sizes // cut)) + 1, len(texts)]
        for start, end in zip([0, *ends], ends, strict=False):
            some = texts.slice(start, end - start)
            whole = pc.match_substring_regex(some, self.whole).to_numpy(zero_copy_only=False)
            offsets, distinct, numbers = self._cut(pc.if_else(pa.array(whole), "", some))
            keys, halves = self._split(distinct)
            raw = self._ids(_list(keys))
            flat = np.frombuffer(b"".join(raw), "<u4")
            sizes_of = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
            # First the ids of the distinct pieces from their halves', then those of the texts.
            flat, _ = _gather(flat, sizes_of, halves.ravel())
            ids, to = _gather(flat, sizes_of[halves].sum(axis=1), numbers)
            cuts = np.append(0, to)[offsets].tolist()
            for i, by_itself in enumerate(whole.tolist()):
                if by_itself:
                    yield self.one(some[i].as_py())
                else:
                    yield ids[cuts[i] : cuts[i + 1]].tobytes()


def give_back() -> None:
    """Return Arrow's free memory to the system; a worker that goes on to another task keeps it else."""
    pa.default_memory_pool().release_unused()


@lru_cache(maxsize=1)
def encoder(path: str, kind: str) -> Encoder:
    """The worker's encoder: a worker that runs several tasks keeps its pieces."""
    return Encoder(path, kind)
