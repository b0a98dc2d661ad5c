"""Encoding, decoding and alignment against the libraries and plain Python."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers
from helpers import awkward, table

from postern.llm import align, sentencepieces
from postern.llm.common import table as read
from postern.llm.queries import BYTE_TOKENIZER, PIECE_MODEL, QUERIES


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


@pytest.fixture(scope="module")
def own():
    return sentencepieces.PieceModel(PIECE_MODEL)


def _texts(own) -> list[str | None]:
    rng = random.Random(3)
    some = lambda of, most: "".join(rng.choice(of) for _ in range(rng.randrange(most)))
    pieces = [p for p in own.symbols if len(p) > 2]
    out = [None, "", " ", "  a", "a  b ", "▁", "\0", "<s>x</s><0x0A>", "\U0010ffff a\U0010ffff", "é日本\U0001f600ß"]
    out += [c * n + e for c in " a=-▁b" for n in (3, 61, 700) for e in ("", "x", " the")]
    out += [some("abcdeABC  ▁\t\n\0.<>0x1é日本你好\U0001f600", 40) for _ in range(1500)]
    out += [some("abnrstheio", 60) for _ in range(1500)]
    out += [some(pieces, 40) for _ in range(1500)]
    return out + [some("abab=-", 300) for _ in range(300)]


@pytest.mark.parametrize(("cut", "long"), [(2_000_000, 512), (2_000_000, 8), (50, 8)])
def test_pieces_equal_the_library(own, library, monkeypatch, cut, long):
    monkeypatch.setattr(sentencepieces, "CUT", cut)
    monkeypatch.setattr(sentencepieces, "LONG", long)
    own.words.clear()
    texts = _texts(own)
    at = 0
    for ids, counts in own.encode(pa.array(texts, pa.string())):
        begin = 0
        for n, decoded in zip(counts.tolist(), own.decode(ids, counts), strict=True):
            wanted = library.encode(texts[at] or "")
            assert ids[begin : begin + n].tolist() == wanted
            assert decoded.decode() == library.decode(wanted)
            begin, at = begin + n, at + 1
    assert at == len(texts)


def test_a_long_word_takes_few_rounds(own, library):
    word = "".join(random.Random(1).choice("etaoinshrdlu") for _ in range(20_000)) + " " * 20_000
    (ids, _), *rest = own.encode(pa.array([word]))
    assert not rest and ids.tolist() == library.encode(word)


def test_the_memory_of_words_is_bounded(own, library, monkeypatch):
    monkeypatch.setattr(sentencepieces, "MAX_WORDS", 40)
    for text in ("some words to be kept and others", " ".join(f"new{i} w{i}x" for i in range(30))):
        ((ids, _),) = own.encode(pa.array([text]))
        assert ids.tolist() == library.encode(text) and len(own.words) <= 100


def test_decoding_any_ids(own, library):
    rng = random.Random(5)
    odd = [0, 1, 2, 3 + 32, 3 + 0xE4, 3 + 0xBD, 3 + 0xA0, 259, 300]
    for _ in range(4000):
        ids = [rng.choice([*odd, rng.randrange(32_000)]) for _ in range(rng.randrange(7))]
        (found,) = own.decode(np.array(ids, np.uint32), np.array([len(ids)]))
        assert found.decode() == library.decode(ids)


def _sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def test_sentencepiece_query(spark, docs, library):
    def wanted(doc_id, text):
        ids = library.encode(text or "")
        return doc_id, len(ids), _sha(",".join(map(str, ids))), _sha(library.decode(ids))

    found = sentencepieces.digests(docs, PIECE_MODEL)
    rows = [(r[0], r[1]) for r in awkward()]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted((wanted(*r) for r in rows), key=repr)
    encoded = sentencepieces.encode_documents(docs, PIECE_MODEL).collect()
    assert sorted(((r.doc_id, len(r.ids), _sha(",".join(map(str, r.ids))), _sha(r.decoded)) for r in encoded), key=repr) == sorted(
        (wanted(*r) for r in rows), key=repr
    )
    assert sentencepieces.digests(docs.limit(0), PIECE_MODEL).count() == 0


@pytest.mark.parametrize("steps", [1, 2, 3, 7, 256])
def test_merge_path_pieces_agree_with_a_plain_merge(steps):
    rng = random.Random(steps)
    for _ in range(60):
        end = rng.randrange(1, 60)
        a, b = (sorted({*rng.sample(range(1, end + 1), rng.randrange(1, end + 1)), end}) for _ in "ab")
        at_a, at_b, takes_a, links, group = align.merge_path(np.array(a), np.array(b), steps)
        plain, i, j, g = [], 0, 0, 0
        while i < len(a) or j < len(b):
            if i < len(a) and a[i] <= b[j]:
                plain.append((i, j, True, True, g))
                i += 1
            else:
                tie = i > 0 and a[i - 1] == b[j]
                plain.append((i, j, False, not tie, g))
                g, j = g + tie, j + 1
        assert list(zip(at_a, at_b, takes_a, links, group, strict=True)) == plain


def plain_alignment(texts: list[str | None]) -> list[tuple]:
    """The contract of op11 by plain loops over the libraries' tokens."""
    a_lib = tokenizers.Tokenizer.from_file(BYTE_TOKENIZER)
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    level = align.byte_level()

    def spelled_b(i):
        piece = b_lib.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_lib.is_byte(i) else piece.replace("▁", " ").encode()

    docs = []
    for text in texts:
        a = [(i, bytes(level[c] for c in a_lib.id_to_token(i))) for i in a_lib.encode(" " + text, add_special_tokens=False).ids] if text else []
        b = [(i, spelled_b(i)) for i in b_lib.encode(text)] if text else []
        whole = (" " + text).encode() if text else b""
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            a, b = [], []
        spans = []
        for tokens in (a, b):
            at, own = 0, []
            for i, raw in tokens:
                own.append((i, at, at + len(raw)))
                at += len(raw)
            spans.append(own)
        links = [(x[0], y[0]) for x in spans[0] for y in spans[1] if x[1] < y[2] and y[1] < x[2]] if len(whole) < 3000 else None
        if links is None:  # long: the same by walking
            links, j = [], 0
            for i, s, e in spans[0]:
                while spans[1][j][2] <= s:
                    j += 1
                k = j
                while k < len(spans[1]) and spans[1][k][1] < e:
                    links.append((i, spans[1][k][0]))
                    k += 1
        ends = sorted({x[2] for x in spans[0]} & {x[2] for x in spans[1]})
        groups, low = [], 0
        for high in ends:
            ids = [",".join(str(i) for i, s, e in own if low <= s and e <= high) for own in spans] if len(whole) < 3000 else None
            groups.append(ids and "|".join(ids))
            low = high
        docs.append((len(a), len(b), len(ends), links, _sha(";".join(groups)) if a and len(whole) < 3000 else ("" if not a else None)))
    count = collections.Counter(p for d in docs for p in set(d[3]))
    best = collections.Counter()
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [
        (n_a, n_b, n, len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), sha)
        for n_a, n_b, n, links, sha in docs
    ]


def _same(found, wanted):
    """Digests of long texts are not held against the plain loops."""
    blank = {w[:-1] for w in wanted if w[-1] is None}
    hidden = lambda rows: sorted((*r[:-1], None) if r[:-1] in blank else r for r in rows)
    key = lambda rows: sorted(map(repr, rows))
    return key(hidden(found)) == key(hidden(wanted))


@pytest.mark.parametrize(("block", "chunk"), [(2_000_000, 8_000_000), (500, 900)])
def test_alignment_equals_plain_loops(spark, docs, monkeypatch, block, chunk):
    monkeypatch.setattr(align, "BLOCK", block)
    monkeypatch.setattr(align, "CHUNK", chunk)
    extra = ["<|endoftext|> x <s>", "a▁b", " two  spaces ", "日本 \U0001f600!", "tab\tand\nline", "▁"]
    rows = awkward() + [(1000 + i, t, None, None, None, None, None) for i, t in enumerate(extra)]
    found = align.count_links(table(spark, rows), BYTE_TOKENIZER, PIECE_MODEL).collect()
    assert sorted((r[0] for r in found), key=repr) == sorted((r[0] for r in rows), key=repr)
    assert _same([tuple(r)[1:] for r in found], plain_alignment([r[1] for r in rows]))


def test_alignment_of_no_rows(spark, docs):
    assert align.count_links(docs.limit(0), BYTE_TOKENIZER, PIECE_MODEL).count() == 0


def test_links_are_the_overlaps(spark):
    texts = ["Unbelievable tokenization, naïvely!", "", None, "x" * 300 + " <|endoftext|>"]
    rows = [(i, t, None, None, None, None, None) for i, t in enumerate(texts)]
    found = {r.doc_id: r for r in align.links(table(spark, rows), BYTE_TOKENIZER, PIECE_MODEL).collect()}
    plain = plain_alignment(texts)
    for i, (n_a, n_b, n_groups, n_links, *_) in enumerate(plain):
        row = found[i]
        assert (len(row.a), len(row.b), len(row.group_a), len(row.link_a)) == (n_a, n_b, n_groups, n_links)
        assert (sum(row.group_a), sum(row.group_b)) == (n_a, n_b)
        assert sorted(set(row.link_a)) == list(range(n_a)) and sorted(set(row.link_b)) == list(range(n_b))


def test_alignment_query(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text").collect()
    found = QUERIES["op11_token_alignment"](spark, sf_dir).collect()
    assert _same([tuple(r)[1:] for r in found], plain_alignment([r.text for r in docs]))
