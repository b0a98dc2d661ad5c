"""Round trips through files, packing, vectors, and the pipeline."""

from __future__ import annotations

import base64
import collections
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import as_rows, awkward
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postern.llm import ann, packing, tokenbin, warc
from postern.llm.queries import BYTE_TOKENIZER, WORD_TOKENIZER
from postern.llm.tokens import Encoder

ODD = ["", " ", "  a", "a  b", "a   b ", "\n\n a\nb\n", "x\x1cy z", "  b", "a  b", "İ. Σa. aΣ,", "don't stop.", "<|endoftext|> a <|endoftext|>", "é é J̌", "１２ 3.4, 5"]
ODD += ["a\nb\nc", "a\n", "\na", "a \nb", "a\n b", "a\n\nb", "a\t\nb.\nc!!", "w$$$ x.%%% it's. a'.s", "a-b (c) d_e <\u0338 =\u0338", "x\x1fy\nz", ".,$ !", "Ab,\nCd."]


@pytest.mark.parametrize("path,kind", [(WORD_TOKENIZER, "word"), (BYTE_TOKENIZER, "byte")])
def test_encoder_equals_tokenizer(path, kind, monkeypatch):
    plain = Tokenizer.from_file(path)
    texts = ODD + [r[1] for r in awkward()]
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    got = [np.frombuffer(x, "<u4").tolist() for x in Encoder(path, kind).encode(pa.array(texts))]
    assert got == want
    monkeypatch.setattr("postern.llm.tokens.MAX_PIECES", 5)
    # The same encoder over small chunks several times: words come from both halves of its memory.
    small = Encoder(path, kind)
    for _ in range(3):
        again = [np.frombuffer(x, "<u4").tolist() for x in small.encode(pa.array(texts), 50)]
        assert again == want
    for none in ([], [None, ""], ["..."]):
        assert len(list(small.encode(pa.array(none, pa.string())))) == len(none)


def test_token_files(spark, docs, tmp_path):
    plain = Tokenizer.from_file(WORD_TOKENIZER)
    folder = f"file://{tmp_path}/tokens"
    manifest = tokenbin.write_tokens(docs, folder, WORD_TOKENIZER, "word", 1, 49_408)
    rows = sorted(awkward(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, want = 0, []
    for r in rows:
        ids = plain.encode(r[1] or "", add_special_tokens=False).ids + [1]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert as_rows(tokenbin.read_tokens(spark, folder)) == sorted(want, key=repr)
    assert sum(r.n_tokens for r in manifest.collect()) == start
    file = tokenbin.TokenFile(manifest.first()["file"])
    assert isinstance(file.ids, np.memmap) and file.ids.dtype == np.uint16
    empty = f"file://{tmp_path}/none"
    tokenbin.write_tokens(docs.limit(0), empty, WORD_TOKENIZER, "word", 1, 49_408)
    assert tokenbin.read_tokens(spark, empty).count() == 0


def test_best_fit():
    assert packing.cut(2500, 1024) == [(0, 452), (452, 1024), (1476, 1024)]
    assert packing.cut(1024, 1024) == [(0, 1024)] and packing.cut(3, 1024) == [(0, 3)]
    # 60 goes to the fuller of the open bins; with one open bin the fullest closes.
    assert packing.best_fit([70, 30, 40, 60], 100) == [(0, 0), (0, 70), (1, 0), (1, 40)]
    assert packing.best_fit([50, 70, 30, 50], 100, 1) == [(0, 0), (1, 0), (1, 70), (2, 0)]
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 1025, 4000).tolist()
    places = packing.best_fit(sizes)
    assert max(s for s, _ in places) + 1 <= 1.03 * sum(sizes) / 1024 + 1


def test_packing(spark, docs):
    plain = Tokenizer.from_file(BYTE_TOKENIZER)
    out = packing.pack_documents(docs, BYTE_TOKENIZER, "byte", 2).collect()
    want = []
    for r in awkward():
        ids = plain.encode(r[1] or "", add_special_tokens=False).ids + [2]
        for i, (s, n) in enumerate(packing.cut(len(ids), 1024)):
            want.append((r[0], i, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())))
    assert sorted([tuple(r)[:5] for r in out], key=repr) == sorted(want, key=repr)
    by = collections.defaultdict(list)
    for r in out:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 1024
    assert packing.pack_documents(docs.limit(0), BYTE_TOKENIZER, "byte", 2).count() == 0


def test_sequences_rebuild_the_documents(spark, docs):
    rows = awkward()
    found = packing.sequences(docs, BYTE_TOKENIZER, "byte", end_id=2).collect()
    library = Tokenizer.from_file(BYTE_TOKENIZER)
    got = collections.defaultdict(list)
    for r in found:
        assert len(r.ids) <= packing.LENGTH and sum(p.length for p in r.pieces) == len(r.ids)
        at = 0
        for p in r.pieces:
            assert p.offset == at
            got[p.doc_id].append((p.piece, tuple(r.ids[at : at + p.length])))
            at += p.length
    want = collections.defaultdict(list)
    for r in rows:
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, 2]
        want[r[0]] += [(i, tuple(ids[s : s + n])) for i, (s, n) in enumerate(packing.cut(len(ids), packing.LENGTH))]
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_a_doc_id_of_many_rows_lies_in_several_files(spark, tmp_path):
    rows = [(None, f"text {i % 3}") for i in range(4000)] + [(i, "x") for i in range(200)]
    folder = f"file://{tmp_path}/tokens"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = tokenbin.write_tokens(
            spark.createDataFrame(rows, "doc_id long, text string"), folder, WORD_TOKENIZER, "word", 1, 49_408
        ).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(files) == 8 and max(f.n_docs for f in files) < 1000
    read = sorted(tokenbin.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in read]
    assert ids == [None] * 4000 + list(range(200))
    assert all(b.start == a.start + a.n_tokens for a, b in zip(read, read[1:], strict=False))


def test_equal_rows_are_packed_in_all_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET", 1)
    rows = [(None, None)] * 3000 + [(None, "the same")] * 1500
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = packing.pack_documents(docs, BYTE_TOKENIZER, "byte", 2)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    per = collections.Counter(r.sequence_id >> 32 for r in out.collect())
    assert len(per) > 3 and sum(per.values()) == 4500
    assert max(per.values()) < 2 * 4500 / len(per)


PAGES = "page_id long, url string, html string, length int, first string"


def pages(spark):
    nested = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\n" * 3
    hostile = [f"WARC/1.0\r\nContent-Length: {n}\r\n\r\n" for n in ("²", "9" * 20, "9" * 18, "٣", "-1", "", "1_0")]
    htmls = [*hostile, hostile[0], "<p>a</p>", "<p>a</p>", None, "", nested, "é" * 5000, nested + "x", "WARC/1.0\r\n", "b\r\n\r\n"]
    rows = [(i, f"http://x/{i}\r\nEvil: 1" if i % 2 else None, h, 1, "q") for i, h in enumerate(htmls)]
    rows += [rows[13], rows[13], rows[13], (None, None, "<p>a</p>", None, None), (None, None, "only", None, None)]
    rows += [(100 + i, "u", f"page {i} " * (i * 7 % 90), 1, "q") for i in range(60)]
    return rows


@pytest.mark.parametrize("chunk", [64, 5000, 1 << 24])
def test_warc_round_trip(spark, tmp_path, chunk):
    rows = pages(spark)
    folder = f"file://{tmp_path}/warc"
    warc.write_archives(spark.createDataFrame(rows, PAGES).coalesce(2), folder, records_per_file=25)
    read = warc.read_archives(spark, folder, chunk)
    assert read.filter("not agrees").count() == 0
    got = [tuple(r) for r in warc.resolved(read).collect()]
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[2] or ""].append(r[0])
    want = []
    for html, ids in groups.items():
        raw = html.encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        first, *rest = sorted(ids, key=lambda i: (i is None, -(i or 0)))
        want.append((first, len(raw), digest, "response", None))
        want += [(i, len(raw), digest, "revisit", first) for i in rest]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_warc_empty_and_least_size(spark, tmp_path):
    df = spark.createDataFrame(pages(spark), PAGES)
    warc.write_archives(df.limit(0), f"file://{tmp_path}/none")
    assert warc.read_archives(spark, f"file://{tmp_path}/none").count() == 0
    warc.write_archives(df, f"file://{tmp_path}/big", min_bytes=10_000)
    kinds = warc.read_archives(spark, f"file://{tmp_path}/big").filter("record_type = 'revisit'")
    assert [r.page_id for r in kinds.collect()] == [13] * 3


def test_ann_answers_every_length_and_size_of_vectors(spark, monkeypatch):
    """Two lengths, both with several partitions, and components whose products overflow."""
    monkeypatch.setattr(ann, "PART", 150)
    monkeypatch.setattr(ann, "QUERIES", 16)
    rng = np.random.default_rng(5)
    sets = [rng.standard_normal((600, 8)), rng.standard_normal((500, 16)), np.array([[1e200] * 8, [-1e200] * 8, [1e200, -1e200] * 4, [1e-200] * 8])]
    vectors = [v for some in sets for v in some] + [np.array([3.0])]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    asked = [*range(0, 1100, 20), 1100, 1101, 1102, 1103, 1104]
    out = ann.search(df, df.filter(F.col("vec_id").isin(asked)), 20).collect()
    got = collections.defaultdict(list)
    for r in sorted(out, key=lambda r: r["rank"]):
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(asked) - {1104}  # the only one of its length finds nothing
    hits = wanted = 0
    with np.errstate(over="ignore", invalid="ignore"):
        for q, found in got.items():
            alike = [i for i, v in enumerate(vectors) if len(v) == len(vectors[q]) and i != q]
            score = {i: (vectors[i] * vectors[q]).sum() for i in alike}
            score = {i: -np.inf if np.isnan(v) else v for i, v in score.items()}
            assert len(found) == 20 and found == sorted(found, key=lambda f: (-f[1], f[0]))
            assert all(s == pytest.approx(score[v], rel=1e-12) for v, s in found)
            true = sorted(alike, key=lambda i: (-score[i], i))[:20]
            hits, wanted = hits + len(set(true) & {v for v, _ in found}), wanted + 20
    assert hits >= 0.9 * wanted


def test_ann_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.standard_normal((4000, 16)), 3)
    x[1000:2500] = x[0]  # a vector with a third of all rows
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(5000, None, 1), (5001, [0.0] * 16, 1), (5002, [float("nan")] * 16, 1), (5003, [1.0, None] * 8, 1), (None, x[3].tolist(), 1), (5004, [], 1), (5005, [1.0, 2.0], 2), (7, x[7].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, part int")
    old, ann.PART = ann.PART, 300
    try:
        out = ann.search(df, df.filter("vec_id % 20 = 0"), 20).collect()
    finally:
        ann.PART = old
    got = collections.defaultdict(list)
    for r in sorted(out, key=lambda r: r["rank"]):
        got[r.query_id].append((r.vec_id, r.score))
    # The one vector of two components, a query too, has no candidate.
    assert set(got) == set(range(0, 4000, 20))
    hits = 0
    for q, found in got.items():
        score = x @ x[q]
        assert [s for _, s in found] == pytest.approx([score[v] for v, _ in found], abs=1e-12)
        assert [(-s, v) for v, s in found] == sorted((-s, v) for v, s in found) and q not in dict(found)
        score[q] = -np.inf
        hits += len(set(np.lexsort((np.arange(len(x)), -score))[:20].tolist()) & set(dict(found)))
    assert hits / (20 * len(got)) >= 0.9
    assert ann.search(df.limit(0), df.limit(0)).count() == 0
    few = df.filter("vec_id in (0, 1, 2)")
    assert as_rows(ann.search(few, few).select("query_id", "rank"))[:2] == [(0, 1), (0, 2)]


def test_pipeline(spark, sf_dir):
    import corpus_pipeline
    from helpers import WORD, components, secret_spans, simhash

    from postern.llm import mixture, quality
    from postern.llm.common import written

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect() if i < 4 else None
        docs = written(stage(spark, docs, sf_dir), name)
        kept[name] = docs
        if name == "quality_rules":
            good = {r.doc_id for r in quality.judge(spark.read.parquet(f"{sf_dir}/documents.parquet")).filter("kept").collect()}
            assert {r.doc_id for r in docs.collect()} == good
        elif name == "simhash_near_dedup":
            rows = sorted(before, key=lambda r: r.doc_id)
            first = components([simhash(r.text) for r in rows])
            assert {r.doc_id for r in docs.collect()} == {rows[g].doc_id for g in first}
        elif name == "secret_scans":
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before}
            assert not any(secret_spans(r.text) for r in docs.collect())
        elif name == "source_mix":
            words = collections.Counter()
            for r in docs.collect():
                words[r.doc_id] += len(WORD.findall(r.text))
            taken = {r.doc_id: r.taken for r in mixture.mix(kept["secret_scans"]).collect()}
            assert words == {d: n for d, n in taken.items() if n}
    assert sum(r["length"] for r in docs.collect()) > 0
    assert as_rows(corpus_pipeline.run(spark, sf_dir)) == as_rows(docs)
    assert [len(kept[n].columns) for n, _ in corpus_pipeline.STAGES[:4]] == [5, 5, 5, 5]


def test_queries_match_sql(spark, sf_dir):
    import duckdb
    from oracle_check import compare

    from postern.llm.queries import ORACLE, QUERIES

    con = duckdb.connect()
    for name in ("documents", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    for name, sql in ORACLE.items():
        assert compare(QUERIES[name](spark, sf_dir), con, sql) is None, name
