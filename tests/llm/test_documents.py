"""Operators over documents against plain Python, on awkward rows and on the smallest tables."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import time

import helpers
import pytest
from helpers import as_rows, awkward, table

from postern.llm import licenses, mixture, quality, secret_scan, simhash, substrings


def test_quality_counts():
    text = "a b c a b c\n\n x#$\nx#$\n"
    words = helpers.WORD.findall(text)
    n, chars, symbols, lines, dup, repeated = quality.text_counts(text)
    assert (n, chars, symbols, lines, repeated) == (len(words), sum(map(len, words)), 4, 3, 6)
    assert dup == 0  # " x#$" and "x#$" differ
    assert quality.text_counts(None) == (0,) * 6


def test_quality_keeps_plain_and_drops_junk(spark):
    plain = [(i, " ".join(f"w{(i * 37 + j * j) % 997}x{j % 13}" for j in range(120)), "en", "a") for i in range(80)]
    junk = [(100, "#$% word " * 80, "en", "a"), (101, " ".join(f"u{j}###&&&***$$$" for j in range(90)), "en", "a")]
    rows = [(*r, None, None, None) for r in plain + junk]
    kept = {r.doc_id for r in quality.keep_good(table(spark, rows)).collect()}
    assert kept == {r[0] for r in plain}


def plain_verdicts(rows: list[tuple]) -> dict:
    """kept by the rules in plain Python, from exact sorted lists cut to the sketch's six digits."""
    cut = lambda v: v >> max(v.bit_length() - 6, 0) << max(v.bit_length() - 6, 0)
    floors = [20, 90, 90, 150]
    measured = []
    for doc_id, text, lang, source in rows:
        words = helpers.WORD.findall(text or "")
        n, chars, symbols, lines, dup, repeated = quality.text_counts(text)
        assert n == len(words)
        values = [1000 * symbols // max(chars, 1), 1000 * dup // max(lines, 1), 1000 * repeated // max(n, 1), 100 * chars // max(n, 1)]
        measured.append((doc_id, lang, source, values, n < 50 or 100 * repeated > 50 * n))
    good = [m for m in measured if not m[4]]

    def fence(some, m, always):
        values = sorted(cut(x[3][m]) for x in some)
        if not values or (len(values) < 50 and not always):
            return -1, 10**9
        q1, q2, q3 = (values[-(-len(values) * q // 4) - 1] for q in (1, 2, 3))
        low = q2 - 4 * max(2 * (q3 - q2), 60) if m == 3 else -1
        return low, q2 + 4 * max(2 * (q2 - q1), floors[m])

    out = {}
    for doc_id, lang, source, values, failed in measured:
        groups = [[x for x in good if x[1:3] == (lang, source)], [x for x in good if x[1] == lang], good]
        limits = [(m, fence(g, m, g is good)) for m in range(4) for g in groups]
        out[doc_id] = not failed and all(low <= values[m] <= high for m, (low, high) in limits)
    return out


def _quality_rows(junk: float) -> list[tuple]:
    """Two languages; source "bad" has a share of junk of several kinds."""
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    plain = lambda: "\n".join(" ".join(word(rng.randrange(2, 9)) for _ in range(9)) for _ in range(rng.randrange(7, 20)))
    kinds = [
        lambda: (f"{word(9)} {word(7)} here\n") * 3 + "\n".join(f"{word(5)} {word(6)} {word(4)}\n" * 2 for _ in range(30)),
        lambda: plain().replace(" ", " ##$$%% "),
        lambda: " ".join(word(1) for _ in range(200)),
        lambda: " ".join(word(40) for _ in range(80)),
    ]
    rows = []
    for lang in ("en", None):
        for source in ("good", "bad", "small", None):
            for i in range(20 if source == "small" else 90):
                bad = source == "bad" and i < 90 * junk
                rows.append((len(rows), kinds[i % 4]() if bad else plain(), lang, source))
    rows += [(10_000, None, "en", "good"), (10_001, "", None, None), (10_002, plain(), "xx", "other")]
    return rows


@pytest.mark.parametrize("junk", [0.0, 0.3, 0.6])
def test_junk_does_not_judge_itself(spark, junk):
    rows = _quality_rows(junk)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r.kept for r in quality.judge(df).collect()}
    assert found == plain_verdicts(rows)
    bad = {r[0] for r in rows if r[3] == "bad" and r[0] in [x[0] for x in rows if x[3] == "bad" and x[2] == r[2]][: int(90 * junk)]}
    assert not any(found[i] for i in bad)
    assert all(found[i] for i in found if i not in bad and i not in (10_000, 10_001))


def test_quality_edges(spark, docs):
    judged = quality.judge(docs)
    assert judged.count() == docs.count()
    good = quality.keep_good(docs)
    assert good.columns == docs.columns
    assert good.count() == judged.filter("kept").count()
    assert quality.judge(docs.limit(0)).count() == quality.keep_good(docs.limit(0)).count() == 0


def test_license_rules():
    assert len(licenses.rules()) > 200
    found = licenses.scan("Licensed under the Apache License, Version 2.0; (c) CC-BY 4.0. All rights reserved")
    assert "apache-2.0" in found["labels"].split(",") and "cc-by-4.0" in found["labels"].split(",")
    assert found["base_labels"] == "cc-by,reserved" and found["n_base"] == 2
    assert found["first_word"] == 9 and found["last_word"] == 13 and found["score"] == 1.0
    # The bare title lies inside the grant and is suppressed.
    assert "apache" not in [d["label"] for d in found["detections"]]
    assert licenses.scan(None)["n_words"] == 0 and licenses.scan("")["score"] == 0.0


def _spelled(parsed) -> list[str]:
    """Strings that a rule's pattern matches, each alternative and option among them."""
    out = [""]
    for kind, value in parsed:
        kind = str(kind)
        if kind == "LITERAL":
            ways = [chr(value)]
        elif kind == "IN":
            ways = [chr(v if str(k) == "LITERAL" else v[0]) for k, v in value]
        elif kind == "BRANCH":
            ways = [x for branch in value[1] for x in _spelled(branch)]
        elif kind == "SUBPATTERN":
            ways = _spelled(value[-1])
        else:
            assert kind == "MAX_REPEAT", kind
            least, most, inner = value
            ways = [x * n for n in {least, most} for x in _spelled(inner)]
        out = [a + b for a in out for b in ways]
    return out


def test_license_gates_lose_nothing(monkeypatch):
    from re import _parser

    spelled = {r: _spelled(_parser.parse(r.pattern)) for r in licenses.rules()}
    lost = [(r.label, x) for r, texts in spelled.items() for x in texts if not any(k in x for k in r.keywords)]
    assert lost == []
    corpus = [x for texts in spelled.values() for x in texts[:: max(1, len(texts) // 4)]]
    corpus += [f"see {a} or {b}." for a, b in zip(corpus, corpus[7:], strict=False)] + [r[1] for r in awkward()]
    gated = [licenses.scan(x) for x in corpus]
    free = [(("",), own) for _, own in licenses._compiled()]
    monkeypatch.setattr(licenses, "_compiled", lambda: free)
    assert gated == [licenses.scan(x) for x in corpus]


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("Creative Commons Attribution 4.0 International", "cc-by-4.0"),
        ("Creative Commons Attribution-ShareAlike v3.0", "cc-by-sa-3.0"),
        ("GPL version 2 or newer", "gpl-2+"),
        ("GPLv2 or later", "gpl-2+"),
        ("It has the GPL v2.", "gpl-2"),
        ("(GPLv3)", "gpl-3"),
        ("available under the GPLv3", "gpl-3"),
        ("LGPL v2.1", "lgpl-2.1"),
        ("GNU General Public License v3", "gpl-3"),
        ("GNU General Public License version v3.0", "gpl-3.0"),
        ("Apache License v2.0", "apache-2.0"),
    ],
)
def test_license_versions(text, label):
    assert label in licenses.scan(text)["labels"].split(",")


def test_suppression_equals_comparing_all():
    """Against each match held to all that are kept before it."""
    rng = random.Random(4)
    rules = licenses.rules()
    for _ in range(300):
        found = []
        for _ in range(rng.randrange(30)):
            start = rng.randrange(40)
            found.append((start, start + rng.randrange(1, 15), rng.choice(rules)))
        kept = []
        for start, end, rule in sorted(found, key=lambda m: (m[2].priority, m[0] - m[1], m[0])):
            if not any(s <= start and end <= e for s, e, _ in kept):
                kept.append((start, end, rule))
        assert licenses._suppressed(found) == kept


def test_license_scan_of_a_text_full_of_matches():
    """Time that grows with the text, and places of words in it, beyond ASCII too."""
    phrase = "éß 日本 all rights reserved. Licensed under the MIT License; "
    times = []
    for n in (2_000, 16_000):
        begin = time.process_time()
        found = licenses.scan(phrase * n)
        times.append(time.process_time() - begin)
        assert found["n_words"] == 10 * n and found["n_base"] == n
        assert (found["first_word"], found["last_word"]) == (2, 10 * (n - 1) + 2)
        assert [d["word"] for d in found["detections"] if d["label"] == "mit"] == [10 * i + 8 - 3 for i in range(n)]
    assert times[1] < 8 * 4 * times[0] + 1


def test_license_base(spark, docs):
    def want(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [
            (i, label)
            for phrase, label in licenses.BASE.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        at = [i for i, _ in places]
        return (len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))

    got = licenses.scan_documents(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert as_rows(got) == sorted(((r[0], *want(r[1])) for r in awkward()), key=repr)
    assert licenses.scan_documents(docs.limit(0)).count() == 0


def test_trigram_queries():
    ask = secret_scan.trigram_query
    assert ask("abcd") == [["abc", "bcd"]]
    assert ask("(abc|defg)x?") == [["abc"], ["def", "efg"]]
    assert ask("[0-9a-f]{32,}") is None and ask("a+b+") is None
    assert ask("xyz[0-9]+abc") == [["abc", "xyz"]]


def test_secret_spans(spark, docs):
    got = secret_scan.scan(docs)
    names = ("assign", "access", "hex")

    def want(doc_id, text):
        spans = helpers.secret_spans(text or "")
        counts = [sum(k == n for _, k, _ in spans) for n in range(3)]
        listed = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans)
        return (doc_id, *counts, hashlib.sha256(listed.encode()).hexdigest())

    rows = as_rows(got.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256"))
    assert rows == sorted((want(r[0], r[1]) for r in awkward()), key=repr)
    assert any(r[1] for r in rows) and any(r[2] for r in rows) and any(r[3] for r in rows)
    assert secret_scan.scan(docs.limit(0)).count() == 0


def test_secret_plan_is_native(spark, docs):
    plan = secret_scan.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_redact(spark, docs):
    out = secret_scan.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    texts = {r.doc_id: r.text for r in out.collect()}
    assert "abcdefgh1" not in texts[11] and "token:short" in texts[11] and texts[11].count("[SECRET]") == 4
    assert not secret_scan.with_spans(out).filter("size(_spans) > 0").count()


def test_simhash_components(spark, docs):
    rows = awkward()
    prints = [helpers.simhash(r[1]) for r in rows]
    groups = helpers.components(prints)
    least = collections.defaultdict(list)
    for row, g in zip(rows, groups, strict=True):
        least[g] += [row[0]] if row[0] is not None else []
    want = [(r[0], f"{p:016x}", min(least[g], default=None)) for r, p, g in zip(rows, prints, groups, strict=True)]
    assert as_rows(simhash.find_near_duplicates(docs)) == sorted(want, key=repr)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(groups))
    assert simhash.find_near_duplicates(docs.limit(0)).count() == 0
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0


def test_simhash_tree_finds_all_links(spark):
    import random

    import numpy as np

    rng = random.Random(4)
    points = [rng.getrandbits(64) for _ in range(1500)]
    points += [p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for p in points[:500] for _ in range(2)]
    signed = sorted(set(np.array(points, np.uint64).view(np.int64).tolist()))
    old, simhash.SHARD, simhash.LEAF = simhash.SHARD, 64, 16
    try:
        df = spark.createDataFrame([(p,) for p in signed], "fp long")
        links = {tuple(r) for r in simhash.linked(df).collect()}
    finally:
        simhash.SHARD, simhash.LEAF = old, 256
    place = {p: i for i, p in enumerate(signed)}
    label = list(range(len(signed)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in links:
        x, y = sorted((root(place[a]), root(place[b])))
        label[y] = x
    assert [root(i) for i in range(len(signed))] == helpers.components([p & (2**64 - 1) for p in signed])


def test_mixture(spark, docs):
    out = mixture.mix(docs).collect()
    rows = awkward()
    assert sorted(r["size"] for r in out) == sorted(len(helpers.WORD.findall(r[1] or "")) for r in rows)
    size = collections.Counter()
    for r in rows:
        size[r[3]] += len(helpers.WORD.findall(r[1] or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(size.values()), set()
    while True:
        share = (total - sum(2 * size[s] for s in full)) / (sum(weight[s] for s in order if s not in full) or 1)
        new = {s for s in order if s not in full and weight[s] * share > 2 * size[s]}
        if not new:
            break
        full |= new
    target = {s: 2.0 * size[s] if s in full else weight[s] * share for s in order}
    by_size = {size[s]: target[s] for s in order}
    taken = collections.Counter()
    for r in out:
        assert r["target"] == pytest.approx(by_size[r["source_size"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source_size"]] += r["taken"]
    for s in order:
        assert abs(taken[size[s]] - target[s]) <= max(2 * mixture.BLOCK, 0.02 * target[s])
    assert as_rows(mixture.mix(docs)) == sorted(map(tuple, out), key=repr)
    assert mixture.mix(docs.limit(0)).count() == 0


def test_shards_hold_the_words_taken(spark, docs, tmp_path, monkeypatch):
    """Blocks of every shard, rebuilt from the documents' streams, and multinomial counts per shard."""
    monkeypatch.setattr(mixture, "SHARD", 64)
    mixture.write_shards(docs, f"{tmp_path}/shards")
    rows = spark.read.parquet(f"{tmp_path}/shards").collect()
    streams = collections.defaultdict(list)
    nulls_first = lambda r: (r[0] is not None, r[0] or 0)
    for r in sorted(awkward(), key=nulls_first):
        streams[r[3]] += helpers.WORD.findall(r[1] or "")
    order = sorted(streams, key=lambda s: (s is None, s or ""))
    words = collections.Counter(w for r in rows for w in r.words.split(" "))
    taken = sum(r["taken"] for r in mixture.mix(docs).collect())
    assert sum(words.values()) == taken and len({r.shard for r in rows}) > 3
    for n, source in enumerate(order):
        own, block = streams[source], min(64, max(1, len(streams[source]) // 64))
        mine = [r for r in rows if r.source_no == n]
        for r in mine:
            # Documents of one id may take any order among themselves, so a block is a multiset at least.
            assert len(r.words.split(" ")) == len(own[r.block_no * block : (r.block_no + 1) * block])
        for p in (0, 1):
            numbers = [r.block_no for r in mine if r["pass"] == p]
            assert len(numbers) == len(set(numbers))  # no block twice in a pass
        assert len({(r["pass"], r.slot) for r in mine}) == len(mine)
    per = collections.Counter(r.shard for r in rows)
    assert max(per.values()) < 3 * len(rows) / len(per)
    assert mixture.shards(docs.limit(0)).count() == 0


def test_permutation():
    import numpy as np

    for n in (1, 2, 3, 17, 1000, 4097):
        assert sorted(mixture.permuted(np.arange(n), n, 99).tolist()) == list(range(n))


def test_mixed_documents_agree_with_taken(spark, docs):
    out = mixture.mixed_documents(docs)
    assert out.columns == docs.columns
    words = collections.Counter()
    for r in out.collect():
        words[r.doc_id] += len(helpers.WORD.findall(r.text))
    want = collections.Counter()
    for r in mixture.mix(docs).collect():
        want[r["doc_id"]] += r["taken"]
    assert +words == +want
    assert mixture.mixed_documents(docs.limit(0)).count() == 0


def test_repeated_substrings(spark, docs):
    rows = sorted(awkward(), key=lambda r: (r[0] is None, r[0] or 0))
    got = as_rows(substrings.remove_repeats(docs).drop("spans").filter("doc_id is not null"))
    known = [r for r in rows if r[0] is not None]
    texts = [(r[1] or "").encode() for r in known]
    want = [
        (r[0], *helpers.repeats_digest(t, f)) for r, t, f in zip(known, texts, helpers.covered(texts), strict=True)
    ]
    assert got == sorted(want, key=repr)
    # Rows with a null doc_id come last; both have been seen in full or are empty.
    rest = substrings.remove_repeats(docs).filter("doc_id is null").collect()
    assert all(r.n_removed == r.n_bytes for r in rest) and len(rest) == 2
    assert substrings.remove_repeats(docs.limit(0)).count() == 0


def test_repeated_substrings_of_a_hot_key(spark, monkeypatch):
    """A passage in many documents, with other text around it, or the same in a few."""
    import random

    monkeypatch.setattr(substrings, "SPLIT", 1000)
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    passage, around = word(160), [word(70) for _ in range(4)]
    texts = [word(90) + passage + word(90) for _ in range(60)]
    texts += [word(30) + rng.choice(around) + passage[:130] + rng.choice(around) + word(30) for _ in range(60)]
    texts += ["ab" * 200, "x" + "ab" * 150]
    rows = [(i, t, None, None, None, None, None) for i, t in enumerate(texts)]
    docs = table(spark, rows)
    keys = substrings._to_compare(substrings._numbered(docs)).filter("data is not null").groupBy("key")
    assert max(r["sum(size)"] for r in keys.sum("size").collect()) <= 1000
    raw = [t.encode() for t in texts]
    want = [(i, *helpers.repeats_digest(t, f)) for i, (t, f) in enumerate(zip(raw, helpers.covered(raw), strict=True))]
    assert as_rows(substrings.remove_repeats(docs).drop("spans")) == sorted(want, key=repr)


def test_rows_without_doc_id_are_spread(spark):
    same = "a text that is long enough to be compared with its copies, word by word, " * 2
    texts = [same] * 40 + [None] * 40 + [f"{i} {same}" for i in range(20)]
    docs = table(spark, [(None, t, None, None, None, None, None) for t in texts])
    assert substrings._numbered(docs).groupBy("_null", "_id").count().agg({"count": "max"}).first()[0] < 5
    out = substrings.remove_repeats(docs).collect()
    assert len(out) == 100 and all(r.doc_id is None for r in out)
    # What is left of all copies is less than one text and what the numbers make of others.
    assert sum(r.n_bytes == len(same) and r.n_removed == 0 for r in out) <= 1


def test_induced_sorting():
    import random

    import numpy as np

    from postern.llm import induced

    rng = random.Random(5)
    for _ in range(400):
        k, n = rng.choice([1, 2, 3, 30]), rng.randrange(0, 60)
        base = [rng.randrange(1, k + 1) for _ in range(n)] * rng.choice([1, 1, 3])
        t = base + [0]
        most = rng.choice([3, 10, 100])
        order, common = induced.sort_suffixes(np.array(t, rng.choice([np.uint8, np.int32])), most)
        want = sorted(range(len(t)), key=lambda i: t[i:])
        assert order.tolist() == want
        for r in range(1, len(t)):
            a, b = t[want[r - 1] :], t[want[r] :]
            same = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
            assert common[r] == min(same, most)


def test_induced_sorting_on_disk(monkeypatch):
    import numpy as np

    from postern.llm import induced

    t = np.append(np.random.default_rng(1).integers(1, 5, 5000), 0).astype(np.uint8)
    want = induced.sort_suffixes(t, 100)
    monkeypatch.setattr(induced, "MEMORY", 100)
    got = induced.sort_suffixes(t, 100)
    assert isinstance(got[0], np.memmap)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
