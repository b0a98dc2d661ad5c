"""Decoding, envelopes, rejections, retries and hot entries."""

import datetime as dt
import json

import fixtures as X
from postern.functions.dates import epoch_ms
from postern.operators import bitmap, decode, envelope, gates, joins, outputs, repair, retry, routing
from postern.plans import intake
from postern.schemas import EVENT_DECODED, EVENT_WIRE, JOURNAL_ENTRY
from postern.session import session_settings, work_dir
from postern.sources import lookups, responses, tables
from pyspark.sql import functions as F

EVENT = {
    "hendelsesId": "h",
    "versjon": 2,
    "hendelsesType": "Mottatt",
    "journalpostId": 7,
    "journalpostStatus": "MOTTATT",
    "temaGammelt": "SYK",
    "temaNytt": "SYK",
    "mottaksKanal": "NAV_NO",
    "kanalReferanseId": "r",
    "behandlingstema": "",
}


def _messages(spark, *bodies):
    rows = [(n, body if isinstance(body, str) else json.dumps(body)) for n, body in enumerate(bodies)]
    return spark.createDataFrame(rows, "event_order bigint, value string")


def without(*names):
    return {k: v for k, v in EVENT.items() if k not in names}


def test_decode_and_quarantine(spark):
    messages = (
        _messages(
            spark,
            EVENT | {"unknown": [1]},
            without("versjon", "behandlingstema"),
            without("mottaksKanal", "hendelsesId"),
            without("temaNytt"),  # has no theme, so the gate drops it
            without("mottaksKanal") | {"temaNytt": "PEN"},  # dropped before it is decoded
            without("journalpostId"),
            "{broken",
            EVENT | {"hendelsesType": "TemaEndret"},
        )
    )
    checked = decode.checked(decode.parse_json_events(messages))
    good, bad = decode.split_faulty(decode.decode(checked))
    got = {r.event_order: r for r in good.collect()}
    assert set(got) == {0, 1}
    assert (got[0].entry_id, got[0].journalpostId, got[0].versjon) == ("7", "7", 2)
    assert (got[1].versjon, got[1].behandlingstema) == (0, "")
    assert {r.event_order: r.fault for r in bad.collect()} == {
        2: "missing:hendelsesId,mottaksKanal",
        5: "missing:journalpostId",
        6: "unreadable",
    }
    assert {r.event_order for r in bad.where("raw = '{broken'").collect()} == {6}


def test_gates(spark):
    rows = [
        (1, X.WEDNESDAY_MORNING, 1, "Mottatt", "SYK"),
        (2, X.WEDNESDAY_MORNING, 1, "MidlertidigJournalført", "SYK"),
        (3, X.WEDNESDAY_MORNING, 1, "JournalpostMottatt", "SYK"),
        (4, X.WEDNESDAY_MORNING, 1, "Mottatt", "PEN"),
        (5, X.WEDNESDAY_MORNING, 1, "mottatt", "SYK"),
        (6, X.WEDNESDAY_MORNING, 1, None, "SYK"),
        (7, X.WEDNESDAY_MORNING, 1, "Mottatt", None),
    ]
    events = X.wire(spark, rows)
    assert sorted(r.event_order for r in gates.gate(events).collect()) == [1, 2, 3]


def test_envelope(spark):
    bodies = [
        {"data": {"journalpost": {"journalpostId": "1", "tema": "SYK"}}, "errors": None},
        {"data": {"journalpost": {"journalpostId": "1"}}, "errors": [{"message": "m", "path": ["a"]}]},
        {"data": {"journalpost": None}, "errors": [{"message": None}, {"message": "x", "extensions": {"code": "c"}}]},
        {"data": None},
    ]
    rows = [(str(n), json.dumps(b)) for n, b in enumerate(bodies)]
    df = envelope.unwrap(spark.createDataFrame(rows, "id string, value string"), "journalpost", JOURNAL_ENTRY)
    got = {r.id: (r.failed, r.n_errors, r.error_text) for r in df.collect()}
    assert got == {"0": (False, 0, None), "1": (False, 1, "m"), "2": (True, 2, "null - x"), "3": (True, 0, None)}
    side = {(r.id, r.pos): (r.message, r.code) for r in envelope.error_rows(df, "id").collect()}
    assert side == {("1", 0): ("m", None), ("2", 0): (None, None), ("2", 1): ("x", "c")}


def test_lookup_tables_from_responses(spark):
    whole = X.entry("a", titles=("x", "y"))
    single = X.entry("b") | {"dokumenter": X.entry("b")["dokumenter"][0]}
    bodies = [
        {"data": {"journalpost": whole | {"extra": 1}}, "errors": [{"message": "m"}]},
        {"data": {"journalpost": single}},
        {"data": {"journalpost": None}, "errors": [{"message": "gone"}]},
        {"data": {"journalpost": {k: v for k, v in X.entry("d").items() if k != "dokumenter"}}},
    ]
    df = spark.createDataFrame([(json.dumps(b),) for b in bodies], "value string")
    got = {r.entry_id: (r.form_code, r.n_documents, r.titles_ok, r.entry_ok) for r in responses.entries(df).collect()}
    assert got == {"a": (X.AUTO_CODE, 2, True, True), "b": (X.AUTO_CODE, 1, True, True), "d": (None, 0, None, False)}

    number = {"gruppe": "FOLKEREGISTERIDENT", "ident": "n"}
    actor = {"gruppe": "AKTORID", "ident": "a"}
    people = [
        ("1", {"data": {"hentIdenter": {"identer": [number, actor]}}}),
        ("2", {"data": {"hentIdenter": {"identer": actor}}}),
        ("3", {"data": {"hentIdenter": None}, "errors": [{"message": "not found"}]}),
    ]
    df = spark.createDataFrame([(i, json.dumps(b)) for i, b in people], "party_id string, value string")
    facts = lookups.identity_facts(responses.identities(df))
    assert {r.party_id: (r.actor_id, r.national_id) for r in facts.collect()} == {"1": ("a", "n"), "2": ("a", None)}


REPLIES = [
    # id, first status, first text, second status -> class, attempts, accepted
    ("ok", 201, None, None, None, 1, True),
    ("closed", 400, "NAVEnheten '1' har status: 'Nedlagt'", 201, "bad_unit", 2, True),
    ("handler", 400, "NAVEnheten '1' er av typen oppgavebehandler", 201, "bad_unit", 2, True),
    ("unknown", 400, "Enheten med nummeret '1' eksisterer ikke", 201, "bad_unit", 2, True),
    ("org", 400, "Organisasjonsnummer er ugyldig", 201, "bad_org", 2, True),
    ("both", 400, "Organisasjonsnummer er ugyldig. NAVEnheten '1' har status: 'Nedlagt'", 201, "bad_unit", 2, True),
    ("half", 400, "NAVEnheten '1' finnes", 201, None, 1, False),
    ("unreadable", 400, None, 201, None, 1, False),
    ("absent", 404, None, 201, None, 1, False),
    ("server", 500, "Organisasjonsnummer er ugyldig", 201, None, 1, False),
    ("twice", 400, "Organisasjonsnummer er ugyldig", 400, "bad_org", 2, False),
    ("no_reply", None, None, None, None, 1, False),
]


def _answers(spark):
    rows = [(i, 1, s, m) for i, s, m, *_ in REPLIES if s] + [(r[0], 2, r[3], None) for r in REPLIES if r[3]]
    return spark.createDataFrame(rows, "entry_id string, attempt int, http_status int, message string")


def test_repair(spark):
    requests = spark.createDataFrame(
        [(r[0], "U", "O") for r in REPLIES], "journalpostId string, tildeltEnhetsnr string, orgnr string"
    )
    got = {r.journalpostId: r for r in repair.settle(requests, _answers(spark)).collect()}
    for name, *_, kind, attempts, accepted in REPLIES:
        row = got[name]
        assert (row.rejection, row.attempts, row.accepted) == (kind, attempts, accepted), name
        assert row.tildeltEnhetsnr == (None if kind == "bad_unit" else "U"), name
        assert row.orgnr == (None if kind == "bad_org" else "O"), name
        assert row.reason == (None if accepted else "task_rejected"), name


def test_refused_task_is_neither_updated_nor_inherited(spark):
    rows = [X.entry("ok"), X.entry("twice"), X.entry("server", code=X.MANUAL_CODE)]
    source = X.make_lookups(spark, rows, [X.person("100")])
    names = ["ok", "twice", "server"]
    events = spark.createDataFrame(
        [(n, X.WEDNESDAY_MORNING, name) for n, name in enumerate(names * 2)], X.EVENTS
    )
    decided = repair.settled_decisions(intake.decide_events(events, source), _answers(spark))
    assert [r.entry_id for r in outputs.journal_updates(decided).collect()] == ["ok"]
    got = {r.event_order: (r.outcome, r.reason) for r in routing.fan_out(events, decided).collect()}
    refused = ("RETRY", "task_rejected")
    assert got == {0: ("AUTO", None), 1: refused, 2: refused, 3: ("SKIP_STATUS", None), 4: refused, 5: refused}


def test_retry_rows(spark):
    wire = X.wire(
        spark,
        [
            (1, X.WEDNESDAY_MORNING, 5, "Mottatt", "SYK"),
            (2, X.WEDNESDAY_MORNING + dt.timedelta(seconds=3), 5, "Mottatt", "SYK"),
            (3, X.WEDNESDAY_MORNING, 6, "Mottatt", "SYK"),
        ],
    )
    routed = decode.decode(wire).withColumn("outcome", F.when(F.col("event_order") < 3, "RETRY").otherwise("JFR"))
    rows = retry.enqueue(routed.withColumn("behandlingstema", F.lit(None).cast("string")))
    (row,) = rows.collect()
    start = int(X.WEDNESDAY_MORNING.replace(tzinfo=dt.UTC).timestamp() * 1000)
    assert (row.key, row.due_ms) == ("5", start + 4000)  # the later event waits, 1 s after it
    body = json.loads(row.value)
    assert list(body) == EVENT_DECODED.names and body["journalpostId"] == "5"
    assert body["behandlingstema"] is None
    again = retry.enqueue(routed, F.expr("INTERVAL '10' MINUTE")).first()
    assert again.due_ms == start + 603_000

    back = retry.events_of(rows).first()
    assert (back.entry_id, back.hendelsesType, back.event_order) == ("5", "Mottatt", start + 4000)
    assert retry.due(rows, F.lit(start + 3999)).count() == 0
    assert retry.due(rows, F.lit(start + 4000)).count() == 1

    def kept(hours, ms):
        as_of = X.WEDNESDAY_MORNING + dt.timedelta(seconds=3, hours=hours, milliseconds=ms)
        return retry.retained(rows, F.lit(as_of).cast("timestamp_ntz")).count()

    assert (kept(336, 0), kept(336, 1)) == (1, 0)
    plan = retry.schedule(rows, 3).orderBy("attempt").collect()
    assert [r.due_ms for r in plan] == [start + 4000 + n * 600_000 for n in range(3)]


def test_due_header(spark):
    def h(*pairs):
        return [(k, v.encode()) for k, v in pairs]

    name = "behandlingstidspunkt"
    rows = [
        ("last", "v", h((name, "1"), (name, "2"), ("other", "3"))),
        ("none", "v", h(("other", "3"))),
        ("empty", "v", []),
        ("null", "v", None),
    ]
    df = spark.createDataFrame(rows, "key string, value string, headers array<struct<key: string, value: binary>>")
    got = {r.key: r.due_ms for r in retry.read_messages(df, F.lit(9).cast("bigint")).collect()}
    assert got == {"last": 2, "none": 9, "empty": 9, "null": 9}
    rows = retry.read_messages(df, F.lit(9).cast("bigint"))
    assert retry.read_messages(retry.to_messages(rows), F.lit(0)).where("due_ms = 2").count() == 1


def test_current_journal(spark):
    rows = [X.entry("a", preset="old", party=("1", "FNR")), X.entry("b", preset="old", code=X.MANUAL_CODE)]
    source = X.make_lookups(spark, rows, [X.person("1"), X.person("100")])
    updates = outputs.journal_updates(intake.decide_keys(X.keys(spark, ["a", "b"]), source))
    got = {r.entry_id: r for r in outputs.current_journal(source.journal, updates).collect()}
    assert (got["a"].case_type, got["a"].sender_id, got["a"].sender_type) == ("GENERELL_SAK", "1", "FNR")
    assert (got["b"].case_type, got["b"].sender_id, got["b"].handling_theme) == (None, None, "old")


def test_update_body_sends_lists_back(spark):
    rows = [X.entry("a", titles=("x", "y"), unit="", relevanteDatoer=[{"dato": "2024-01-01", "datotype": "D"}])]
    source = X.make_lookups(spark, rows, [X.person("100")])
    updates = outputs.journal_updates(intake.decide_keys(X.keys(spark, ["a"]), source))
    body = json.loads(outputs.update_bodies(updates, X.snapshot(spark, rows)).first().body)
    assert body["dokumenter"] == rows[0]["dokumenter"]
    assert body["relevanteDatoer"] == rows[0]["relevanteDatoer"]
    assert body["bruker"] == {"id": "100", "idType": "FNR"}
    assert body["avsenderMottaker"] == {"id": "100", "idType": "FNR"}
    assert (body["sak"], body["behandlingstype"]) == ({"sakstype": "GENERELL_SAK"}, None)
    assert (body["journalforendeEnhet"], body["behandlingstema"]) == ("", "ab0434")


def test_batch_with_replies(spark):
    """All outputs of one run, after the task system's replies."""
    names = ["ok", "closed", "org", "twice"]
    rows = [X.entry(n, unit="1234") for n in names[:2]]
    rows += [X.entry(n, unit="1234", code=X.MANUAL_CODE, party=("9", "ORGNR")) for n in names[2:]]
    source = X.make_lookups(spark, rows, [X.person("100")])
    wire = X.wire(spark, [(n, X.WEDNESDAY_MORNING, n, "Mottatt", "SYK") for n in range(8)])
    ids = F.array(*[F.lit(n) for n in names])
    events = intake.gated_events(wire).withColumn("entry_id", ids[F.col("event_order") % 4])
    folder = work_dir(spark, "batch")
    result = intake.run_batch(spark, events, source, folder, "batch_id=0", answers=_answers(spark))
    tasks = {r.journalpostId: (r.oppgavetype, r.tildeltEnhetsnr, r.orgnr) for r in result.task_requests.collect()}
    assert tasks == {"ok": ("SOK", "1234", None), "closed": ("SOK", None, None), "org": ("JFR", "1234", None)}
    assert {r.entry_id for r in result.journal_updates.collect()} == {"ok", "closed"}
    assert {r.entry_id for r in result.finalizations.collect()} == {"ok", "closed"}
    assert [r.key for r in result.retries.collect()] == ["twice"]
    outcomes = {r.event_order: r.outcome for r in result.routed.collect()}
    assert outcomes == {0: "AUTO", 1: "AUTO", 2: "JFR", 3: "RETRY",
                        4: "SKIP_STATUS", 5: "SKIP_STATUS", 6: "SKIP_HAS_TASK", 7: "RETRY"}


def test_code_tree_language_and_shape(spark):
    tree = {
        "noder": {
            "SYK": {"kode": "SYK", "undernoder": {"A": {"kode": "A", "termer": {"nb": "x;y", "en": "z"}},
                                                  "B": {"kode": "B", "termer": {"en": "z"}}}},
            "PEN": {"kode": "PEN"},
        }
    }
    df = spark.createDataFrame([(json.dumps(tree),)], "value string")
    got = {(r.theme, r.form_code): r.term for r in lookups.flatten_code_tree(df).collect()}
    assert got == {("SYK", "A"): "x;y", ("SYK", "B"): None}
    assert tables.hierarchy(spark).count() == 22


def test_read_hierarchy_checks_its_size(spark, tmp_path):
    tree = {"noder": {"SYK": {"kode": "SYK", "undernoder": {c: {"termer": {"nb": "x;"}} for c in "abc"}}}}
    (tmp_path / "tree.json").write_text(json.dumps(tree, indent=1))
    read = lookups.read_hierarchy(spark, str(tmp_path / "tree.json"))
    assert read.count() == 3
    other = spark.range(5).selectExpr("CAST(id AS STRING) AS form_code")

    def plan(df):
        return other.join(df, "form_code", "left")._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(read)
    plain = spark.range(3).selectExpr("CAST(id AS STRING) AS form_code")
    assert "strategy=broadcast" in plan(lookups.broadcast_if_small(plain, 3))
    assert "strategy=broadcast" not in plan(lookups.broadcast_if_small(plain, 2))


def test_entries_without_lookup_are_spread(spark):
    """Parties that are not looked up match nothing, though their spread key is a party's."""
    rows = [X.entry("100", party=("100", "ORGNR")), X.entry("b", party=("100", "FNR")), X.entry("c", party=None)]
    source = X.make_lookups(spark, rows, [X.person("100")])
    got = {r.entry_id: r.person_found for r in joins.with_identities(source.journal, source.identities).collect()}
    assert got == {"100": False, "b": True, "c": False}


def test_hot_entries_are_split_without_changing_results(spark):
    """One entry holds a third of all events, another set has no id at all."""
    n = 3000
    events = spark.range(n).select(
        F.col("id").alias("event_order"),
        F.lit(X.WEDNESDAY_MORNING).cast("timestamp_ntz").alias("as_of"),
        F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 30 <> 1 THEN concat('e', id % 50) END AS entry_id"),
    )
    outcome = F.when(F.col("entry_id") == "hot", "JFR").otherwise("SKIP_STATUS")
    decisions = joins.keys_of(events.where("entry_id is not null")).withColumns(
        {"outcome": outcome, "reason": F.lit(None).cast("string")}
    )
    plain = routing.fan_out(events, decisions)
    split = routing.fan_out(events, decisions, per_task=100)
    assert split.count() == n
    assert split.exceptAll(plain).count() == 0
    counts = {r.outcome: r["count"] for r in split.where("entry_id = 'hot'").groupBy("outcome").count().collect()}
    assert counts == {"JFR": 1, "SKIP_HAS_TASK": n // 3 - 1}
    spread = split.where("entry_id = 'hot'").select(F.spark_partition_id()).distinct().count()
    assert spread > 1

    entries = decisions.select("entry_id", F.lit("MOTTATT").alias("status"))
    found = joins.events_with_entry(events, entries, per_task=100)
    assert found.count() == n
    assert found.where("not entry_found").count() == events.where("entry_id is null").count()


def test_document_facts_agree(spark, sf_dir):
    """By parts as codes, by a dictionary of texts, and from nested rows; without sorting documents."""
    texts = tables.documents(spark, sf_dir).withColumn(
        "doc_order", F.col("doc_order.l_linenumber") * F.lit(10**9).cast("bigint") + F.col("doc_order.l_partkey")
    )
    facts = tables.document_facts(spark, sf_dir)
    others = [
        lookups.document_facts(*lookups.coded(texts)),
        lookups.entries_from_snapshot(tables.snapshot(spark, sf_dir)).where("n_documents > 0"),
    ]
    assert facts.count() > 0
    for other in others:
        other = other.select(*facts.columns)
        assert other.exceptAll(facts).count() == 0 and facts.exceptAll(other).count() == 0
    for plan in (lookups.entries_with_documents(tables.journal(spark, sf_dir), facts), *others):
        assert "SortAggregate" not in plan._jdf.queryExecution().executedPlan().toString()


def test_first_document_of_any_order_and_code(spark):
    rows = [("a", 3, "x", "t"), ("a", -2, None, "t"), ("b", 10**16, "y", ""), ("b", 7, "z", "t"), ("c", 1, None, None)]
    documents = spark.createDataFrame(rows, "entry_id string, doc_order bigint, form_code string, title string")
    found = {r.entry_id: tuple(r)[1:] for r in lookups.document_facts(*lookups.coded(documents)).collect()}
    assert found == {"a": (2, None, True), "b": (2, "z", False), "c": (1, None, False)}


def test_wire_schema_covers_decoded_event():
    assert set(EVENT_WIRE.names) == set(EVENT_DECODED.names)


def test_epoch_of_due_is_consistent(spark, sf_dir):
    rows = tables.retries(spark, sf_dir)
    late = rows.where(F.col("due_ms") != epoch_ms(F.col("enqueued_at") + F.expr("INTERVAL '1' SECOND")))
    assert late.count() == 0


def test_hot_parties_are_dealt_out(spark):
    """A third of the entries on one party; without adaptive handling no task has much more than others."""
    rows = [(f"e{i}", "hot" if i % 3 == 0 else f"p{i % 500}", "FNR") for i in range(9000)]
    rows += [("org", "hot", "ORGNR"), ("none", None, None)]
    entries = spark.createDataFrame(rows, "entry_id string, party_id string, party_type string")
    people = [X.person("hot")] + [X.person(f"p{i}") for i in range(0, 500, 2)]
    identities = spark.createDataFrame(people, X.IDENTITIES)
    hot = joins.hot_parties(entries, per_task=50)
    assert {r.key: r.salts for r in hot.collect()} == {"hot": 60}
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    with session_settings(spark, settings):
        plain = joins.with_identities(entries, identities)
        dealt = joins.with_identities(entries, identities, hot=hot)
        sizes = sorted(r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect())
        columns = plain.columns
        assert sorted(map(str, dealt.select(columns).collect())) == sorted(map(str, plain.collect()))
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_large_batches_prune_the_lookups_by_a_bitmap(spark, sf_dir):
    """Above the broadcast bound, a bitmap of the batch's ids cuts the tables as they are scanned."""
    lookups = intake.table_lookups(spark, sf_dir)
    ids = joins.keys_of(intake.gated_events(tables.events(spark, sf_dir))).where("n_events > 2")
    n = ids.count()
    few, many = intake.restricted(lookups, ids), intake.restricted(lookups, ids, n)
    for name in ("journal", "documents", "tasks"):
        rows = [sorted(map(str, getattr(x, name).collect())) for x in (few, many)]
        assert rows[0] == rows[1]
    bits = bitmap.bits_for(n)
    maps = bitmap.bitmap(ids, F.col("entry_id"), bits)
    left = bitmap.with_maybe(lookups.journal, F.col("entry_id"), maps, bits).where("maybe").count()
    assert few.journal.count() <= left <= few.journal.count() + 0.1 * lookups.journal.count()
    assert bitmap.bits_for(10**12) == 8 * bitmap.MOST


def test_bitmap_forgets_no_key(spark):
    keys = spark.range(0, 3000, 7).select(F.col("id").cast("string").alias("k"))
    keys = keys.union(spark.createDataFrame([(None,)], "k string"))
    rows = spark.range(3000).select(F.col("id").cast("string").alias("k"), "id").union(spark.createDataFrame([(None, -1)], "k string, id bigint"))
    for bits in (1 << 15, 1 << 18):
        marked = bitmap.with_maybe(rows, F.col("k"), bitmap.bitmap(keys, F.col("k"), bits), bits)
        maybe = {r.id for r in marked.where("maybe").collect()}
        assert {-1, *range(0, 3000, 7)} <= maybe and len(maybe) < 600
        assert marked.count() == 3001
