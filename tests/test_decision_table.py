"""One constructed entry per line of the decision table, and the cases between lines."""

import fixtures as X
import pytest
from postern.operators import outputs, routing
from postern.plans import intake

OPEN = ("t1", "x", "AAPEN", "JFR")
MALFORMED = [("SYK", "BAD", "ab0001")]
NATIONAL, ACTOR = "FOLKEREGISTERIDENT", "AKTORID"

# name -> (entry fields, identities of party 100 or None, tasks, outcome, reason)
LINES = {
    "status": (dict(status="FERDIGSTILT"), None, [], "SKIP_STATUS", None),
    "status_m": (dict(status="M"), (NATIONAL, ACTOR), [], "AUTO", None),
    "status_before_ignored": (dict(status="F", code="4936"), None, [], "SKIP_STATUS", None),
    "ignored": (dict(code="4936"), None, [OPEN], "SKIP_IGNORED", None),
    "ignored_other_theme": (dict(code="4936", theme="PEN", party=None), None, [], "FDR", None),
    "status_missing": (dict(status=None), None, [], "RETRY", "journal_incomplete"),
    "theme_missing": (dict(theme=None), None, [], "RETRY", "journal_incomplete"),
    "documents_missing": (dict(dokumenter=None), None, [], "RETRY", "journal_incomplete"),
    "party_type_missing": (dict(party=("100", None)), None, [], "RETRY", "journal_incomplete"),
    "auto_open_task": (dict(), (NATIONAL, ACTOR), [OPEN], "SKIP_HAS_TASK", None),
    "auto_no_person": (dict(), None, [], "RETRY", "person_missing"),
    "auto_no_actor": (dict(), (NATIONAL,), [], "RETRY", "actor_missing"),
    "auto_no_sender": (dict(), (ACTOR,), [], "RETRY", "sender_missing"),
    "auto_sender_without_id": (dict(sender=(None, "FNR")), (ACTOR,), [], "RETRY", "sender_missing"),
    "auto_own_sender": (dict(sender=("9", "ORGNR")), (ACTOR,), [], "AUTO", None),
    "auto": (dict(), (NATIONAL, ACTOR), [], "AUTO", None),
    "auto_actor_party": (dict(party=("100", "AKTOERID")), (NATIONAL, ACTOR), [], "AUTO", None),
    "auto_other_party": (dict(party=("100", "PERSONBRUKER")), (NATIONAL, ACTOR), [], "AUTO", None),
    "auto_blank_title": (dict(titles=("a", " ")), (NATIONAL, ACTOR), [], "AUTO", None),
    "sok_task_does_not_count": (dict(), (NATIONAL, ACTOR), [("t", "x", "AAPEN", "SOK")], "AUTO", None),
    "closed_task": (dict(), (NATIONAL, ACTOR), [("t", "x", "AVSLUTTET", "JFR")], "AUTO", None),
    "task_without_id": (dict(), (NATIONAL, ACTOR), [(None, "x", "AAPEN", "JFR")], "AUTO", None),
    "no_party": (dict(party=None), None, [], "JFR", None),
    "org": (dict(party=("100", "ORGNR")), None, [], "JFR", None),
    "null_title": (dict(titles=("a", None)), (NATIONAL, ACTOR), [], "JFR", None),
    "empty_title": (dict(titles=("a", "")), (NATIONAL, ACTOR), [], "JFR", None),
    "no_documents": (dict(titles=()), (NATIONAL, ACTOR), [], "JFR", None),
    "manual_open_task": (dict(code=X.MANUAL_CODE), None, [("t", "x", "AAPEN", "FDR")], "SKIP_HAS_TASK", None),
    "manual_no_person": (dict(code=X.MANUAL_CODE), None, [], "RETRY", "person_missing"),
    "manual_no_person_other_theme": (dict(theme="PEN"), None, [], "RETRY", "person_missing"),
    "fdr_no_actor": (dict(theme="UKJ"), (NATIONAL,), [], "RETRY", "actor_missing"),
    "fdr": (dict(theme="UKJ"), (NATIONAL, ACTOR), [], "FDR", None),
    "fdr_other_party_no_actor": (dict(theme="PEN", party=("100", "X")), (NATIONAL,), [], "FDR", None),
    "fdr_org": (dict(theme="PEN", party=("100", "ORGNR")), None, [], "FDR", None),
    "jfr_malformed": (dict(code="BAD"), (NATIONAL,), [], "RETRY", "term_malformed"),
    "jfr_no_actor": (dict(code=X.MANUAL_CODE), (NATIONAL,), [], "RETRY", "actor_missing"),
    "jfr_other_party_no_actor": (dict(code="?", party=("100", "X")), (NATIONAL,), [], "JFR", None),
    "jfr": (dict(code=X.MANUAL_CODE), (NATIONAL, ACTOR), [], "JFR", None),
}


@pytest.fixture(scope="module")
def decisions(spark):
    rows, people, tasks = [], [], []
    for name, (fields, groups, listed, *_) in LINES.items():
        fields = dict(fields)
        party = fields.pop("party", ("100", "FNR"))
        if party is not None:  # a party of its own for every line
            party = (name, party[1])
        rows.append(X.entry(name, party=party, **fields))
        if groups is not None:
            people.append(X.person(name, *groups))
        tasks += [(task, name, category, kind) for task, _, category, kind in listed]
    lookups = X.make_lookups(spark, rows, people, tasks, MALFORMED)
    decided = intake.decide_keys(X.keys(spark, [*LINES, "absent"]), lookups)
    return {row.entry_id: row for row in decided.collect()}


@pytest.mark.parametrize("name", LINES)
def test_line(decisions, name):
    assert (decisions[name].outcome, decisions[name].reason) == LINES[name][3:]


def test_no_journal_row(decisions):
    assert (decisions["absent"].outcome, decisions["absent"].reason) == ("RETRY", "journal_missing")


def test_malformed_term_before_party(spark):
    """A listed form with a broken term fails even for an organisation, which would go to
    manual handling next; an open task comes first."""
    bad = [("SYK", "NAV 08-07.04D", "ab0001")]
    rows = [
        X.entry("org", code="NAV 08-07.04D", party=("1", "ORGNR")),
        X.entry("task", code="NAV 08-07.04D", party=("1", "ORGNR")),
    ]
    lookups = X.make_lookups(spark, rows, [], [("t", "task", "AAPEN", "JFR")], bad)
    got = intake.decide_keys(X.keys(spark, ["org", "task"]), lookups).collect()
    assert {r.entry_id: (r.outcome, r.reason) for r in got} == {
        "org": ("RETRY", "term_malformed"),
        "task": ("SKIP_HAS_TASK", None),
    }


def test_historic_and_incomplete_identities(spark):
    rows = [X.entry("old", party=("1", "FNR")), X.entry("bad", party=("2", "FNR"))]
    people = [
        ("1", [("AKTORID", "old", False), ("AKTORID", "new", True), ("AKTORID", "next", True),
               ("FOLKEREGISTERIDENT", "n", True)]),
        ("2", [("AKTORID", None, True)]),
    ]
    lookups = X.make_lookups(spark, rows, people)
    got = {r.entry_id: r for r in intake.decide_keys(X.keys(spark, ["old", "bad"]), lookups).collect()}
    assert (got["old"].outcome, got["old"].actor_id) == ("AUTO", "new")
    assert (got["bad"].outcome, got["bad"].reason) == ("RETRY", "identities_incomplete")


def test_units_codes_and_parties(spark):
    rows = [
        X.entry("blank_auto", unit="  "),
        X.entry("blank_manual", unit="  ", code=X.MANUAL_CODE),
        X.entry("755763339", unit="1234"),
        X.entry("preset", preset="ab9999", code="NAV 08-14.01"),
        X.entry("preset_empty", preset="", code="NAV 08-14.01"),
        X.entry("general", theme="UKJ", unit="1234"),
        X.entry("pension", theme="PEN", party=("100", "PERSONBRUKER")),
        X.entry("actor", code=X.MANUAL_CODE, party=("100", "AKTOERID")),
    ]
    lookups = X.make_lookups(spark, rows, [X.person("100")])
    decided = intake.decide_keys(X.keys(spark, [r["journalpostId"] for r in rows]), lookups)
    got = {r.journalpostId: r for r in outputs.task_requests(decided).collect()}
    assert got["blank_auto"].tildeltEnhetsnr is None
    assert got["blank_manual"].tildeltEnhetsnr == "  "
    assert got["755763339"].tildeltEnhetsnr is None and got["755763339"].oppgavetype == "SOK"
    assert (got["preset"].behandlingstema, got["preset"].behandlingstype) == ("ab9999", "ae0121")
    assert got["preset_empty"].behandlingstema == "ab0237"
    general = got["general"]
    assert (general.oppgavetype, general.tema, general.aktoerId) == ("FDR", "GEN", "10000")
    assert (general.tildeltEnhetsnr, general.beskrivelse, general.behandlingstype) == (None, None, None)
    assert (got["pension"].tema, got["pension"].aktoerId) == ("PEN", None)
    assert got["actor"].aktoerId == "10000"
    override = outputs.task_requests(decided, overrides=["blank_manual"]).collect()
    assert {r.journalpostId: r.tildeltEnhetsnr for r in override}["755763339"] == "1234"


def test_later_events_inherit(spark):
    rows = [
        X.entry("jfr", code=X.MANUAL_CODE),
        X.entry("auto"),
        X.entry("ignored", code="4936"),
    ]
    lookups = X.make_lookups(spark, rows, [X.person("100")])
    names = ["jfr", "auto", "ignored", "absent"]
    events = spark.createDataFrame(
        [(10 * turn + n, X.WEDNESDAY_MORNING, name) for turn in (2, 1) for n, name in enumerate(names)], X.EVENTS
    )
    got = {(r.entry_id, r.event_order // 10): r for r in intake.route_events(events, lookups).collect()}
    assert {k: v.outcome for k, v in got.items()} == {
        ("jfr", 1): "JFR", ("jfr", 2): "SKIP_HAS_TASK",
        ("auto", 1): "AUTO", ("auto", 2): "SKIP_STATUS",
        ("ignored", 1): "SKIP_IGNORED", ("ignored", 2): "SKIP_IGNORED",
        ("absent", 1): "RETRY", ("absent", 2): "RETRY",
    }
    assert all(v.first_in_set == (turn == 1) for (_, turn), v in got.items())


def test_inherited_outcomes_cover_all_tasks():
    assert set(routing.TASK_OUTCOMES) == {"AUTO", "JFR", "FDR"}
