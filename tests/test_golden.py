"""Ten known entries and what becomes of each."""

import datetime as dt

import fixtures as X
from postern.operators import outputs
from postern.plans import intake

PB = "PERSONBRUKER"
CASES = [
    # id, status, party, code, unit, outcome
    ("11111111111", "JOURNALFOERT", ("11111111111", "FNR"), "NAV 08-07.04 D", "9999", "SKIP_STATUS"),
    ("22222222222", "MOTTATT", ("22222222222", PB), "NAV 08-07.04 D", "9999", "AUTO"),
    ("33333333333", "MOTTATT", ("33333333333", PB), "NAV 08-35.01", None, "JFR"),
    ("928374927834", "MOTTATT", ("33333333333", PB), "NAV 90-00.08 K", None, "JFR"),
    ("90384593875", "MOTTATT", ("33333333333", PB), "NAV 08-09.06", None, "JFR"),
    ("029834982", "MOTTATT", ("33333333333", PB), "", None, "JFR"),
    ("984561332", "MOTTATT", ("33333333333", PB), "NAV 00-03.00 U", None, "JFR"),
    ("787359875", "MOTTATT", None, "NAV 08-09.06", None, "JFR"),
    ("44444444444", "MOTTATT", ("44444444444", PB), "4936", None, "SKIP_IGNORED"),
    ("000000001", "MOTTATT", ("000999000", "ORGNR"), "NAV 08-07.04 D", "9999", "JFR"),
]


def _identities(party_id):
    numbers = [party_id]
    if party_id[0] in "23":
        numbers.append("1" + party_id[1:])
    if party_id[0] == "3":
        numbers.append("2" + party_id[1:])
    listed = [("FOLKEREGISTERIDENT", number, True) for number in numbers]
    return party_id, [*listed, ("AKTORID", party_id + "00", True)]


def _decisions(spark):
    rows = [
        X.entry(i, status=s, party=p, code=c, unit=u, titles=("T" + i,), title="T" + i)
        for i, s, p, c, u, _ in CASES
    ]
    people = [_identities(p) for p in ("11111111111", "22222222222", "33333333333", "44444444444")]
    lookups = X.make_lookups(spark, rows, people)
    return intake.decide_keys(X.keys(spark, [case[0] for case in CASES]), lookups)


def test_outcomes(spark):
    got = {r.entry_id: r.outcome for r in _decisions(spark).select("entry_id", "outcome").collect()}
    assert got == {case[0]: case[5] for case in CASES}


def test_task_requests(spark):
    got = {r.journalpostId: r for r in outputs.task_requests(_decisions(spark)).collect()}
    auto = got["22222222222"]
    assert (auto.oppgavetype, auto.tildeltEnhetsnr, auto.aktoerId) == ("SOK", "9999", "2222222222200")
    assert (auto.behandlingstema, auto.behandlingstype, auto.beskrivelse) == ("ab0434", None, None)
    assert auto.fristFerdigstillelse == dt.date(2024, 1, 15)  # Wednesday morning + 3
    codes = {
        "33333333333": (None, "ae0004"),
        "928374927834": (None, None),
        "90384593875": (None, "ae0106"),
        "029834982": (None, None),
        "984561332": (None, None),
        "787359875": (None, "ae0106"),
        "000000001": ("ab0434", None),
    }
    for entry_id, (theme, kind) in codes.items():
        task = got[entry_id]
        assert (task.oppgavetype, task.behandlingstema, task.behandlingstype) == ("JFR", theme, kind)
        assert task.beskrivelse == "T" + entry_id
        assert task.aktoerId is None
        assert task.fristFerdigstillelse == dt.date(2024, 1, 11)
        assert (task.prioritet, task.aktivDato) == ("NORM", dt.date(2024, 1, 10))
    org = got["000000001"]
    assert (org.orgnr, org.tildeltEnhetsnr) == ("000999000", "9999")
    assert len(got) == 8


def test_update_and_finalization(spark):
    updates = outputs.journal_updates(_decisions(spark))
    (row,) = updates.collect()
    assert (row.entry_id, row.sender_id, row.sender_id_type) == ("22222222222", "22222222222", "FNR")
    assert (row.case_type, row.handling_theme) == ("GENERELL_SAK", "ab0434")
    (final,) = outputs.finalizations(updates).collect()
    assert (final.entry_id, final.journalfoerendeEnhet) == ("22222222222", "9999")
