"""Random entries and events: the set-at-a-time result equals handling one event after the
other, each seeing what the ones before it left."""

import random

import fixtures as X
from postern.operators import outputs
from postern.plans import intake

CODES = [X.AUTO_CODE, "NAV 08-07.04D", "4936", X.MANUAL_CODE, "BAD", "?", None]
HIERARCHY = {X.AUTO_CODE: "ab0434;", X.MANUAL_CODE: ";ae0004", "BAD": "ab0001"}


def make_world(seed):
    rng = random.Random(seed)
    entries, people, tasks = {}, {}, []
    for n in range(40):
        groups = rng.choice([None, ["FOLKEREGISTERIDENT"], ["AKTORID"]] + [["FOLKEREGISTERIDENT", "AKTORID"]] * 4)
        if groups is not None:
            people[f"p{n}"] = groups
    for n in range(250):
        kind = rng.choice(["FNR", "FNR", "AKTOERID", "ORGNR", "PERSONBRUKER", None])
        entries[str(n)] = X.entry(
            str(n),
            status=rng.choice(["MOTTATT", "MOTTATT", "M", "JOURNALFOERT"]),
            theme=rng.choice(["SYK", "SYK", "SYK", "UKJ", "PEN"]),
            code=rng.choice(CODES[:2] * 3 + CODES),
            titles=rng.choice([("a",), ("a", "b"), ("a", ""), (None,), (), (" ",)]),
            party=kind and (f"p{rng.randrange(50)}", kind),
            unit=rng.choice([None, "", " ", "1234"]),
            sender=rng.choice([None, None, (None, "FNR"), ("s", "ORGNR")]),
        )
        if rng.random() < 0.2:
            tasks.append((f"t{n}", str(n), rng.choice(["AAPEN", "AVSLUTTET"]), rng.choice(["JFR", "FDR", "SOK"])))
    events = [str(rng.randrange(-20, 250)) for _ in range(700)]
    return entries, people, tasks, events


class Retry(Exception):
    pass


def serial(entries, people, tasks, events):
    """Outcome per event, one at a time."""
    open_ids = {e for _, e, c, k in tasks if c == "AAPEN" and k in ("JFR", "FDR")}
    done = set()

    def identities(row):
        party = row["bruker"]
        if party is None or party["type"] == "ORGNR":
            return None
        if party["id"] not in people:
            raise Retry("person_missing")
        return people[party["id"]]

    def first(groups, group, reason):
        if group not in groups:
            raise Retry(reason)

    def broken(row, code):
        if row["tema"] == "SYK" and code in HIERARCHY and ";" not in HIERARCHY[code]:
            raise Retry("term_malformed")

    def by_hand(entry_id, row, code):
        if entry_id in open_ids:
            return "SKIP_HAS_TASK"
        groups = identities(row) or []
        needs_actor = row["bruker"] is not None and row["bruker"]["type"] in ("FNR", "AKTOERID")
        outcome = "JFR" if row["tema"] == "SYK" else "FDR"
        if outcome == "JFR":
            broken(row, code)
        if needs_actor:
            first(groups, "AKTORID", "actor_missing")
        open_ids.add(entry_id)
        return outcome

    def handle(entry_id):
        row = entries.get(entry_id)
        if row is None:
            raise Retry("journal_missing")
        if entry_id in done or row["journalstatus"] not in ("MOTTATT", "M"):
            return "SKIP_STATUS"
        documents = row["dokumenter"]
        code = documents[0]["brevkode"] if documents else None
        if row["tema"] == "SYK" and code == "4936":
            return "SKIP_IGNORED"
        listed = row["tema"] == "SYK" and code in CODES[:2]
        if not listed or not all(d["tittel"] for d in documents):
            return by_hand(entry_id, row, code)
        if entry_id in open_ids:
            return "SKIP_HAS_TASK"
        broken(row, code)
        groups = identities(row)
        if groups is None:
            return by_hand(entry_id, row, code)
        first(groups, "AKTORID", "actor_missing")
        if not (row["avsenderMottaker"] or {}).get("id"):
            first(groups, "FOLKEREGISTERIDENT", "sender_missing")
        done.add(entry_id)
        return "AUTO"

    results = []
    for entry_id in events:
        try:
            results.append((handle(entry_id), None))
        except Retry as failure:
            results.append(("RETRY", str(failure)))
    return results


def test_equals_serial_handling(spark):
    seen = set()
    for seed in (1, 2, 3):
        entries, people, tasks, events = make_world(seed)
        source = X.make_lookups(
            spark,
            list(entries.values()),
            [X.person(p, *groups) for p, groups in people.items()],
            tasks,
            [("SYK", "BAD", HIERARCHY["BAD"])],
        )
        rows = spark.createDataFrame([(n, X.WEDNESDAY_MORNING, e) for n, e in enumerate(events)], X.EVENTS)
        got = {r.event_order: (r.outcome, r.reason) for r in intake.route_events(rows, source).collect()}
        want = dict(enumerate(serial(entries, people, tasks, events)))
        assert {n: (got[n], want[n]) for n in want if got[n] != want[n]} == {}
        seen |= set(want.values())
        decided = intake.decide_events(rows, source)
        made = sum(outcome in ("AUTO", "JFR", "FDR") for outcome, _ in want.values())
        assert outputs.task_requests(decided).count() == made
    assert len(seen) >= 11  # all outcomes and reasons occur
