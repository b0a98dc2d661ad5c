"""The registered queries as plain SQL over the test tables, written from the rules and not
from the Spark code: rows are ranked by window functions, the decision is one CASE."""

from __future__ import annotations

# The code hierarchy once more, so that the queries share no table with this module.
_CODE_ROWS = """
    ('SYK', 'NAV 08-07.04 D', 'ab0434;'),
    ('SYK', 'NAV 08-07.11', 'ab0421;'),
    ('SYK', 'NAV 08-09.06', ';ae0106'),
    ('SYK', 'NAV 08-09.07', 'ab0314;'),
    ('SYK', 'NAV 08-09.08', ';ae0237'),
    ('SYK', 'NAV 08-14.01', 'ab0237;ae0121'),
    ('SYK', 'NAV 08-20.05', 'ab0200;'),
    ('SYK', 'NAV 08-20.12', 'ab0200;ae0121'),
    ('SYK', 'NAV 08-20.20', 'ab0200;'),
    ('SYK', 'NAV 08-35.01', ';ae0004'),
    ('SYK', 'NAV 08-47.05', ';ae0004'),
    ('SYK', 'NAV 90-00.08', ';ae0058'),
    ('SYK', 'NAVe 08-07.11', 'ab0421;'),
    ('SYK', 'NAVe 08-09.06', ';ae0106'),
    ('SYK', 'NAVe 08-09.07', 'ab0314;'),
    ('SYK', 'NAVe 08-09.08', ';ae0237'),
    ('SYK', 'NAVe 08-14.01', 'ab0237;ae0121'),
    ('SYK', 'NAVe 08-20.05', 'ab0200;'),
    ('SYK', 'NAVe 08-20.12', 'ab0200;ae0121'),
    ('SYK', 'NAVe 08-20.20', 'ab0200;'),
    ('SYK', 'NAVe 08-35.01', ';ae0004'),
    ('SYK', 'NAVe 08-47.05', ';ae0004')"""

# Common table expressions, each with the ones it needs before it.
_CTES = {
    "j": """
        SELECT CAST(o_orderkey AS VARCHAR) AS entry_id, o_orderkey, o_custkey,
               CASE o_orderstatus WHEN 'O' THEN 'MOTTATT' WHEN 'P' THEN 'M'
                    WHEN 'F' THEN 'JOURNALFOERT' END AS status,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'UKJ' WHEN '2-HIGH' THEN 'PEN'
                    ELSE 'SYK' END AS theme,
               CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  '
                    ELSE lpad(CAST(o_orderkey % 10 AS VARCHAR), 4, '0') END AS unit,
               'Order ' || o_orderkey AS title,
               CASE o_orderkey % 11 WHEN 0 THEN 'ab9999' WHEN 1 THEN '' END AS preset_theme,
               CASE WHEN o_orderkey % 3 = 0 THEN lpad(CAST(o_custkey AS VARCHAR), 11, '0') END AS sender_id,
               CASE WHEN o_orderkey % 3 = 0 THEN 'FNR' END AS sender_type,
               CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING', 'AUTOMOBILE', 'HOUSEHOLD')
                    THEN CAST(o_custkey AS VARCHAR) END AS party_id,
               CASE c_mktsegment WHEN 'MACHINERY' THEN 'ORGNR' WHEN 'BUILDING' THEN 'AKTOERID'
                    WHEN 'AUTOMOBILE' THEN 'FNR' WHEN 'HOUSEHOLD' THEN 'PERSONBRUKER' END AS party_type
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "d": """
        SELECT CAST(l_orderkey AS VARCHAR) AS entry_id,
               CASE p_type WHEN 'MEDIUM' THEN 'NAV 08-07.04 D' WHEN 'SMALL' THEN 'NAV 08-07.04D'
                    WHEN 'ECONOMY' THEN '4936' WHEN 'LARGE' THEN 'NAV 08-35.01'
                    WHEN 'STANDARD' THEN 'NAV 90-00.08 K' END AS code,
               CASE WHEN l_discount = 0 THEN NULL WHEN l_discount = 0.1 THEN '' ELSE p_name END AS title,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                   l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
                   l_shipdate) - 1 AS pos
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "en": """
        SELECT j.*, coalesce(f.n_documents, 0) AS n_documents, z.code AS form_code,
               coalesce(f.titles_ok, TRUE) AS titles_ok
        FROM j
        LEFT JOIN (SELECT entry_id, count(*) AS n_documents,
                          bool_and(title IS NOT NULL AND title <> '') AS titles_ok
                   FROM d GROUP BY entry_id) f ON f.entry_id = j.entry_id
        LEFT JOIN (SELECT entry_id, code FROM d WHERE pos = 0) z ON z.entry_id = j.entry_id""",
    "i": """
        SELECT CAST(c_custkey AS VARCHAR) AS party_id,
               CASE WHEN c_custkey % 20 <> 0
                    THEN lpad(CAST(c_custkey AS VARCHAR), 11, '0') || '00' END AS actor_id,
               CASE WHEN c_custkey % 25 <> 1
                    THEN lpad(CAST(c_custkey AS VARCHAR), 11, '0') END AS national_id
        FROM customer WHERE c_acctbal >= 0""",
    "t": """
        SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS task_id,
               CAST(l_orderkey AS VARCHAR) AS entry_id,
               CASE l_returnflag WHEN 'A' THEN 'JFR' WHEN 'R' THEN 'FDR' END AS task_type
        FROM lineitem
        WHERE l_partkey % 10 = 0 AND l_linestatus = 'O' AND l_returnflag IN ('A', 'R')""",
    "v": """
        SELECT *, CASE WHEN l_linestatus <> 'O' THEN opened_at + to_days(CAST(l_suppkey % 10 AS INTEGER)) END
                 AS closed_at
        FROM (SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS task_id,
                     CAST(l_orderkey AS VARCHAR) AS entry_id, l_linestatus, l_suppkey,
                     CASE l_returnflag WHEN 'A' THEN 'JFR' WHEN 'R' THEN 'FDR' ELSE 'SOK' END AS task_type,
                     TIMESTAMP '2024-01-01' + to_days(CAST((l_partkey + l_linenumber) % 40 AS INTEGER))
                       AS opened_at
              FROM lineitem WHERE l_partkey % 10 = 0)""",
    "ev": """
        SELECT event_id AS event_order, ts AS as_of, user_id,
               CASE WHEN event_id % 97 = 0 THEN '-1'
                    ELSE CAST(event_id - event_id % 3 AS VARCHAR) END AS entry_id,
               CASE event_type WHEN 'click' THEN 'Mottatt' WHEN 'view' THEN 'JournalpostMottatt'
                    WHEN 'signup' THEN 'MidlertidigJournalført' WHEN 'error' THEN 'EndeligJournalført'
                    WHEN 'purchase' THEN 'TemaEndret' END AS event_type,
               CASE WHEN CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) % 4 = 0
                    THEN 'PEN' ELSE 'SYK' END AS theme
        FROM events""",
    "g": """
        SELECT * FROM ev
        WHERE theme = 'SYK'
          AND event_type IN ('MidlertidigJournalført', 'Mottatt', 'JournalpostMottatt')""",
    "k": """
        SELECT entry_id, event_order AS first_event, as_of, n_events
        FROM (SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY event_order) AS rn,
                     count(*) OVER (PARTITION BY entry_id) AS n_events FROM g)
        WHERE rn = 1""",
    "kj": "SELECT entry_id, CAST(NULL AS BIGINT) AS first_event, CAST(NULL AS TIMESTAMP) AS as_of FROM j",
    "h": f"SELECT * FROM (VALUES {_CODE_ROWS}) AS v(theme, form_code, term)",
    "c": """
        SELECT theme, form_code,
               CASE WHEN trim(split_part(term, ';', 1)) <> '' THEN split_part(term, ';', 1) END AS mapped_theme,
               CASE WHEN trim(split_part(term, ';', 2)) <> '' THEN split_part(term, ';', 2) END AS mapped_type,
               term NOT LIKE '%;%' AS malformed
        FROM h""",
}

_FACTS = """
        SELECT {keys}.entry_id, {keys}.first_event, {keys}.as_of, en.entry_id IS NOT NULL AS found,
               en.status, en.theme, en.unit, en.title, en.sender_id, en.sender_type, en.party_id,
               en.party_type, en.form_code, en.titles_ok,
               coalesce(nullif(en.preset_theme, ''), c.mapped_theme) AS handling_theme,
               c.mapped_type AS handling_type, coalesce(c.malformed, FALSE) AS malformed,
               en.entry_id IN (SELECT entry_id FROM t) AS has_task,
               coalesce(en.theme = 'SYK' AND en.form_code IN ('NAV 08-07.04D', 'NAV 08-07.04 D'), FALSE)
                   AS listed,
               coalesce(en.theme = 'SYK' AND en.form_code IN ('4936', 'krav_om_fritak_fra_agp_gravid',
                   'krav_om_fritak_fra_agp_kronisk', 'soeknad_om_fritak_fra_agp_kronisk',
                   'refusjonskrav_arbeidsgiverperiode_korona', 'soeknad_om_fritak_fra_agp_gravid',
                   'refusjonskrav_utestengt_arbeider_korona',
                   'annuller_refusjonskrav_utestengt_arbeider_korona'), FALSE) AS ignored,
               i.party_id IS NOT NULL AS person, i.actor_id, i.national_id,
               en.party_type IS NOT NULL AND en.party_type <> 'ORGNR' AS lookup,
               coalesce(en.party_type IN ('AKTOERID', 'FNR'), FALSE) AS needs_actor
        FROM {keys}
        LEFT JOIN en ON en.entry_id = {keys}.entry_id
        LEFT JOIN c ON c.theme = en.theme AND c.form_code = en.form_code
        LEFT JOIN i ON i.party_id = en.party_id"""

_DECIDE = """
        SELECT *, split_part(decision, ':', 1) AS outcome,
               nullif(split_part(decision, ':', 2), '') AS reason
        FROM (SELECT *, CASE
            WHEN NOT found THEN 'RETRY:journal_missing'
            WHEN status NOT IN ('MOTTATT', 'M') THEN 'SKIP_STATUS'
            WHEN ignored THEN 'SKIP_IGNORED'
            WHEN has_task THEN 'SKIP_HAS_TASK'
            WHEN listed AND titles_ok AND malformed THEN 'RETRY:term_malformed'
            WHEN listed AND titles_ok AND lookup THEN
                CASE WHEN NOT person THEN 'RETRY:person_missing'
                     WHEN actor_id IS NULL THEN 'RETRY:actor_missing'
                     WHEN sender_id IS NULL AND national_id IS NULL THEN 'RETRY:sender_missing'
                     ELSE 'AUTO' END
            WHEN lookup AND NOT person THEN 'RETRY:person_missing'
            WHEN theme <> 'SYK' THEN
                CASE WHEN needs_actor AND actor_id IS NULL THEN 'RETRY:actor_missing' ELSE 'FDR' END
            WHEN malformed THEN 'RETRY:term_malformed'
            WHEN needs_actor AND actor_id IS NULL THEN 'RETRY:actor_missing'
            ELSE 'JFR' END AS decision FROM {facts})"""

_FAN_OUT = """
        SELECT g.*, g.event_order = x.first_event AS first_in_set, x.reason,
               CASE WHEN g.event_order = x.first_event THEN x.outcome
                    WHEN x.outcome IN ('JFR', 'FDR') THEN 'SKIP_HAS_TASK'
                    WHEN x.outcome = 'AUTO' THEN 'SKIP_STATUS'
                    ELSE x.outcome END AS outcome
        FROM g JOIN {decided} x ON x.entry_id = g.entry_id"""

# Reply number and class follow from the key alone in the test tables.
_SETTLE = """
        SELECT * REPLACE (CASE WHEN refused THEN 'RETRY' ELSE outcome END AS outcome,
                          CASE WHEN refused THEN 'task_rejected' ELSE reason END AS reason)
        FROM (SELECT x.*, outcome IN ('AUTO', 'JFR', 'FDR')
                     AND CAST(entry_id AS BIGINT) % 13 IN (2, 4, 5) AS refused FROM x)"""


def _deadline(ts: str, days: str) -> str:
    """Day after day, those from Monday to Friday are counted."""
    following = f"list_transform(range(1, 15), lambda n: CAST({ts} AS DATE) + CAST(n AS INTEGER))"
    working = f"list_filter({following}, lambda d: isodow(d) < 6)"
    return f"{working}[{days} + CASE WHEN hour({ts}) > 12 THEN 1 ELSE 0 END]"


_TASKS = f"""
        SELECT CASE WHEN outcome = 'AUTO' OR needs_actor THEN actor_id END AS "aktoerId",
               CASE WHEN outcome <> 'AUTO' AND party_type = 'ORGNR' THEN party_id END AS orgnr,
               entry_id AS "journalpostId",
               CASE WHEN outcome = 'FDR' AND theme = 'UKJ' THEN 'GEN' ELSE theme END AS tema,
               CASE WHEN outcome <> 'FDR' THEN handling_theme END AS behandlingstema,
               CASE WHEN outcome <> 'FDR' THEN handling_type END AS behandlingstype,
               CASE outcome WHEN 'AUTO' THEN 'SOK' ELSE outcome END AS oppgavetype,
               CASE outcome WHEN 'JFR' THEN unit
                    WHEN 'AUTO' THEN CASE WHEN trim(unit) <> '' AND entry_id <> '755763339' THEN unit END
                    END AS "tildeltEnhetsnr",
               CASE WHEN outcome = 'JFR' THEN title END AS beskrivelse,
               'NORM' AS prioritet,
               CAST(as_of AS DATE) AS "aktivDato",
               {_deadline("as_of", "(CASE outcome WHEN 'AUTO' THEN 3 ELSE 1 END)")} AS "fristFerdigstillelse"
        FROM x WHERE outcome IN ('AUTO', 'JFR', 'FDR')"""

_UPDATES = """
        SELECT entry_id, status, theme, unit, title, party_id, party_type AS party_id_type,
               coalesce(sender_id, national_id) AS sender_id,
               CASE WHEN sender_id IS NULL THEN 'FNR' ELSE sender_type END AS sender_id_type,
               'GENERELL_SAK' AS case_type, handling_theme, handling_type
        FROM y WHERE outcome = 'AUTO'"""

_EPOCH_MS = "epoch_us({}) // 1000"
_DUE = _EPOCH_MS.format("as_of + INTERVAL 1 SECOND")
_RETRY_AS_OF = "TIMESTAMP '2024-01-21 00:00:00'"
_FIRST_MS, _LATER_MS = "CAST(1704931200000 AS BIGINT)", "CAST(1705795200000 AS BIGINT)"
_RETRIES = f"""
        SELECT entry_id AS key, {_DUE} AS due_ms, as_of, event_order, event_type, theme, user_id
        FROM (SELECT *, row_number() OVER (PARTITION BY entry_id
                  ORDER BY {_DUE} DESC, event_order DESC) AS rn FROM {{failed}})
        WHERE rn = 1"""

_CTES["f"] = _FACTS.format(keys="k")
_CTES["x"] = _DECIDE.format(facts="f")
_CTES["y"] = _SETTLE
_CTES["r"] = _FAN_OUT.format(decided="x")
_CTES["s"] = _FAN_OUT.format(decided="y")
_CTES["fj"] = _FACTS.format(keys="kj")
_CTES["xj"] = _DECIDE.format(facts="fj")
_CTES["tr"] = _TASKS
_CTES["u"] = _UPDATES
_CTES["failed"] = "SELECT * FROM s WHERE outcome = 'RETRY'"
_CTES["q"] = _RETRIES.format(failed="g")
_CTES["qf"] = _RETRIES.format(failed="failed")
# JSON messages of the events: unreadable text, absent fields.
_CTES["w"] = """
        SELECT *, event_order % 101 = 0 AS unreadable,
               concat_ws(',', CASE WHEN event_order % 37 = 0 THEN 'mottaksKanal' END,
                              CASE WHEN event_order % 41 = 0 THEN 'temaGammelt' END) AS missing,
               theme = 'SYK' AND event_type IN ('MidlertidigJournalført', 'Mottatt', 'JournalpostMottatt')
                   AS passes
        FROM ev"""

_EVENT_CHAIN = ["j", "d", "en", "i", "t", "ev", "g", "k", "h", "c", "f", "x"]
_SETTLED_CHAIN = [*_EVENT_CHAIN, "y"]


def _sql(ctes: list[str], body: str) -> str:
    parts = ",\n".join(f"    {name} AS ({_CTES[name]})" for name in ctes)
    return f"WITH\n{parts}\n{body}" if ctes else body


_LOCAL_TS = """
SELECT event_order,
       as_of + CASE
           WHEN as_of >= last_day(make_date(CAST(year(as_of) AS INTEGER), 3, 1))
                    - CAST(isodow(last_day(make_date(CAST(year(as_of) AS INTEGER), 3, 1))) % 7 AS INTEGER)
                    + INTERVAL 1 HOUR
            AND as_of < last_day(make_date(CAST(year(as_of) AS INTEGER), 10, 1))
                    - CAST(isodow(last_day(make_date(CAST(year(as_of) AS INTEGER), 10, 1))) % 7 AS INTEGER)
                    + INTERVAL 1 HOUR
           THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS local_ts
FROM ev"""

_EVENT_OUTCOME = "SELECT event_order, entry_id, first_in_set, outcome, reason FROM {}"
_RETRY_VALUE = """'{"hendelsesId":"h-' || event_order || '","hendelsesType":"' || event_type
       || '","journalpostId":"' || key || '","temaNytt":"' || theme
       || '","mottaksKanal":"NAV_NO","journalpostStatus":"MOTTATT","versjon":1,"temaGammelt":"SYK",'
       || '"kanalReferanseId":"' || user_id || '","behandlingstema":""}'"""


def _json_text(column: str) -> str:
    return f"""coalesce('"' || {column} || '"', 'null')"""


ORACLE: dict[str, str] = {
    "outcome_counts": _sql(
        [*_EVENT_CHAIN, "r"], "SELECT outcome, reason, count(*) AS n_events FROM r GROUP BY ALL"
    ),
    "routed_events": _sql([*_EVENT_CHAIN, "r"], _EVENT_OUTCOME.format("r")),
    "routed_entries": _sql(
        ["j", "d", "en", "i", "t", "kj", "h", "c", "fj", "xj"],
        "SELECT entry_id, outcome, reason FROM xj",
    ),
    "settled_events": _sql([*_SETTLED_CHAIN, "s"], _EVENT_OUTCOME.format("s")),
    "dedup_in_batch": _sql(["ev", "g", "k"], "SELECT entry_id, first_event, n_events FROM k"),
    "gate_theme": _sql(["ev"], 'SELECT event_order, theme AS "temaNytt" FROM ev WHERE theme = \'SYK\''),
    "gate_event_type": _sql(
        ["ev"],
        """SELECT event_order, event_type AS "hendelsesType" FROM ev
WHERE event_type IN ('MidlertidigJournalført', 'Mottatt', 'JournalpostMottatt')""",
    ),
    "decode_events": _sql(
        ["ev", "w"],
        """SELECT event_order, entry_id, 'h-' || event_order AS "hendelsesId", event_type AS "hendelsesType",
       theme AS "temaNytt", 'NAV_NO' AS "mottaksKanal", 'MOTTATT' AS "journalpostStatus",
       CASE WHEN event_order % 43 = 0 THEN 0 ELSE 1 END AS versjon, 'SYK' AS "temaGammelt",
       CAST(user_id AS VARCHAR) AS "kanalReferanseId",
       CASE WHEN event_order % 5 = 0 THEN 'ab0001' ELSE '' END AS behandlingstema
FROM w WHERE passes AND NOT unreadable AND missing = ''""",
    ),
    "quarantine_events": _sql(
        ["ev", "w"],
        """SELECT event_order, CASE WHEN unreadable THEN 'unreadable' ELSE 'missing:' || missing END AS fault
FROM w WHERE unreadable OR (passes AND missing <> '')""",
    ),
    "single_as_array": """
SELECT CAST(o_orderkey AS VARCHAR) AS entry_id,
       CASE o_orderkey % 4 WHEN 0 THEN CAST(2 AS BIGINT) WHEN 1 THEN 1 END AS n_dates,
       CASE WHEN o_orderkey % 4 < 2 THEN strftime(o_orderdate, '%Y-%m-%d') END AS first_date,
       CASE o_orderkey % 4 WHEN 0 THEN 'DATO_OPPRETTET' WHEN 1 THEN 'DATO_REGISTRERT' END AS first_kind,
       CASE o_orderkey % 4 WHEN 0 THEN CAST(2 AS BIGINT) WHEN 1 THEN 1 WHEN 3 THEN 0 END AS n_path,
       CASE o_orderkey % 4 WHEN 0 THEN 'a/' || o_orderpriority WHEN 1 THEN o_orderpriority
            WHEN 3 THEN '' END AS path_text
FROM orders""",
    "envelope_unwrap": """
SELECT CAST(o_orderkey AS VARCHAR) AS entry_id, o_orderkey % 5 IN (0, 4) AS failed,
       CASE WHEN o_orderkey % 5 NOT IN (0, 4) THEN o_orderstatus END AS journalstatus,
       CASE WHEN o_orderkey % 5 NOT IN (0, 4) THEN 'SYK' END AS tema,
       CASE o_orderkey % 5 WHEN 0 THEN CAST(2 AS BIGINT) WHEN 1 THEN 1 ELSE 0 END AS n_errors
FROM orders""",
    "error_messages": """
SELECT CAST(o_orderkey AS VARCHAR) AS entry_id,
       CASE o_orderkey % 5 WHEN 0 THEN 'not found ' || o_orderkey || ' - null' WHEN 1 THEN 'null' END AS error_text
FROM orders""",
    "error_rows": """
SELECT CAST(o_orderkey AS VARCHAR) AS entry_id, CAST(0 AS BIGINT) AS pos,
       CASE WHEN o_orderkey % 5 = 0 THEN 'not found ' || o_orderkey END AS message,
       CASE WHEN o_orderkey % 5 = 0 THEN 'not_found' ELSE 'server_error' END AS code,
       'DataFetching' AS classification
FROM orders WHERE o_orderkey % 5 IN (0, 1)
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), 1, NULL, 'server_error', 'DataFetching'
FROM orders WHERE o_orderkey % 5 = 0""",
    "journal_snapshot": _sql(["j", "d", "en"], "SELECT * EXCLUDE (o_orderkey, o_custkey) FROM en"),
    "identity_lists": _sql(
        ["i"],
        """SELECT party_id,
       CAST((actor_id IS NOT NULL) AS BIGINT) + CAST((national_id IS NOT NULL) AS BIGINT) AS n_identities,
       concat_ws(',', 'FOLKEREGISTERIDENT:' || national_id, 'AKTORID:' || actor_id) AS identity_text
FROM i""",
    ),
    "first_identity": _sql(["i"], "SELECT party_id, actor_id, national_id FROM i"),
    "code_hierarchy_flat": _sql(
        ["j", "d", "en", "h"],
        """SELECT h.theme, h.form_code, h.term, count(en.entry_id) AS n_entries
FROM h LEFT JOIN en ON en.theme = h.theme AND en.form_code = h.form_code GROUP BY ALL""",
    ),
    "open_tasks": _sql(["t"], "SELECT task_id, entry_id, task_type FROM t"),
    "first_form_code": _sql(["j", "d", "en"], "SELECT entry_id, form_code FROM en"),
    "titles_valid": _sql(["j", "d", "en"], "SELECT entry_id, titles_ok FROM en"),
    "status_gate": _sql(["j"], "SELECT entry_id, status FROM j WHERE status IN ('MOTTATT', 'M')"),
    "ignore_list": _sql(
        ["j", "d", "en"],
        "SELECT entry_id, theme, form_code FROM en WHERE theme = 'SYK' AND form_code = '4936'",
    ),
    "auto_list": _sql(
        ["j", "d", "en"],
        """SELECT entry_id,
       coalesce(theme = 'SYK' AND form_code IN ('NAV 08-07.04D', 'NAV 08-07.04 D'), FALSE) AS listed
FROM en""",
    ),
    "form_rules": _sql(
        ["j", "d", "en"],
        """SELECT entry_id, 'SOK' AS task_type, CAST(3 AS INTEGER) AS deadline_days
FROM en WHERE theme = 'SYK' AND form_code IN ('NAV 08-07.04D', 'NAV 08-07.04 D')""",
    ),
    "has_open_task": _sql(
        ["j", "t"], "SELECT entry_id, status FROM j WHERE entry_id IN (SELECT entry_id FROM t)"
    ),
    "no_open_task": _sql(
        ["j", "t"], "SELECT entry_id, status FROM j WHERE entry_id NOT IN (SELECT entry_id FROM t)"
    ),
    "party_kind": _sql(
        ["j"],
        """SELECT entry_id, coalesce(party_type = 'AKTOERID', FALSE) AS is_actor,
       coalesce(party_type = 'FNR', FALSE) AS is_national,
       coalesce(party_type = 'ORGNR', FALSE) AS is_organisation
FROM j""",
    ),
    "manual_kind": _sql(
        ["j"],
        "SELECT entry_id, CASE WHEN theme = 'SYK' THEN 'JFR' ELSE 'FDR' END AS manual_type FROM j",
    ),
    "enrich_journal": _sql(
        ["j", "d", "en", "ev", "g"],
        """SELECT event_order, g.entry_id, en.entry_id IS NOT NULL AS entry_found, status, en.theme,
       form_code, titles_ok
FROM g LEFT JOIN en ON en.entry_id = g.entry_id""",
    ),
    "resolve_identities": _sql(
        ["j", "i"],
        """SELECT entry_id, i.party_id IS NOT NULL AS person_found, actor_id, national_id
FROM j LEFT JOIN i ON i.party_id = j.party_id AND j.party_type <> 'ORGNR'""",
    ),
    "map_codes": _sql(
        ["j", "d", "en", "h", "c"],
        """SELECT entry_id, coalesce(nullif(preset_theme, ''), mapped_theme) AS handling_theme,
       mapped_type AS handling_type
FROM en LEFT JOIN c ON c.theme = en.theme AND c.form_code = en.form_code""",
    ),
    "split_terms": """
SELECT p_partkey AS part_id,
       CASE WHEN p_partkey % 6 IN (0, 1, 3) THEN 'ab' || p_partkey END AS handling_theme,
       CASE WHEN p_partkey % 6 IN (0, 2) THEN 'ae' || p_partkey END AS handling_type,
       p_partkey % 6 = 3 AS malformed
FROM part""",
    "deadline_auto": _sql(["ev"], f"SELECT event_order, {_deadline('as_of', '3')} AS deadline FROM ev"),
    "deadline_manual": _sql(["ev"], f"SELECT event_order, {_deadline('as_of', '1')} AS deadline FROM ev"),
    "local_time": _sql(["ev"], _LOCAL_TS),
    "assigned_unit": _sql(
        ["j"],
        """SELECT entry_id, CASE WHEN trim(unit) <> '' AND entry_id <> '755763339' THEN unit END AS auto_unit,
       unit AS manual_unit
FROM j""",
    ),
    "task_party": _sql(
        ["j", "i"],
        """SELECT entry_id, CASE WHEN party_type IN ('AKTOERID', 'FNR') THEN actor_id END AS actor,
       CASE WHEN party_type = 'ORGNR' THEN j.party_id END AS organisation
FROM j LEFT JOIN i ON i.party_id = j.party_id""",
    ),
    "task_requests": _sql([*_EVENT_CHAIN, "tr"], "SELECT * FROM tr"),
    "auto_tasks": _sql([*_EVENT_CHAIN, "tr"], "SELECT * FROM tr WHERE oppgavetype = 'SOK'"),
    "manual_tasks": _sql([*_EVENT_CHAIN, "tr"], "SELECT * FROM tr WHERE oppgavetype = 'JFR'"),
    "distribution_tasks": _sql([*_EVENT_CHAIN, "tr"], "SELECT * FROM tr WHERE oppgavetype = 'FDR'"),
    "journal_updates": _sql([*_SETTLED_CHAIN, "u"], "SELECT * FROM u"),
    "update_bodies": _sql(
        [*_SETTLED_CHAIN, "u"],
        f"""SELECT entry_id, '{{"bruker":{{"id":"' || party_id || '","idType":"' || party_id_type
       || '"}},"tittel":"' || title || '","journalpostId":"' || entry_id || '","journalstatus":"' || status
       || '","journalforendeEnhet":' || {_json_text("unit")}
       || ',"sak":{{"sakstype":"GENERELL_SAK"}},"tema":"' || theme || '","avsenderMottaker":{{"id":"'
       || sender_id || '","idType":"' || sender_id_type || '"}},"behandlingstema":'
       || {_json_text("handling_theme")} || ',"behandlingstype":' || {_json_text("handling_type")}
       || '}}' AS body
FROM u""",
    ),
    "finalizations": _sql(
        [*_SETTLED_CHAIN, "u"], "SELECT entry_id, '9999' AS \"journalfoerendeEnhet\" FROM u"
    ),
    "current_journal": _sql(
        [*_SETTLED_CHAIN, "u"],
        """SELECT j.entry_id, j.status, j.theme, j.party_id, j.party_type, j.unit, j.title,
       CASE WHEN u.entry_id IS NOT NULL THEN u.sender_id ELSE j.sender_id END AS sender_id,
       CASE WHEN u.entry_id IS NOT NULL THEN u.sender_id_type ELSE j.sender_type END AS sender_type,
       u.case_type,
       CASE WHEN u.entry_id IS NOT NULL THEN u.handling_theme ELSE j.preset_theme END AS handling_theme,
       u.handling_type
FROM j LEFT JOIN u ON u.entry_id = j.entry_id""",
    ),
    "classify_rejections": """
SELECT CAST(o_orderkey AS VARCHAR) AS entry_id,
       CASE WHEN o_orderkey % 13 <= 4 THEN 400 WHEN o_orderkey % 13 = 5 THEN 500 ELSE 201 END AS http_status,
       CASE WHEN o_orderkey % 13 <= 2 THEN 'bad_unit' WHEN o_orderkey % 13 = 3 THEN 'bad_org' END AS rejection
FROM orders""",
    "repair_rejections": _sql(
        [*_EVENT_CHAIN, "tr"],
        """SELECT "journalpostId", oppgavetype, CASE WHEN kind <> 3 THEN orgnr END AS orgnr,
       CASE WHEN kind > 2 THEN "tildeltEnhetsnr" END AS "tildeltEnhetsnr",
       CASE WHEN kind <= 2 THEN 'bad_unit' WHEN kind = 3 THEN 'bad_org' END AS rejection,
       CASE WHEN kind <= 3 THEN 2 ELSE 1 END AS attempts,
       kind NOT IN (2, 4, 5) AS accepted,
       CASE WHEN kind IN (2, 4, 5) THEN 'task_rejected' END AS reason
FROM (SELECT *, CAST("journalpostId" AS BIGINT) % 13 AS kind FROM tr)""",
    ),
    "retry_enqueue": _sql(
        [*_SETTLED_CHAIN, "s", "failed", "qf"], f"SELECT key, {_RETRY_VALUE} AS value, due_ms FROM qf"
    ),
    "retry_due": _sql(
        ["ev", "g", "q"],
        f"SELECT key, due_ms FROM q WHERE due_ms <= {_EPOCH_MS.format(_RETRY_AS_OF)}",
    ),
    "quarantine_retries": _sql(
        ["ev", "g", "q"],
        """SELECT key AS entry_id, due_ms,
       CASE WHEN CAST(key AS BIGINT) % 101 = 0 THEN 'unreadable'
         ELSE 'missing:hendelsesId,hendelsesType,temaNytt,mottaksKanal,journalpostStatus,temaGammelt,kanalReferanseId' END AS fault,
       CASE WHEN CAST(key AS BIGINT) % 101 = 0 THEN '{broken'
         ELSE '{"journalpostId":"' || key || '"}' END AS raw
FROM q WHERE CAST(key AS BIGINT) % 101 = 0 OR CAST(key AS BIGINT) % 7 = 0""",
    ),
    "retry_retained": _sql(
        ["ev", "g", "q"],
        f"SELECT key, due_ms FROM q WHERE as_of >= {_RETRY_AS_OF} - INTERVAL 336 HOUR",
    ),
    "retry_waiting": _sql(
        ["ev", "g", "q"],
        f"""SELECT CASE WHEN as_of < {_RETRY_AS_OF} - INTERVAL 336 HOUR THEN 'expired'
            WHEN due_ms <= {_EPOCH_MS.format(_RETRY_AS_OF)} THEN 'due' ELSE 'waiting' END AS state,
       count(*) AS n_retries, min(as_of) AS oldest, max(due_ms) AS last_due_ms
FROM q GROUP BY ALL""",
    ),
    "archive_failures": _sql(
        _SETTLED_CHAIN,
        """SELECT entry_id, 'RETRY' AS outcome,
       CASE WHEN kind IN (0, 1) THEN 'update_failed' ELSE 'finalize_failed' END AS reason
FROM (SELECT *, CAST(entry_id AS BIGINT) % 17 AS kind FROM y)
WHERE outcome = 'AUTO' AND kind <= 2""",
    ),
    "stream_settle": _sql(
        _EVENT_CHAIN,
        """SELECT entry_id, step, attempt,
       CASE WHEN step = 'task' AND attempt = 1 AND kind <= 3 THEN 'repair'
            WHEN step = 'task' AND kind IN (2, 4, 5) THEN 'retry'
            WHEN step = 'task' AND outcome = 'AUTO' THEN 'update'
            WHEN step = 'update' AND archived <> 0 THEN 'finalize'
            WHEN step = 'finalize' AND archived > 3 OR step = 'task' THEN 'done' ELSE 'retry' END AS action,
       CASE WHEN step = 'task' AND kind IN (2, 4, 5) AND (attempt = 2 OR kind > 3) THEN 'task_rejected'
            WHEN step = 'update' AND archived = 0 THEN 'update_failed'
            WHEN step = 'finalize' AND archived <= 3 THEN 'finalize_failed' END AS reason
FROM (SELECT *, CAST(entry_id AS BIGINT) % 13 AS kind, CAST(entry_id AS BIGINT) % 17 AS archived FROM x),
     (VALUES ('task', 1), ('task', 2), ('update', 1), ('finalize', 1)) AS r(step, attempt)
WHERE outcome IN ('AUTO', 'JFR', 'FDR')
  AND CASE step WHEN 'task' THEN attempt = 1 OR kind <= 3
      WHEN 'update' THEN outcome = 'AUTO' AND kind NOT IN (2, 4, 5) AND archived <> 1
      ELSE outcome = 'AUTO' AND kind NOT IN (2, 4, 5) AND archived > 1 END""",
    ),
    "retry_schedule": _sql(
        ["ev", "g", "q"],
        """SELECT key, attempt, due_ms + (attempt - 1) * 600000 AS due_ms
FROM q, (VALUES (1), (2), (3)) AS n(attempt)""",
    ),
    "src_event_stream": _sql(
        ["ev"],
        """SELECT event_order, entry_id, event_type AS "hendelsesType", theme AS "temaNytt",
       CAST(user_id AS VARCHAR) AS "kanalReferanseId" FROM ev""",
    ),
    "src_retry_due": _sql(
        ["ev"],
        f"""SELECT entry_id AS key, CASE WHEN event_order % 10 = 0 THEN {_EPOCH_MS.format(_RETRY_AS_OF)}
       ELSE {_DUE} END AS due_ms FROM ev""",
    ),
    "stream_route": _sql([*_EVENT_CHAIN, "r"], _EVENT_OUTCOME.format("r")),
    "stream_enrich": _sql(
        ["j", "d", "en", "ev", "g", "h", "c"],
        """SELECT event_order, g.entry_id, en.theme, en.form_code,
       coalesce(nullif(preset_theme, ''), mapped_theme) AS handling_theme, mapped_type AS handling_type
FROM g LEFT JOIN en ON en.entry_id = g.entry_id
LEFT JOIN c ON c.theme = en.theme AND c.form_code = en.form_code""",
    ),
    "stream_retry": _sql(["ev", "g", "q"], "SELECT key, due_ms FROM q"),
    "stream_route_batches": _sql(
        [*_EVENT_CHAIN, "r"], "SELECT event_order, entry_id, outcome, reason FROM r"
    ),
    "stream_retry_held": _sql(
        ["ev", "g", "q"],
        f"""SELECT key, due_ms, CASE WHEN state LIKE 'r%' THEN 'released' ELSE state END AS state,
       CASE state WHEN 'r1' THEN {_FIRST_MS} WHEN 'r2' THEN {_LATER_MS} END AS released_ms
FROM (SELECT key, due_ms,
        CASE WHEN early AND expires_ms <= {_FIRST_MS} THEN 'expired'
             WHEN early AND due_ms <= {_FIRST_MS} THEN 'r1'
             WHEN expires_ms <= {_LATER_MS} THEN 'expired'
             WHEN due_ms <= {_LATER_MS} THEN 'r2' ELSE 'waiting' END AS state
      FROM (SELECT *, abs(CAST(key AS BIGINT)) % 2 = 0 AS early,
              {_EPOCH_MS.format("as_of + INTERVAL 336 HOUR")} AS expires_ms FROM q))""",
    ),
    "stream_closed_tasks": _sql(
        _EVENT_CHAIN,
        """, cut AS (SELECT min(event_id) + (max(event_id) - min(event_id)) // 2 + 1 AS c FROM events),
one AS (SELECT DISTINCT entry_id FROM g, cut WHERE event_order < c),
two AS (SELECT g.*, one.entry_id IS NOT NULL AS again,
          row_number() OVER (PARTITION BY g.entry_id ORDER BY event_order) = 1 AS first_in_set
        FROM g CROSS JOIN cut LEFT JOIN one USING (entry_id) WHERE event_order >= c)
SELECT event_order, two.entry_id, first_in_set, x.reason,
       CASE WHEN again AND outcome = 'AUTO' THEN 'SKIP_STATUS'
            WHEN again AND outcome IN ('JFR', 'FDR')
                 AND (CAST(two.entry_id AS BIGINT) % 9 = 0 OR CAST(two.entry_id AS BIGINT) % 2 <> 0)
              THEN 'SKIP_HAS_TASK'
            WHEN first_in_set THEN outcome
            WHEN outcome IN ('JFR', 'FDR') THEN 'SKIP_HAS_TASK'
            WHEN outcome = 'AUTO' THEN 'SKIP_STATUS' ELSE outcome END AS outcome
FROM two JOIN x ON x.entry_id = two.entry_id""",
    ),
    "events_with_task_at": _sql(
        ["ev", "g", "v"],
        """SELECT event_order, entry_id FROM g WHERE EXISTS (SELECT 1 FROM v
  WHERE v.entry_id = g.entry_id AND task_type <> 'SOK' AND opened_at <= as_of
    AND (closed_at IS NULL OR closed_at > as_of))""",
    ),
    "tasks_at": _sql(
        ["v"],
        f"""SELECT task_id, entry_id, task_type, opened_at,
       CASE WHEN closed_at <= {_RETRY_AS_OF} THEN 'AVSLUTTET' ELSE 'AAPEN' END AS category
FROM v WHERE opened_at <= {_RETRY_AS_OF}""",
    ),
}

# What ``stream_settle`` does to accepted tasks is what known replies do.
ORACLE["stream_settle_bodies"] = ORACLE["update_bodies"]
ORACLE["published_requests"] = ORACLE["task_requests"]
# Flat and nested rows hold the same entries.
ORACLE["snapshot_entries"] = ORACLE["journal_snapshot"]
_LISTED = """string_agg('{"brevkode":' || coalesce('"' || code || '"', 'null') || ',"tittel":'
         || coalesce('"' || title || '"', 'null') || ',"dokumentInfoId":"' || number || '"}',
       ',' ORDER BY l_linenumber, l_partkey, code, title NULLS FIRST)"""
ORACLE["snapshot_bodies"] = f"""
SELECT b.entry_id, left(body, length(body) - 1) || ',"dokumenter":[' || coalesce(listed, '')
       || '],"relevanteDatoer":null}}' AS body
FROM ({ORACLE["update_bodies"]}) AS b
LEFT JOIN (
  SELECT entry_id, {_LISTED} AS listed
  FROM (SELECT CAST(l_orderkey AS VARCHAR) AS entry_id, l_linenumber, l_partkey,
               l_linenumber || '-' || l_partkey AS number,
               CASE p_type WHEN 'MEDIUM' THEN 'NAV 08-07.04 D' WHEN 'SMALL' THEN 'NAV 08-07.04D'
                    WHEN 'ECONOMY' THEN '4936' WHEN 'LARGE' THEN 'NAV 08-35.01'
                    WHEN 'STANDARD' THEN 'NAV 90-00.08 K' END AS code,
               CASE WHEN l_discount = 0 THEN NULL WHEN l_discount = 0.1 THEN '' ELSE p_name END AS title
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)
  GROUP BY entry_id) AS d ON d.entry_id = b.entry_id"""
