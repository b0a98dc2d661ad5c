"""The test tables read as intake tables (mapping in FIXTURES.md, section 2)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postern import rules
from postern.functions.dates import epoch_ms
from postern.operators import retry
from postern.operators.decode import decode
from postern.operators.gates import gate
from postern.operators.routing import RETRY
from postern.sources import lookups

# Layout of the test tables; reading with it saves the job that would infer it.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
}

# Code hierarchy of theme SYK, form code -> "handling theme;handling type".
CODE_TERMS = {
    "NAV 08-07.04 D": "ab0434;",
    "NAV 08-07.11": "ab0421;",
    "NAV 08-09.06": ";ae0106",
    "NAV 08-09.07": "ab0314;",
    "NAV 08-09.08": ";ae0237",
    "NAV 08-14.01": "ab0237;ae0121",
    "NAV 08-20.05": "ab0200;",
    "NAV 08-20.12": "ab0200;ae0121",
    "NAV 08-20.20": "ab0200;",
    "NAV 08-35.01": ";ae0004",
    "NAV 08-47.05": ";ae0004",
    "NAV 90-00.08": ";ae0058",
    "NAVe 08-07.11": "ab0421;",
    "NAVe 08-09.06": ";ae0106",
    "NAVe 08-09.07": "ab0314;",
    "NAVe 08-09.08": ";ae0237",
    "NAVe 08-14.01": "ab0237;ae0121",
    "NAVe 08-20.05": "ab0200;",
    "NAVe 08-20.12": "ab0200;ae0121",
    "NAVe 08-20.20": "ab0200;",
    "NAVe 08-35.01": ";ae0004",
    "NAVe 08-47.05": ";ae0004",
}

# Point in time at which retry messages of the test tables are looked at.
RETRY_AS_OF = "TIMESTAMP_NTZ'2024-01-21 00:00:00'"
# The same in ms, and ten days earlier.
RETRY_AS_OF_MS = 1705795200000
RETRY_FIRST_MS = 1704931200000

# Unit of an entry in the test tables.
_UNIT = """CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  '
           ELSE lpad(CAST(o_orderkey % 10 AS STRING), 4, '0') END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS o_custkey",
        """CASE c_mktsegment WHEN 'MACHINERY' THEN 'ORGNR' WHEN 'BUILDING' THEN 'AKTOERID'
           WHEN 'AUTOMOBILE' THEN 'FNR' WHEN 'HOUSEHOLD' THEN 'PERSONBRUKER' END AS party_type""",
    )
    return (
        table(spark, sf_dir, "orders")
        .join(customers, "o_custkey", "left")
        .selectExpr(
            "CAST(o_orderkey AS STRING) AS entry_id",
            """CASE o_orderstatus WHEN 'O' THEN 'MOTTATT' WHEN 'P' THEN 'M'
               WHEN 'F' THEN 'JOURNALFOERT' END AS status""",
            """CASE o_orderpriority WHEN '1-URGENT' THEN 'UKJ' WHEN '2-HIGH' THEN 'PEN'
               ELSE 'SYK' END AS theme""",
            f"{_UNIT} AS unit",
            "concat('Order ', o_orderkey) AS title",
            "CASE o_orderkey % 11 WHEN 0 THEN 'ab9999' WHEN 1 THEN '' END AS preset_theme",
            "CASE WHEN o_orderkey % 3 = 0 THEN lpad(CAST(o_custkey AS STRING), 11, '0') END AS sender_id",
            "CASE WHEN o_orderkey % 3 = 0 THEN 'FNR' END AS sender_type",
            "CASE WHEN party_type IS NOT NULL THEN CAST(o_custkey AS STRING) END AS party_id",
            "party_type",
        )
    )


_CODES = """CASE p_type WHEN 'MEDIUM' THEN 'NAV 08-07.04 D' WHEN 'SMALL' THEN 'NAV 08-07.04D'
            WHEN 'ECONOMY' THEN '4936' WHEN 'LARGE' THEN 'NAV 08-35.01'
            WHEN 'STANDARD' THEN 'NAV 90-00.08 K' END AS form_code"""

def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document. (l_orderkey, l_linenumber) is not unique, but lines that also share
    the part have the same form code, so line number and part order the documents as far as any
    result depends on it."""
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey AS l_partkey", "p_name", _CODES)
    return (
        table(spark, sf_dir, "lineitem")
        .join(parts, "l_partkey", "left")
        .selectExpr(
            "CAST(l_orderkey AS STRING) AS entry_id",
            "struct(l_linenumber, l_partkey) AS doc_order",
            "form_code",
            "CASE l_discount WHEN 0 THEN NULL WHEN 0.1D THEN '' ELSE p_name END AS title",
        )
    )


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The journal in nested rows (``schemas.JOURNAL_ENTRY``), each with its documents in order."""
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey AS l_partkey", "p_name", _CODES)
    lists = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_discount")
        .join(parts, "l_partkey", "left")
        .selectExpr(
            "l_orderkey AS o_orderkey",
            """struct(l_linenumber, l_partkey, form_code AS brevkode,
                      CASE l_discount WHEN 0 THEN NULL WHEN 0.1D THEN '' ELSE p_name END AS tittel) AS line""",
        )
        .groupBy(F.col("o_orderkey").cast("string").alias("entry_id"))
        .agg(F.collect_list("line").alias("lines"))
    )
    return (
        journal(spark, sf_dir)
        .join(lists, "entry_id", "left")
        .selectExpr(
            "CASE WHEN party_id IS NOT NULL THEN struct(party_id AS id, party_type AS type) END AS bruker",
            "title AS tittel",
            "entry_id AS journalpostId",
            "status AS journalstatus",
            """transform(array_sort(coalesce(lines, array())), x -> struct(x.brevkode, x.tittel,
                   concat_ws('-', x.l_linenumber, x.l_partkey) AS dokumentInfoId)) AS dokumenter""",
            "unit AS journalforendeEnhet",
            "CAST(NULL AS ARRAY<STRUCT<dato: STRING, datotype: STRING>>) AS relevanteDatoer",
            "theme AS tema",
            "CASE WHEN sender_id IS NOT NULL THEN struct(sender_id AS id, sender_type AS type) END AS avsenderMottaker",
            "preset_theme AS behandlingstema",
        )
    )


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as ``lookups.document_facts`` takes them; a part stands for its code, so not all
    lines are joined with all parts: only parts without a name matter, and they are few. Every line has
    a part."""
    parts = table(spark, sf_dir, "part")
    nameless = parts.where("p_name IS NULL OR p_name = ''").selectExpr("p_partkey AS l_partkey", "true AS nameless")
    return (
        table(spark, sf_dir, "lineitem")
        .join(nameless, "l_partkey", "left")
        .selectExpr(
            "CAST(l_orderkey AS STRING) AS entry_id",
            "CAST(l_linenumber AS BIGINT) AS doc_order",
            "l_partkey AS code_id",
            "l_discount <> 0 AND l_discount <> 0.1D AND nameless IS NULL AS titled",
        )
    )


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr("p_partkey AS code_id", _CODES)


def document_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.document_facts(document_rows(spark, sf_dir), codes(spark, sf_dir))


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.entries_with_documents(journal(spark, sf_dir), document_facts(spark, sf_dir))


def identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sixth party also has an older national number, which must never be used."""

    def identity(group: str, ident: str, current: str) -> str:
        return f"named_struct('grp', '{group}', 'ident', {ident}, 'current', {current})"

    old = identity("FOLKEREGISTERIDENT", "concat('9', number)", "false")
    national = identity("FOLKEREGISTERIDENT", "number", "true")
    actor = identity("AKTORID", "concat(number, '00')", "true")
    return (
        table(spark, sf_dir, "customer")
        .where("c_acctbal >= 0")
        .selectExpr("c_custkey", "lpad(CAST(c_custkey AS STRING), 11, '0') AS number")
        .selectExpr(
            "CAST(c_custkey AS STRING) AS party_id",
            f"""array_compact(array(CASE WHEN c_custkey % 6 = 0 THEN {old} END,
                                    CASE WHEN c_custkey % 25 <> 1 THEN {national} END,
                                    CASE WHEN c_custkey % 20 <> 0 THEN {actor} END)) AS identities""",
        )
    )


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of every tenth part stand for the task system's tasks."""
    return (
        table(spark, sf_dir, "lineitem")
        .where("l_partkey % 10 = 0")
        .selectExpr(
            "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS task_id",
            "CAST(l_orderkey AS STRING) AS entry_id",
            "CASE WHEN l_linestatus = 'O' THEN 'AAPEN' ELSE 'AVSLUTTET' END AS category",
            "CASE l_returnflag WHEN 'A' THEN 'JFR' WHEN 'R' THEN 'FDR' ELSE 'SOK' END AS task_type",
        )
    )


def task_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tasks with the times between which they are open; those not finished have no end."""
    opened = "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(CAST((l_partkey + l_linenumber) % 40 AS INT))"
    return (
        table(spark, sf_dir, "lineitem")
        .where("l_partkey % 10 = 0")
        .selectExpr(
            "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS task_id",
            "CAST(l_orderkey AS STRING) AS entry_id",
            "CASE l_returnflag WHEN 'A' THEN 'JFR' WHEN 'R' THEN 'FDR' ELSE 'SOK' END AS task_type",
            f"{opened} AS opened_at",
            f"""CASE WHEN l_linestatus <> 'O'
                THEN {opened} + make_dt_interval(CAST(l_suppkey % 10 AS INT)) END AS closed_at""",
        )
    )


def tasks_of(decisions: DataFrame) -> DataFrame:
    """What the live table shows of the tasks that decisions asked for, an hour after: every ninth
    entry's not yet, those of even entries closed."""
    entry = F.col("entry_id").cast("bigint")
    made = decisions.where(F.col("outcome").isin(*rules.BLOCKING_TASK_TYPES) & (entry % 9 != 0))
    return made.select(
        F.concat(F.lit("new-"), "entry_id").alias("task_id"),
        "entry_id",
        F.when(entry % 2 == 0, rules.TASK_CLOSED).otherwise(rules.TASK_OPEN).alias("category"),
        F.col("outcome").alias("task_type"),
        (F.col("as_of") + F.expr("INTERVAL '1' HOUR")).alias("opened_at"),
    )


# What the event types of the test tables stand for.
EVENT_TYPES = {
    "click": "Mottatt",
    "view": "JournalpostMottatt",
    "signup": "MidlertidigJournalført",
    "error": "EndeligJournalført",
    "purchase": "TemaEndret",
}
_TYPE_CASES = " ".join(f"WHEN '{name}' THEN '{kind}'" for name, kind in EVENT_TYPES.items())

# The wire record of one row of the event table, after its order and time.
EVENT_COLUMNS = [
    "event_id AS event_order",
    "ts AS as_of",
    "concat('h-', event_id) AS hendelsesId",
    "1 AS versjon",
    f"CASE event_type {_TYPE_CASES} END AS hendelsesType",
    "CASE WHEN event_id % 97 = 0 THEN -1L ELSE event_id - event_id % 3 END AS journalpostId",
    "'MOTTATT' AS journalpostStatus",
    "'SYK' AS temaGammelt",
    """CASE WHEN CAST(get_json_object(props, '$.k') AS INT) % 4 = 0 THEN 'PEN' ELSE 'SYK' END
       AS temaNytt""",
    "'NAV_NO' AS mottaksKanal",
    "CAST(user_id AS STRING) AS kanalReferanseId",
    "'' AS behandlingstema",
]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, not yet gated, as wire records with their order and time."""
    return table(spark, sf_dir, "events").selectExpr(*EVENT_COLUMNS)


def gate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of the gated types, said in the table's own values so that the filter reaches
    its scan."""
    kinds = [name for name, kind in EVENT_TYPES.items() if kind in rules.GATE_EVENT_TYPES]
    rows = table(spark, sf_dir, "events").where(F.col("event_type").isin(kinds))
    return rows.selectExpr(*EVENT_COLUMNS)


def wire_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as JSON text with faults: some fields absent, some text not JSON, and an
    unknown field everywhere."""
    order = F.col("event_order")
    faulty = events(spark, sf_dir).withColumns(
        {
            "mottaksKanal": F.when(order % 37 != 0, F.col("mottaksKanal")),
            "temaGammelt": F.when(order % 41 != 0, F.col("temaGammelt")),
            "versjon": F.when(order % 43 != 0, F.col("versjon")),
            "behandlingstema": F.when(order % 5 == 0, F.lit("ab0001")),
            "ukjent": F.lit("x"),
        }
    )
    fields = [c for c in faulty.columns if c not in ("event_order", "as_of")]
    text = F.when(order % 101 == 0, F.lit("{not json")).otherwise(F.to_json(F.struct(*fields)))
    return faulty.select("event_order", "as_of", text.alias("value"))


def code_tree(spark: SparkSession) -> DataFrame:
    """The hierarchy as one JSON tree."""
    leaves = {
        code: {"kode": code, "termer": {rules.TERM_LANGUAGE: term}} for code, term in CODE_TERMS.items()
    }
    tree = {
        "hierarkinivaaer": ["Tema", "TemaSkjemaGjelderverdier"],
        "noder": {"SYK": {"kode": "SYK", "undernoder": leaves}},
    }
    return spark.sql("SELECT :tree AS value", args={"tree": json.dumps(tree)})


def hierarchy(spark: SparkSession) -> DataFrame:
    """Literal and small, so broadcast without counting."""
    return F.broadcast(lookups.flatten_code_tree(code_tree(spark)))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies of the task system to the first and second attempt, for every entry."""
    return (
        table(spark, sf_dir, "orders")
        .selectExpr("o_orderkey", "o_orderkey % 13 AS kind", f"coalesce({_UNIT}, '') AS unit")
        .selectExpr(
            "o_orderkey",
            "kind",
            r"""CASE kind WHEN 0 THEN concat('NAVEnheten \'', unit, '\' har status: \'Nedlagt\'')
                WHEN 1 THEN concat('NAVEnheten \'', unit, '\' er av typen oppgavebehandler')
                WHEN 2 THEN concat('Enheten med nummeret \'', unit, '\' eksisterer ikke')
                WHEN 3 THEN 'Organisasjonsnummer er ugyldig'
                WHEN 5 THEN 'Organisasjonsnummer er ugyldig' END AS message""",
        )
        .selectExpr(
            "CAST(o_orderkey AS STRING) AS entry_id",
            """inline(array(
                 struct(1 AS attempt, CASE WHEN kind <= 4 THEN 400 WHEN kind = 5 THEN 500 ELSE 201 END
                          AS http_status, message),
                 struct(2 AS attempt, CASE WHEN kind = 2 THEN 400 ELSE 201 END AS http_status,
                        CASE WHEN kind = 2 THEN message END AS message)))""",
        )
    )


def archive_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies of the archive to the update and the finalization, for every entry; some updates got
    none, some finalizations were refused at first."""
    return (
        table(spark, sf_dir, "orders")
        .selectExpr("CAST(o_orderkey AS STRING) AS entry_id", "o_orderkey % 17 AS kind")
        .selectExpr(
            "entry_id",
            """inline(array_compact(array(
                 CASE WHEN kind <> 1 THEN
                   struct('update' AS step, CASE WHEN kind = 0 THEN 500 ELSE 200 END AS http_status) END,
                 CASE WHEN kind > 1 THEN
                   struct('finalize' AS step, CASE WHEN kind IN (2, 3) THEN 500 ELSE 200 END AS http_status) END,
                 CASE WHEN kind = 3 THEN struct('finalize' AS step, 200 AS http_status) END)))""",
        )
    )


def request_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All replies as one table that names the request: those of the task system to the requests
    that are sent, and those of the archive, the first to each, where the task was accepted."""
    kind = F.col("entry_id").cast("bigint") % 13
    task = (
        answers(spark, sf_dir)
        .where((F.col("attempt") == 1) | (kind <= 3))
        .withColumn("step", F.lit("task"))
    )
    first = F.struct((F.col("http_status") < 300).alias("_accepted"), "http_status")
    archive = (
        archive_replies(spark, sf_dir)
        .where(~kind.isin(2, 4, 5))
        .groupBy("entry_id", "step")
        .agg(F.min(first)["http_status"].alias("http_status"))
        .withColumns({"attempt": F.lit(1), "message": F.lit(None).cast("string")})
    )
    return task.unionByName(archive).withColumns(
        {"batch_id": F.lit(0).cast("bigint"), "replied_at": F.timestamp_seconds(F.lit(1704103200))}
    )


def retry_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One broker message per event. The due time stands in the last header of its name, behind
    a stale one; every tenth message has no such header."""
    due_text = epoch_ms(F.col("as_of") + F.expr(rules.FIRST_RETRY_DELAY)).cast("string")

    def header(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("key"), value.cast("binary").alias("value"))

    other = header("other", F.lit("1"))
    dated = F.array(header(rules.DUE_HEADER, F.lit("0")), header(rules.DUE_HEADER, due_text), other)
    return decode(events(spark, sf_dir)).select(
        F.col("entry_id").alias("key"),
        retry.event_json().alias("value"),
        F.when(F.col("event_order") % 10 == 0, F.array(other)).otherwise(dated).alias("headers"),
    )


def retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retry rows as if every gated event had failed once: one waiting row per entry."""
    failed = decode(gate(gate_events(spark, sf_dir))).withColumn("outcome", F.lit(RETRY))
    return retry.enqueue(failed)


def date_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entry_id, value): JSON with a list of dates as an array, as a single object, or absent;
    and a list of strings likewise."""
    return (
        table(spark, sf_dir, "orders")
        .selectExpr("*", "date_format(o_orderdate, 'yyyy-MM-dd') AS dato")
        .selectExpr(
            "CAST(o_orderkey AS STRING) AS entry_id",
            """CASE o_orderkey % 4
               WHEN 0 THEN to_json(struct(
                   array(struct(dato, 'DATO_OPPRETTET' AS datotype),
                         struct(dato, 'DATO_REGISTRERT' AS datotype)) AS relevanteDatoer,
                   array('a', o_orderpriority) AS path))
               WHEN 1 THEN to_json(struct(
                   struct(dato, 'DATO_REGISTRERT' AS datotype) AS relevanteDatoer,
                   o_orderpriority AS path))
               WHEN 2 THEN '{}'
               ELSE '{"relevanteDatoer": null, "path": []}' END AS value""",
        )
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entry_id, value): lookup responses with an entry, without one, with and without errors;
    some errors have no message."""

    def error(message: str, code: str) -> str:
        return f"""struct({message} AS message,
                          struct('{code}' AS code, 'DataFetching' AS classification) AS extensions)"""

    not_found = error("concat('not found ', o_orderkey)", "not_found")
    no_text = error("CAST(NULL AS STRING)", "server_error")
    entry = """struct(CAST(o_orderkey AS STRING) AS journalpostId, o_orderstatus AS journalstatus,
                      CAST(array() AS ARRAY<STRING>) AS dokumenter, 'SYK' AS tema)"""
    return table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS entry_id",
        f"""to_json(struct(
              struct(CASE WHEN o_orderkey % 5 NOT IN (0, 4) THEN {entry} END AS journalpost) AS data,
              CASE o_orderkey % 5 WHEN 0 THEN array({not_found}, {no_text})
                   WHEN 1 THEN array({no_text}) END AS errors)) AS value""",
    )


def part_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(part_id, term): code terms of every shape: both parts, one blank, none, no separator."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS part_id",
        r"""CASE p_partkey % 6 WHEN 0 THEN concat('ab', p_partkey, ';ae', p_partkey)
            WHEN 1 THEN concat('ab', p_partkey, ';') WHEN 2 THEN concat(';ae', p_partkey, ';x')
            WHEN 3 THEN concat('ab', p_partkey) WHEN 4 THEN '  ;\t' END AS term""",
    )
