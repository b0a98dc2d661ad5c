"""Record layouts. Names inside wire records are the data format and stay as delivered;
columns derived by this package have English names.

Table layouts used between the steps:

events      event_order bigint, as_of timestamp_ntz, entry_id string, + the wire fields
entries     entry_id, status, theme, unit, title, preset_theme, sender_id, sender_type,
            party_id, party_type, n_documents, form_code, titles_ok, entry_ok
documents   entry_id, doc_order (any orderable type), form_code, title
identities  party_id, identities array<struct<grp, ident, current>>
tasks       task_id, entry_id, category, task_type, opened_at timestamp_ntz (may be absent)
hierarchy   theme, form_code, term
answers     entry_id, attempt, http_status, message
archive     entry_id, step (update, finalize), http_status
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S = T.StringType()

# Wire field names and defaults.
EVENT_WIRE = _struct(
    ("hendelsesId", _S),
    ("versjon", T.IntegerType()),
    ("hendelsesType", _S),
    ("journalpostId", T.LongType()),
    ("journalpostStatus", _S),
    ("temaGammelt", _S),
    ("temaNytt", _S),
    ("mottaksKanal", _S),
    ("kanalReferanseId", _S),
    ("behandlingstema", _S),
)
# Decoded event; also the JSON of a retry message. The id is text here.
EVENT_DECODED = _struct(
    ("hendelsesId", _S),
    ("hendelsesType", _S),
    ("journalpostId", _S),
    ("temaNytt", _S),
    ("mottaksKanal", _S),
    ("journalpostStatus", _S),
    ("versjon", T.IntegerType()),
    ("temaGammelt", _S),
    ("kanalReferanseId", _S),
    ("behandlingstema", _S),
)
EVENT_REQUIRED = [
    "hendelsesId",
    "hendelsesType",
    "journalpostId",
    "temaNytt",
    "mottaksKanal",
    "journalpostStatus",
    "temaGammelt",
    "kanalReferanseId",
]
EVENT_DEFAULTS = {"versjon": 0, "behandlingstema": ""}

DOCUMENT = _struct(("brevkode", _S), ("tittel", _S), ("dokumentInfoId", _S))
JOURNAL_ENTRY = _struct(
    ("bruker", _struct(("id", _S), ("type", _S))),
    ("tittel", _S),
    ("journalpostId", _S),
    ("journalstatus", _S),
    ("dokumenter", T.ArrayType(DOCUMENT)),
    ("journalforendeEnhet", _S),
    ("relevanteDatoer", T.ArrayType(_struct(("dato", _S), ("datotype", _S)))),
    ("tema", _S),
    ("avsenderMottaker", _struct(("id", _S), ("type", _S))),
    ("behandlingstema", _S),
)
IDENTITY = _struct(("gruppe", _S), ("ident", _S))

ERROR = _struct(
    ("message", _S),
    ("locations", T.ArrayType(_struct(("line", _S), ("column", _S)))),
    ("path", T.ArrayType(_S)),
    ("extensions", _struct(("code", _S), ("classification", _S))),
)


def envelope(entity_field: str, entity: T.DataType) -> T.StructType:
    """Lookup response: ``data.<entity_field>`` and an error list."""
    return _struct(
        ("data", _struct((entity_field, entity))),
        ("errors", T.ArrayType(ERROR)),
    )


CODE_TREE = _struct(
    ("hierarkinivaaer", T.ArrayType(_S)),
    (
        "noder",
        T.MapType(
            _S,
            _struct(
                ("kode", _S),
                (
                    "undernoder",
                    T.MapType(_S, _struct(("kode", _S), ("termer", T.MapType(_S, _S)))),
                ),
            ),
        ),
    ),
)

RETRY_MESSAGE = _struct(
    ("key", _S),
    ("value", _S),
    ("headers", T.ArrayType(_struct(("key", _S), ("value", T.BinaryType())))),
)
