"""License scan by ordered signature rules.

A text is reduced to its words (runs of ASCII letters, digits and all characters beyond ASCII, A-Z
in lower case), joined by single spaces. A few keywords, looked for as plain substrings, gate the
rules: a rule runs only if one of its keywords occurs, and whatever it matches holds one of them.
Rules are ordered by priority; where matches overlap, a match that lies inside the interval of one
with better priority (or of equal priority and longer) is suppressed. The base phrases are counted
beside the rules and never suppressed.

Defined cases: a null or empty text has no words, no labels and score 0; invalid or repeated rows
are each scanned by themselves; other columns are ignored; a rule's match starts and ends at word
borders of the whole text, however long.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Label, words that name the license (a pattern over space-joined words), known versions.
FAMILIES = [
    ("apache", r"apache(?: software)?", ("1 0", "1 1", "2 0")),
    ("gpl", r"(?:gnu )?(?:gpl|general public)", ("1", "2", "3", "1 0", "2 0", "3 0")),
    ("lgpl", r"(?:gnu )?(?:lgpl|lesser general public|library general public)", ("2", "2 1", "3", "3 0")),
    ("agpl", r"(?:gnu )?(?:agpl|affero general public)", ("1", "3", "3 0")),
    ("fdl", r"(?:gnu )?(?:gfdl|fdl|free documentation)", ("1 1", "1 2", "1 3")),
    ("mpl", r"(?:mpl|mozilla public)", ("1 0", "1 1", "2 0")),
    ("epl", r"(?:epl|eclipse public)", ("1 0", "2 0")),
    ("cddl", r"(?:cddl|common development and distribution)", ("1 0", "1 1")),
    ("cpl", r"(?:cpl|common public)", ("1 0",)),
    ("eupl", r"(?:eupl|european union public)", ("1 0", "1 1", "1 2")),
    ("osl", r"(?:osl|open software)", ("1 0", "2 0", "3 0")),
    ("afl", r"(?:afl|academic free)", ("2 0", "2 1", "3 0")),
    ("artistic", r"artistic", ("1 0", "2 0")),
    ("boost", r"boost(?: software)?", ("1 0",)),
    ("cecill", r"cecill", ("1 0", "2 0", "2 1")),
    ("odbl", r"(?:odbl|open database)", ("1 0",)),
    ("ofl", r"(?:ofl|sil open font)", ("1 0", "1 1")),
    ("php", r"php", ("3 0", "3 01")),
    ("psf", r"(?:psf|python software foundation)", ("2", "2 0")),
    ("zpl", r"(?:zpl|zope public)", ("2 0", "2 1")),
    ("wtfpl", r"wtfpl", ("1", "2")),
    ("mit", r"(?:mit|expat|x11)", ()),
    ("bsd", r"(?:bsd|berkeley software distribution)", ()),
    ("isc", r"(?:isc|internet systems consortium)", ()),
    ("zlib", r"(?:zlib|libpng|zlib libpng)", ()),
    ("unlicense", r"unlicense", ()),
]
#: Short names that stand for nothing but a license, so that a "v" and a version make a title.
SHORT = {"fdl": ("gfdl", "fdl")} | {
    x: (x,)
    for x in "gpl lgpl agpl mpl epl cddl cpl eupl osl afl cecill odbl ofl zpl wtfpl".split()
}
#: Creative Commons elements: label and words.
COMMONS = [
    ("cc-by", r"(?:by|attribution)"),
    ("cc-by-sa", r"(?:by sa|attribution share ?alike)"),
    ("cc-by-nd", r"(?:by nd|attribution no ?deriv(?:ative)?s?)"),
    ("cc-by-nc", r"(?:by nc|attribution non ?commercial)"),
    ("cc-by-nc-sa", r"(?:by nc sa|attribution non ?commercial share ?alike)"),
    ("cc-by-nc-nd", r"(?:by nc nd|attribution non ?commercial no ?deriv(?:ative)?s?)"),
]
#: Whole notices and single sentences: priority, label, keyword, pattern, confidence.
NOTICES = [
    (0, "mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy", 1.0),
    (0, "isc", "permission", r"permission to use copy modify and or distribute this software for any purpose", 1.0),
    (0, "bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification", 1.0),
    (0, "bsd-3-clause", "endorse", r"may be used to endorse or promote products derived from this software", 1.0),
    (0, "zlib", "warranty", r"this software is provided as is without any express or implied warranty", 1.0),
    (0, "unlicense", "public domain", r"free and unencumbered software released into the public domain", 1.0),
    (0, "wtfpl", "public license", r"do what the fuck you want to public license", 1.0),
    (0, "boost-1.0", "boost", r"boost software license version 1 0 august 17th 2003", 1.0),
    (1, "gpl", "general public", r"redistribute it and or modify it under the terms of the gnu general public license", 1.0),
    (1, "lgpl", "general public", r"under the terms of the gnu lesser general public license", 1.0),
    (1, "agpl", "affero", r"under the terms of the gnu affero general public license", 1.0),
    (1, "mpl", "mozilla", r"subject to the terms of the mozilla public license", 1.0),
    (5, "public-domain", "public domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain", 0.9),
    (5, "cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?", 0.9),
    (6, "warranty-disclaimer", "warrant", r"without (?:any )?warrant(?:y|ies)(?: or conditions)? of any kind", 0.6),
    (6, "proprietary", "confidential", r"confidential and proprietary", 0.6),
    (6, "proprietary", "license agreement", r"end user license agreement", 0.6),
    (7, "copyright", "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}", 0.4),
    (7, "copyright", "copyright", r"copyright (?:c )?by", 0.4),
]


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    keywords: tuple[str, ...]
    pattern: str
    confidence: float


def rules() -> list[Rule]:
    """All rules, best priority first: notices as written above, and for each family and version
    an SPDX identifier, a grant ("licensed under ..."), a title with version and a bare title."""
    out = [Rule(p, label, (keyword,), *rest) for p, label, keyword, *rest in NOTICES]
    licence = r"licen[cs]e"
    licen, under, commons = ("licen",), ("under",), ("creative commons ", "cc ")
    # "2", "version 2", "v 2", "v2" and, as one word with the name, "gplv2".
    versions = r"(?:(?: version| v)? |(?: version)? ?v)"
    for label, name, known in FAMILIES:
        for version in known:
            dotted = f"{label}-{version.replace(' ', '.')}"
            sure = rf"{name}(?: {licence})?{versions}{version}"
            short = "|".join(SHORT.get(label, ()))
            later = rf"{sure}(?: {licence})? (?:or (?:any )?later|or newer|or at your option any later)"
            out += [
                Rule(1, f"{dotted}+", licen, rf"spdx {licence} identifier {label} {version} or later", 1.0),
                Rule(2, dotted, licen, rf"spdx {licence} identifier {label} {version}(?: only)?", 1.0),
                Rule(2, f"{dotted}+", ("later", "newer"), later, 0.95),
                Rule(3, dotted, under, rf"(?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?{sure}", 0.95),
                Rule(4, dotted, licen, rf"{name} {licence}{versions}{version}", 0.9),
            ]
            if short:
                starts = tuple(f"{x}{v}" for x in SHORT[label] for v in (" v", "v"))
                out.append(Rule(4, dotted, starts, rf"(?:gnu )?(?:{short})(?: version | v | ?v){version}", 0.9))
        out += [
            Rule(3, label, licen, rf"spdx {licence} identifier {label}", 1.0),
            Rule(4, label, under, rf"(?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?(?:[0-9] clause )?{name}(?: style)? {licence}", 0.9),
            Rule(5, label, licen, rf"(?:the )?{name} {licence}", 0.8),
        ]
    for label, words in COMMONS:
        out += [
            Rule(2, f"{label}-{version.replace(' ', '.')}", commons, rf"(?:creative commons|cc) {words}{versions}{version}", 1.0)
            for version in ("1 0", "2 0", "2 5", "3 0", "4 0")
        ]
        out.append(Rule(3, label, commons, rf"(?:creative commons|cc) {words}(?: {licence})?", 0.9))
        out.append(Rule(3, label, commons[:1], rf"creative commons {words}", 0.9))
    return sorted(out, key=lambda r: r.priority)


# Non-word ASCII becomes a space, A-Z lower case; bytes of characters beyond ASCII stay.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


@lru_cache(maxsize=1)
def _compiled() -> list[tuple[tuple[str, ...], list[tuple[Rule, re.Pattern]]]]:
    by_keywords: dict[tuple[str, ...], list[tuple[Rule, re.Pattern]]] = {}
    for rule in rules():
        pattern = re.compile(rf"(?<![^ ])(?:{rule.pattern})(?![^ ])")
        by_keywords.setdefault(rule.keywords, []).append((rule, pattern))
    return list(by_keywords.items())


def _suppressed(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Matches that lie in no interval of a match with better priority or of a longer one. Taken in
    that order; a binary indexed tree over the starts holds how far the matches that are kept and
    start no later reach, so a text with many matches takes little more time than to sort them."""
    starts = sorted({start for start, _, _ in found})
    place = {start: i + 1 for i, start in enumerate(starts)}
    reach = [-1] * (len(starts) + 1)
    kept: list[tuple[int, int, Rule]] = []
    for start, end, rule in sorted(found, key=lambda m: (m[2].priority, m[0] - m[1], m[0])):
        i, furthest = place[start], -1
        while i:
            furthest = max(furthest, reach[i])
            i &= i - 1
        if end <= furthest:
            continue
        kept.append((start, end, rule))
        i = place[start]
        while i <= len(starts):
            reach[i] = max(reach[i], end)
            i += i & -i
    return kept


def scan(text: str | None) -> dict:
    """Digest of one whole text: counts, base places, detections as (label, first word, words)."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()
    joined = b" ".join(words).decode("utf-8", "surrogatepass")
    base = [
        (m.start(), label)
        for phrase, label in BASE.items()
        if phrase in joined
        for m in re.finditer(rf"(?<![^ ]){phrase}(?![^ ])", joined)
    ]
    found = [
        (*m.span(), rule)
        for keywords, own in _compiled()
        if any(k in joined for k in keywords)
        for rule, pattern in own
        for m in pattern.finditer(joined)
    ]
    if base or found:
        # Where each word begins; a match begins and ends with a word.
        begins = np.cumsum([0, *(len(w) + 1 for w in joined.split(" "))])
        at = lambda places: np.searchsorted(begins, places).tolist()
        base = list(zip(at([place for place, _ in base]), (label for _, label in base), strict=True))
        found = _suppressed(found)
        first, after = at([s for s, _, _ in found]), at([e for _, e, _ in found])
        found = [(s, e - s, r) for s, e, (_, _, r) in zip(first, after, found, strict=True)]
    detections = sorted((s, n, rule.label, rule.confidence) for s, n, rule in found)
    labels = {label for _, label in base}
    return {
        "n_words": len(words),
        "n_base": len(base),
        "first_word": min((i for i, _ in base), default=None),
        "last_word": max((i for i, _ in base), default=None),
        "base_labels": ",".join(sorted(labels)),
        "labels": ",".join(sorted(labels | {d[2] for d in detections})),
        "score": max([d[3] for d in detections] + [0.5] * bool(base), default=0.0),
        "detections": [{"label": d[2], "word": d[0], "words": d[1], "score": d[3]} for d in detections],
    }


SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        *[(c, pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")],
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        (
            "detections",
            pa.list_(
                pa.struct([("label", pa.string()), ("word", pa.int64()), ("words", pa.int64()), ("score", pa.float64())])
            ),
        ),
    ]
)


def scan_documents(docs: DataFrame) -> DataFrame:
    """Every document's scan; a map over the texts, without any shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                {"doc_id": i.as_py()} | scan(t.as_py())
                for i, t in zip(batch.column(0), batch.column(1), strict=True)
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)

    return docs.select("doc_id", "text").mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, "
        "detections array<struct<label:string,word:bigint,words:bigint,score:double>>",
    )
