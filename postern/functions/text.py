"""Null, empty and blank tests, and the split of a code term."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# trim() removes spaces only, so blank text is matched as Unicode white space.
_BLANK = r"(?U)^[\s\x1c-\x1f]*$"


def is_empty(text: Column) -> Column:
    """NULL or ''."""
    return F.coalesce(text == "", F.lit(True))


def is_blank(text: Column) -> Column:
    """NULL, '' or white space only."""
    return F.coalesce(text.rlike(_BLANK), F.lit(True))


def unless_blank(text: Column) -> Column:
    return F.when(~is_blank(text), text)


def term_part(term: Column, index: int) -> Column:
    """Part ``index`` of a ';'-separated term; NULL if absent or blank."""
    return unless_blank(F.get(F.split(term, ";"), F.lit(index)))


def term_malformed(term: Column) -> Column:
    """A term that is present but has no second part."""
    return F.coalesce(~term.contains(";"), F.lit(False))
