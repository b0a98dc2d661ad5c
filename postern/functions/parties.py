"""Party kinds and identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postern.rules import GROUP_ACTOR, GROUP_NATIONAL, PARTY_ACTOR, PARTY_ORGANISATION, PARTY_PERSON


def has_type(party_type: Column, *kinds: str) -> Column:
    """Never NULL: an entry without a party has none of the types."""
    return F.coalesce(party_type.isin(*kinds), F.lit(False))


def is_organisation(party_type: Column) -> Column:
    return has_type(party_type, PARTY_ORGANISATION)


def is_person(party_type: Column) -> Column:
    """Named by actor id or national number; other person types are neither."""
    return has_type(party_type, PARTY_ACTOR, PARTY_PERSON)


def first_identity(identities: Column, group: str) -> Column:
    """First identity of ``group`` in list order; NULL if there is none."""
    of_group = F.filter(identities, lambda i: i["grp"] == group)
    return F.get(of_group, F.lit(0))["ident"]


def actor_id(identities: Column) -> Column:
    return first_identity(identities, GROUP_ACTOR)


def national_id(identities: Column) -> Column:
    return first_identity(identities, GROUP_NATIONAL)
