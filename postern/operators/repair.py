"""Requests that were refused: task requests are repaired once by the class of the text, what the
archive refuses goes to retry."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postern.operators.routing import AUTO, RETRY, TASK_OUTCOMES
from postern.rules import REJECTION_TEXTS, REPAIRABLE_HTTP_STATUS

BAD_UNIT = "bad_unit"
BAD_ORG = "bad_org"
REJECTED = "task_rejected"
UPDATE_FAILED = "update_failed"
FINALIZE_FAILED = "finalize_failed"

# What a reply answers.
TASK = "task"
UPDATE = "update"
FINALIZE = "finalize"


def rejection_class(http_status: Column, message: Column) -> Column:
    """``bad_unit`` (tested first), ``bad_org`` or NULL. Only one HTTP status can be repaired,
    and only with a readable text."""

    def matches(kind: str) -> Column:
        pairs = [(first, second) for name, first, second in REJECTION_TEXTS if name == kind]
        tests = [message.contains(first) & message.contains(second) for first, second in pairs]
        return (http_status == REPAIRABLE_HTTP_STATUS) & reduce(lambda a, b: a | b, tests)

    return F.when(matches(BAD_UNIT), BAD_UNIT).when(matches(BAD_ORG), BAD_ORG)


def is_accepted(http_status: Column) -> Column:
    """An attempt without any reply counts as not accepted."""
    return F.coalesce(http_status.between(200, 299), F.lit(False))


_KINDS = [BAD_UNIT, BAD_ORG]
# A packed reply: accepted or not, HTTP status (one more than it is, zero if unknown), class.
_REFUSED, _KIND = 1 << 40, 1 << 3


def _packed_reply() -> Column:
    """What counts of a reply as one number, so the least one is found without sorting texts."""
    kind = rejection_class(F.col("http_status"), F.col("message"))
    number = F.array_position(F.array(*map(F.lit, _KINDS)), kind)
    status = F.coalesce(F.col("http_status").cast("bigint") + 1, F.lit(0))
    refused = F.when(is_accepted(F.col("http_status")), 0).otherwise(F.lit(_REFUSED))
    return refused + status * _KIND + F.coalesce(number, F.lit(_KIND - 1))


def _status_of(packed: Column) -> Column:
    status = F.shiftright(F.pmod(packed, F.lit(_REFUSED)), 3)
    return F.when(status > 0, (status - 1).cast("int"))


def with_replies(rows: DataFrame, answers: DataFrame, id_column: str) -> DataFrame:
    """Add what the task system replied: ``http_status`` of the first attempt, its ``rejection``
    class, the number of ``attempts`` (a classified rejection is repaired and sent once more) and
    whether the last one was ``accepted``. Repeated replies to an attempt count as one: an accepted
    one if there is any, then that of the least status and of the class tested first."""
    replies = (
        answers.select("entry_id", "attempt", _packed_reply().alias("_reply"))
        .groupBy(F.col("entry_id").alias(id_column))
        .agg(
            F.min(F.when(F.col("attempt") == 1, F.col("_reply"))).alias("_first"),
            F.min(F.when(F.col("attempt") == 2, F.col("_reply"))).alias("_second"),
        )
    )
    # A position past the end of the list, as of replies without class or of none, gives NULL.
    kind = F.coalesce(F.pmod(F.col("_first"), F.lit(_KIND)).cast("int"), F.lit(_KIND - 1))
    repaired = F.col("rejection").isNotNull()
    return (
        rows.join(replies, id_column, "left")
        .withColumn("http_status", _status_of(F.col("_first")))
        .withColumn("rejection", F.try_element_at(F.array(*map(F.lit, _KINDS)), kind))
        .withColumn("attempts", F.when(repaired, 2).otherwise(1))
        .withColumn("accepted", F.coalesce(F.when(repaired, F.col("_second")).otherwise(F.col("_first")) < _REFUSED, F.lit(False)))
        .drop("_first", "_second")
    )


def emptied(replied: DataFrame) -> DataFrame:
    """The refused field of a repaired request is empty: the unit or the organisation number."""
    kind = F.coalesce("rejection", F.lit(""))
    return replied.withColumn(
        "tildeltEnhetsnr", F.when(kind != BAD_UNIT, F.col("tildeltEnhetsnr"))
    ).withColumn("orgnr", F.when(kind != BAD_ORG, F.col("orgnr")))


def settle(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Every request after at most one repair, with the fields as last sent and the retry
    ``reason`` of those that were refused for good."""
    replied = emptied(with_replies(requests, answers, "journalpostId"))
    return replied.withColumn("reason", F.when(~F.col("accepted"), REJECTED))


def settled_decisions(decisions: DataFrame, answers: DataFrame) -> DataFrame:
    """Decisions after the task system's replies: an entry whose task was refused for good
    becomes RETRY, so it is neither updated nor finalized, and is tried again later."""
    replied = with_replies(decisions, answers, "entry_id")
    refused = F.col("outcome").isin(*TASK_OUTCOMES) & ~F.col("accepted")
    return (
        replied.withColumn("reason", F.when(refused, REJECTED).otherwise(F.col("reason")))
        .withColumn("outcome", F.when(refused, RETRY).otherwise(F.col("outcome")))
        .drop("http_status", "accepted")
    )


def after_archive(decisions: DataFrame, replies: DataFrame) -> DataFrame:
    """Decisions after the archive's replies (``entry_id``, ``step``, ``http_status``): an automatic
    entry whose update or finalization was not accepted becomes RETRY with the reason. Adds
    ``update_sent`` and ``update_accepted``; without that, nothing is finalized. Repeated replies
    count as one, and a reply that never came as a refusal."""

    def accepted(step: str) -> Column:
        return F.bool_or((F.col("step") == step) & is_accepted(F.col("http_status")))

    replied = replies.groupBy("entry_id").agg(
        accepted(UPDATE).alias("update_accepted"), accepted(FINALIZE).alias("_finalized")
    )
    sent = F.col("update_sent")
    failure = (
        F.when(sent & ~F.col("update_accepted"), UPDATE_FAILED)
        .when(sent & ~F.col("_finalized"), FINALIZE_FAILED)
    )
    return (
        decisions.join(replied, "entry_id", "left")
        .fillna(False, ["update_accepted", "_finalized"])
        .withColumn("update_sent", F.col("outcome") == AUTO)
        .withColumn("reason", F.coalesce(failure, "reason"))
        .withColumn("outcome", F.when(failure.isNotNull(), RETRY).otherwise(F.col("outcome")))
        .drop("_finalized")
    )


def updates_sent(decisions: DataFrame) -> DataFrame:
    """The automatic entries of ``after_archive`` as they were before the archive replied."""
    return decisions.where("update_sent").withColumn("outcome", F.lit(AUTO))
