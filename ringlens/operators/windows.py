"""Numbering, look-back and look-ahead within a visitor, call, chat or deal."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlens.operators.ordered import (
    Line,
    Running,
    following,
    number,
    previous,
    running,
)

KEY, TS, ID = "visitor_id", "date_time", "event_id"


def seconds_between(a: str | Column, b: str | Column) -> Column:
    """Whole seconds from ``a`` to ``b``."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    micros = F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp"))
    return (micros / 1000000).cast("long")


def along(events: DataFrame, *specs: Running) -> DataFrame:
    """Running columns along each visitor's events in time order.

    Events without a visitor are a group of their own.
    """
    return running(events, [KEY], [TS, ID], *specs)


def communication_number(comms: DataFrame) -> DataFrame:
    return along(comms, number("communication_number"))


def visits_count(events: DataFrame, is_visit: Column) -> DataFrame:
    """Communications with the number of visits made so far."""
    counted = Running("visits_count", "sum", F.when(is_visit, 1).otherwise(0).cast("long"))
    return along(events, counted).filter(~is_visit)


def first_campaign(visits: DataFrame, campaign: str) -> DataFrame:
    """Each visit with its visitor's first campaign and whether it differs."""
    first = visits.groupBy(KEY).agg(
        F.min_by(campaign, F.struct(TS, ID)).alias("first_campaign_id")
    )
    first = first.withColumnRenamed(KEY, "__visitor")
    return visits.join(first, F.col(KEY).eqNullSafe(F.col("__visitor"))).drop("__visitor").withColumn(
        "other_campaign", F.col(campaign) != F.col("first_campaign_id")
    )


def call_employees(legs: DataFrame, answered: Column) -> DataFrame:
    """First and last employee among the answered legs of a call."""
    rank = F.struct("leg_time", "leg_no", "employee_id")
    return (
        legs.filter(answered)
        .groupBy("call_id")
        .agg(
            F.min_by("employee_id", rank).alias("first_employee_id"),
            F.max_by("employee_id", rank).alias("last_employee_id"),
        )
    )


def stage_before_failure(history: DataFrame, stage: str, failed: str) -> DataFrame:
    out = along(history, previous("stage_before", F.col(stage)))
    return out.filter(F.col(stage) == failed)


def latest_state(history: DataFrame, key: str, state: str, order: list[str]) -> DataFrame:
    """Last state per key: an aggregate with map-side combine instead of a window."""
    return history.groupBy(key).agg(
        F.max_by(state, F.struct(*order)).alias(state), F.max(order[0]).alias(order[0])
    )


def lost_call_reaction(events: DataFrame, lost: Column, outgoing: Column) -> DataFrame:
    """Seconds from a lost call to the next outgoing call to the same contact."""
    ahead = following("__out", F.when(outgoing, F.col(TS)))
    return (
        along(events, ahead)
        .filter(lost)
        .withColumn("reaction", seconds_between(TS, "__out"))
        .drop("__out")
    )


def hit_durations(hits: DataFrame, gap_seconds: int) -> DataFrame:
    """Seconds spent on a hit; the last hit of a session has none."""
    spent = seconds_between(TS, "__next")
    return (
        along(hits, following("__next", F.col(TS)))
        .withColumn("duration", F.when(spent <= gap_seconds, spent))
        .drop("__next")
    )


def sessionize(hits: DataFrame, gap_seconds: int) -> DataFrame:
    """Number the sessions of a visitor; a longer pause than ``gap_seconds`` starts one."""
    line = Line.of(hits, [KEY], [TS, ID])
    with_prev = line.add(line.rows, previous("__prev", F.col(TS)))
    pause = seconds_between("__prev", TS)
    fresh = F.when(F.col("__prev").isNull() | (pause > gap_seconds), 1).otherwise(0)
    flagged = with_prev.withColumn("__fresh", fresh.cast("long"))
    numbered = line.add(flagged, Running("session_no", "sum", F.col("__fresh")))
    return line.bare(numbered).drop("__prev", "__fresh")


def state_intervals(history: DataFrame) -> DataFrame:
    """Each state with the time the next one replaced it."""
    return along(history, following("until", F.col(TS)))


def state_changes(history: DataFrame, state: str) -> DataFrame:
    """Only the rows where the state differs from the one before."""
    out = along(history, previous("previous_state", F.col(state)))
    return out.filter(~F.col(state).eqNullSafe(F.col("previous_state")))


def answer_wait(messages: DataFrame) -> DataFrame:
    """Turns from the first visitor message to the first operator message after the start."""
    def first(role):
        return F.min(F.when(F.col("role") == role, F.col("turn")))

    return (
        messages.groupBy("chat_id")
        .agg(first("user").alias("asked"), first("assistant").alias("answered"))
        .withColumn("wait", F.col("answered") - F.col("asked"))
    )
