"""Joins of facts, dimensions, lists, prefixes, schedules and campaign conditions.

No join carries a broadcast hint: Catalyst and AQE broadcast a side whose size they have
checked against ``spark.sql.autoBroadcastJoinThreshold`` and shuffle it otherwise, and AQE
splits skewed partitions of the shuffled form.
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlens.operators.filters import Cond, compile_filter


def enrich(fact: DataFrame, *dims: tuple[DataFrame, str]) -> DataFrame:
    """Add dimension columns; a row with a missing key stays."""
    for dim, key in dims:
        fact = fact.join(dim, key, "left")
    return fact


def calls_legs(calls: DataFrame, legs: DataFrame) -> DataFrame:
    return legs.join(calls, "call_id")


def person_of(visitors: DataFrame, persons: DataFrame) -> DataFrame:
    """Identity of each visitor: ``visitor_id`` against ``persons.contact_id``."""
    return visitors.join(persons, F.col("visitor_id") == F.col("contact_id"))


def visitors_of(persons: DataFrame, visits: DataFrame) -> DataFrame:
    """The visitors seen for each person, with their visit count and time span."""
    seen = visits.groupBy("visitor_id").agg(
        F.count("*").alias("visits"),
        F.min("date_time").alias("first_seen"),
        F.max("date_time").alias("last_seen"),
    )
    return persons.join(seen, F.col("contact_id") == F.col("visitor_id"))


def without_session(comms: DataFrame, visits: DataFrame, key: str, visit_key: str) -> DataFrame:
    """Communications of contacts that never visited."""
    seen = visits.select(F.col(visit_key).alias(key)).distinct()
    return comms.join(seen, key, "left_anti")


def blacklist(rows: DataFrame, blocked: DataFrame, key: str, keep_blocked: bool) -> DataFrame:
    listed = blocked.select(key).distinct()
    return rows.join(listed, key, "left_semi" if keep_blocked else "left_anti")


def longest_prefix(phones: DataFrame, key: str, prefixes: DataFrame) -> DataFrame:
    """Longest listed prefix of each distinct number, by an equality join on its prefixes.

    Only prefix lengths in use are generated; a phone number has at most 15 digits, so the
    list of lengths is bounded.
    """
    lengths = prefixes.agg(F.array_sort(F.collect_set(F.length("prefix")))).scalar()
    candidates = (
        phones.select(key)
        .distinct()
        .withColumn("n", F.explode(lengths))
        .filter(F.col("n") <= F.length(key))
        .withColumn("prefix", F.expr(f"left({key}, n)"))
    )
    best = (
        candidates.join(prefixes, "prefix")
        .groupBy(key)
        .agg(
            F.max_by("prefix", "n").alias("prefix"), F.max_by("prefix_name", "n").alias("prefix_name")
        )
    )
    return phones.join(best, key, "left")


def in_schedule(rows: DataFrame, ts: str, key: str, schedule: DataFrame) -> DataFrame:
    """Flag rows whose time falls into an active span of their schedule.

    The spans of one (schedule, weekday) are folded into a set first, which the minutes of a
    day bound, so the join never multiplies rows. Weekday 1 is Monday; spans are minutes, end excluded.
    """
    spans = schedule.groupBy(key, "weekday").agg(
        F.collect_set(F.struct("minute_from", "minute_till")).alias("spans")
    )
    minute = F.hour(ts) * 60 + F.minute(ts)
    hit = F.exists(
        "spans", lambda s: (F.col("minute") >= s.minute_from) & (F.col("minute") < s.minute_till)
    )
    return (
        rows.withColumns({"weekday": F.weekday(ts) + 1, "minute": minute})
        .join(spans, [key, "weekday"], "left")
        .withColumn("in_schedule", F.coalesce(hit, F.lit(False)))
        .drop("spans", "weekday", "minute")
    )


@dataclass(frozen=True)
class CampaignCondition:
    """One parameter test of a campaign: operator '=', 'sub' or '~'."""

    campaign_id: int
    parameter: str
    operator: str
    value: str


def _by_campaign(conditions) -> dict[int, list[CampaignCondition]]:
    out: dict[int, list[CampaignCondition]] = {}
    for c in conditions:
        out.setdefault(c.campaign_id, []).append(c)
    return dict(sorted(out.items()))


def _holds(c: CampaignCondition) -> Column:
    return F.coalesce(compile_filter(Cond(c.parameter, c.operator, c.value)), F.lit(False))


def assign_campaign(visits: DataFrame, conditions: list[CampaignCondition]) -> DataFrame:
    """One row per visit and campaign all of whose conditions hold.

    Conditions are report definitions, so they become literals of one row expression: no
    join, no shuffle, whatever the number of visits.
    """
    tests = [
        F.when(reduce(lambda a, b: a & b, map(_holds, own)), F.lit(campaign))
        for campaign, own in _by_campaign(conditions).items()
    ]
    matched = F.filter(F.array(*tests), lambda x: x.isNotNull())
    return visits.withColumn("campaign_id", F.explode(matched))


def score_campaign(
    visits: DataFrame, conditions: list[CampaignCondition], weights: DataFrame
) -> DataFrame:
    """Best campaign per visit: sum of the site's weights of matched parameters.

    Chosen rule: every matched condition adds its parameter's weight; the highest score
    wins, the lower campaign id on ties; a score of 0 assigns none.
    """
    # one weight per site and parameter, so a site's map is as small as the parameter list
    single = weights.groupBy("site_id", "parameter").agg(F.max("weight").alias("weight"))
    per_site = single.groupBy("site_id").agg(
        F.map_from_entries(F.collect_list(F.struct("parameter", "weight"))).alias("weights")
    )

    def weight(c):
        found = F.coalesce(F.try_element_at("weights", F.lit(c.parameter)), F.lit(0))
        return F.when(_holds(c), found).otherwise(0)

    scored = [
        F.struct(
            reduce(lambda a, b: a + b, map(weight, own)).alias("score"),
            F.lit(-campaign).alias("minus_id"),
        )
        for campaign, own in _by_campaign(conditions).items()
    ]
    best = F.array_max(F.array(*scored))
    return (
        visits.join(per_site, "site_id", "left")
        .withColumn("__best", best)
        .withColumn("score", F.col("__best.score"))
        .withColumn("campaign_id", F.when(F.col("score") > 0, -F.col("__best.minus_id")))
        .drop("__best", "weights")
    )


def with_stage(deals: DataFrame, stages: DataFrame, keys: list[str]) -> DataFrame:
    return deals.join(stages, keys, "left")


def transfer(rows: DataFrame, cell: dict[str, object], id_column: str) -> DataFrame:
    """Distinct ids of the detail rows behind one report cell."""
    for name, value in cell.items():
        rows = rows.filter(F.col(name).eqNullSafe(F.lit(value)))
    return rows.select(id_column).distinct()


def group_members(members: DataFrame, groups_column: str, groups: DataFrame) -> DataFrame:
    """Many-to-many membership: one row per member and group."""
    bridge = members.withColumn("group_id", F.explode(F.array_distinct(groups_column)))
    return bridge.drop(groups_column).join(groups, "group_id")
