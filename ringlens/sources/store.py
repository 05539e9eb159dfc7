"""Stored tables that take upserts and deletions, one partition at a time.

A target is a Parquet folder partitioned by one column, computed from the rows: a bucket of
the key, or a month. A change reads and overwrites the partitions that its rows fall into and
no others. What replaces a partition depends only on what it held and on the change, and
later versions win, so a change that failed half way is repeated, not repaired.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringlens.operators.catalog import last_wins
from ringlens.operators.flat import daily_lines, daily_states
from ringlens.operators.ingest import spread_costs
from ringlens.session import remove_dir, settled


@dataclass(frozen=True)
class Target:
    """``part`` names the partition column, ``of`` computes it from a row's columns."""

    path: str
    part: str
    of: Callable[[], Column]


def by_bucket(path: str, keys: list[str], buckets: int) -> Target:
    """Partitioned by a hash of the key, for keys without an order that changes follow."""
    return Target(path, "bucket", lambda: F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def by_month(path: str, day: str) -> Target:
    return Target(path, "month", lambda: F.date_format(day, "yyyyMM").cast("int"))


def create(rows: DataFrame, target: Target) -> None:
    """Write the table anew, the rows of a partition together; AQE splits a large one."""
    _write(rows.withColumn(target.part, target.of()), target, "static")


def stored(spark: SparkSession, target: Target) -> DataFrame:
    return spark.read.parquet(target.path)


def _write(rows: DataFrame, target: Target, mode: str) -> None:
    (
        rows.hint("rebalance", target.part)
        .write.partitionBy(target.part).mode("overwrite").option("partitionOverwriteMode", mode).parquet(target.path)
    )


def _parts(rows: DataFrame, target: Target) -> list[int]:
    """The partitions that the rows fall into: at most as many numbers as the table has."""
    return sorted(r[0] for r in rows.select(target.of().alias("part")).distinct().collect())


def _held(spark: SparkSession, target: Target, parts: list[int]) -> DataFrame:
    """What these partitions hold now; the others are pruned at planning."""
    return stored(spark, target).filter(F.col(target.part).isin(parts)).drop(target.part)


def _replace(rows: DataFrame, target: Target, parts: list[int]) -> None:
    """Put ``rows`` in the place of all that ``parts`` hold."""
    spark = rows.sparkSession
    rows = settled(rows.withColumn(target.part, target.of()), "replacement")
    left = {r[0] for r in rows.select(target.part).distinct().collect()}
    _write(rows, target, "dynamic")
    for part in set(parts) - left:  # a partition without rows is not written, so it is removed
        remove_dir(spark, f"{target.path}/{target.part}={part}")


def upsert(updates: DataFrame, target: Target, keys: list[str], order: list[str]) -> list[int]:
    """Store the updates by ``keys``: of all versions the last in ``order`` wins, an update
    before the stored row on a tie. Returns the partitions that were written.

    The order must tell versions apart or the content of equal ones be equal; then a repeated
    upsert changes nothing. A key's partition must not change between versions.
    """
    spark = updates.sparkSession
    updates = settled(updates, "updates")
    parts = _parts(updates, target)
    if not parts:
        return parts
    both = _held(spark, target, parts).withColumn("__new", F.lit(0)).unionByName(updates.withColumn("__new", F.lit(1)))
    _replace(last_wins(both, keys, [*order, "__new"]).drop("__new"), target, parts)
    return parts


def delete(ids: DataFrame, target: Target, keys: list[str]) -> list[int]:
    """Delete the rows whose ``keys`` are listed. Returns the partitions that were written."""
    spark = ids.sparkSession
    ids = settled(ids.select(*keys).distinct(), "ids")
    parts = _parts(ids, target)
    if parts:
        _replace(_held(spark, target, parts).join(ids, keys, "left_anti"), target, parts)
    return parts


def upsert_costs(uploads: DataFrame, target: Target, order: list[str]) -> list[int]:
    """Spread uploaded range costs to days and store them: later uploads replace days, zero
    costs delete them. Only the months of the ranges are written."""
    spark = uploads.sparkSession
    days = spread_costs(uploads).select("campaign_id", "day", "daily_cost", *order)
    latest = settled(last_wins(days, ["campaign_id", "day"], order).drop(*order), "updates")
    parts = _parts(latest, target)
    if not parts:
        return parts
    kept = _held(spark, target, parts).join(latest, ["campaign_id", "day"], "left_anti")
    _replace(kept.unionByName(latest.filter("daily_cost <> 0")), target, parts)
    return parts


def add_daily(facts: dict[str, DataFrame], target: Target, increment: int, key: str = "campaign_id") -> list[int]:
    """Add an increment of facts to daily statistics stored by month.

    An increment holds new rows of any days, corrections as rows with the difference. Its
    states are stored under its number, so adding it again replaces it, and only the months
    that it touches are written.
    """
    states = daily_states(facts, key).withColumn("increment", F.lit(increment))
    return upsert(states, target, [key, "day", "fact", "increment"], ["increment"])


def daily(spark: SparkSession, target: Target, facts: list[str], key: str = "campaign_id") -> DataFrame:
    """The stored daily statistics, all increments together."""
    return daily_lines(stored(spark, target), facts, key)
