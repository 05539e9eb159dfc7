"""Bulk loads as set operations: accepted rows and rejected rows with a reason.

Duplicates are resolved by aggregates with map-side combine, so many copies of one key
shrink before the shuffle.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlens.operators.catalog import first_wins, last_wins

MAX_FAILURES = 3  # fixed value: failed attempts after which a call is not retried


def with_reason(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """``reason`` is the first failed check, NULL for an accepted row."""
    parts = [F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in checks.items()]
    return rows.withColumn("reason", F.coalesce(*parts))


def ingest_sessions(batch: DataFrame, existing: DataFrame, order: list[str]) -> DataFrame:
    """New sessions by ``ext_id``: the first copy of each id not loaded before."""
    fresh = batch.join(existing.select("ext_id").distinct(), "ext_id", "left_anti")
    return first_wins(fresh, ["ext_id"], order)


def upload_status(audit: DataFrame) -> DataFrame:
    """State of every uploaded id: loaded, given up (too many failures) or to be retried."""
    counts = audit.groupBy("ext_id").agg(
        F.count("*").alias("attempts"),
        F.count_if(~F.col("ok")).alias("failures"),
        F.bool_or("ok").alias("__loaded"),
    )
    state = (
        F.when(F.col("__loaded"), "loaded")
        .when(F.col("failures") >= MAX_FAILURES, "given up")
        .otherwise("retry")
    )
    return counts.withColumn("state", state).drop("__loaded")


def finished_ids(audit: DataFrame) -> DataFrame:
    """Ids that are not tried again: loaded once, or failed too often."""
    return upload_status(audit).filter(F.col("state") != "retry").select("ext_id")


def ingest_calls(batch: DataFrame, audit: DataFrame) -> DataFrame:
    """Calls still to be tried, each with its reject reason if its times are wrong."""
    open_rows = batch.join(finished_ids(audit), "ext_id", "left_anti")
    return with_reason(open_rows, {"finish before start": F.col("finish_time") >= F.col("start_time")})


def name_key(name: Column) -> Column:
    """Stable id text for a new dictionary entry; equal on every retry."""
    return F.md5(name)


def resolve_names(
    rows: DataFrame, name: str, dim: DataFrame, dim_id: str, dim_name: str, case_sensitive: bool
) -> tuple[DataFrame, DataFrame]:
    """Rows with the id of their named entry, and the entries to be created.

    A known name gets its id; an unknown one gets a stable key derived from the name.
    """
    def fold(c):
        return F.col(c) if case_sensitive else F.lower(c)

    known = dim.select(
        fold(dim_name).alias("__name"), F.col(dim_id).cast("string").alias("__id")
    )
    known = known.groupBy("__name").agg(F.min("__id").alias("__id"))
    joined = rows.withColumn("__name", fold(name)).join(known, "__name", "left")
    resolved = joined.withColumn(
        "resolved_id", F.coalesce("__id", name_key(F.col("__name")))
    ).drop("__id", "__name")
    created = (
        joined.filter(F.col("__id").isNull() & F.col("__name").isNotNull())
        .groupBy("__name")
        .agg(F.min(name).alias("name"))
        .select(name_key(F.col("__name")).alias("id"), "name")
    )
    return resolved, created


def ingest_chats(messages: DataFrame, employee: Column) -> DataFrame:
    """Initiator of each chat (side of its first message) and its last writing employee."""
    rank = F.struct("turn", "role")
    return messages.groupBy("chat_id").agg(
        F.min_by("role", rank).alias("initiator"),
        F.max_by(employee, F.when(F.col("role") == "assistant", rank)).alias("owner"),
    )


def ingest_offline(batch: DataFrame, now: Column) -> DataFrame:
    """Time checks of offline messages."""
    return with_reason(
        batch,
        {
            "no time": F.col("date_time").isNotNull(),
            "time in the future": F.col("date_time") <= now,
            "processed before sent": F.col("processed_at").isNull()
            | (F.col("processed_at") >= F.col("date_time")),
        },
    )


def ingest_emails(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Checked emails, and one row per recipient of the accepted ones."""
    fields = ("to", "cc", "bcc")
    filled = [F.coalesce(F.size(F.col(f)) > 0, F.lit(False)) for f in fields]
    checked = with_reason(batch, {"no recipient": reduce(lambda a, b: a | b, filled)})
    accepted = checked.filter(F.col("reason").isNull())

    def tagged(field):
        addresses = F.coalesce(F.col(field), F.array().cast("array<string>"))
        return F.transform(
            addresses, lambda a: F.struct(F.lit(field).alias("field"), a.alias("address"))
        )

    everyone = F.flatten(F.array(*[tagged(f) for f in fields]))
    recipients = accepted.select("ext_id", F.explode(everyone).alias("r")).select("ext_id", "r.*")
    return checked, recipients


def ingest_deals(batch: DataFrame, existing: DataFrame, now: Column) -> DataFrame:
    """Upsert by ``ext_id``: the latest version wins, the batch before the stored row on a tie.

    A missing modification time means now. A deal whose main contact is not among its
    contacts is dropped.
    """
    valid = batch.filter(F.array_contains("contacts", F.col("main_contact")))
    fresh = valid.withColumn("modified", F.coalesce("modified", now)).withColumn(
        "__source", F.lit(1)
    )
    stored = existing.withColumn("__source", F.lit(0))
    # the content hash makes the choice between equal versions repeatable
    both = stored.unionByName(fresh).withColumn("__hash", F.xxhash64(*sorted(batch.columns)))
    return last_wins(both, ["ext_id"], ["modified", "__source", "__hash"]).drop("__source", "__hash")


def spread_costs(costs: DataFrame) -> DataFrame:
    """Cost of a date range spread over its days in equal parts (a chosen rule).

    Time parts are ignored. ``cost = 0`` keeps its days as deletions.
    """
    start, end = F.to_date("date_from"), F.to_date("date_till")
    days = F.datediff(end, start) + 1
    return (
        costs.filter(end >= start)
        .withColumn("daily_cost", F.col("cost") / days)
        .withColumn("day", F.explode(F.sequence(start, end)))
    )


def ingest_costs(uploads: DataFrame, existing: DataFrame, order: list[str]) -> DataFrame:
    """Daily costs after an upload: later uploads replace days, zero costs delete them."""
    days = spread_costs(uploads).select("campaign_id", "day", "daily_cost", *order)
    latest = last_wins(days, ["campaign_id", "day"], order).drop(*order)
    kept = existing.join(latest.select("campaign_id", "day"), ["campaign_id", "day"], "left_anti")
    return kept.unionByName(latest.filter("daily_cost <> 0"))


def batch_cap(rows: DataFrame, batch: str, order: list[str], cap: int) -> DataFrame:
    """Flag the rows of an upload batch beyond its cap as rejected.

    The caps belong to the upload interface: a longer batch is reported, never cut silently.
    """
    from ringlens.operators.ordered import number, running

    placed = running(rows, [batch], order, number("place"))
    return placed.withColumn("rejected", F.col("place") > cap)


def apply_tags(tags: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """Tag links after setting some and unsetting others; no link appears twice."""
    keys = ["communication_id", "tag"]
    return tags.select(keys).union(added.select(keys)).distinct().join(removed, keys, "left_anti")


def apply_sales(comms: DataFrame, sales: DataFrame) -> DataFrame:
    """Sales with a reject reason when the communication is unknown or later than the sale."""
    joined = sales.join(comms, "communication_id", "left")
    return with_reason(
        joined,
        {
            "unknown communication": F.col("date_time").isNotNull(),
            "sale before communication": F.col("sale_date") >= F.col("date_time"),
        },
    )


def delete_by_ids(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return rows.join(ids.select(key).distinct(), key, "left_anti")
