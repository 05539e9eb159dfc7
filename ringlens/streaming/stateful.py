"""Streaming jobs whose state is a stored table: open visitor sessions and ledgered ingest.

Each micro-batch n reads the state that batch n - 1 left and writes folders that carry its own
number, so a batch that is run again after a failure finds the same state and overwrites what
it wrote. Rows of one key are aggregated before they meet the state, and the state is as large
as what is open, not as what was seen.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringlens.operators.ingest import MAX_FAILURES
from ringlens.operators.ordered import Running, running
from ringlens.operators.windows import seconds_between
from ringlens.session import remove_dir


def run(stream: DataFrame, out: str, step) -> None:
    """Feed a stream to ``step(batch, number)`` until it is drained. ``number`` counts from 0
    and stays the same when a batch is repeated."""
    (
        stream.writeStream.option("checkpointLocation", f"{out}/progress")
        .trigger(availableNow=True)
        .foreachBatch(step)
        .start()
        .awaitTermination()
    )


# ---- open sessions -------------------------------------------------------------


def merged_sessions(parts: DataFrame, gap_seconds: int) -> DataFrame:
    """Sessions of a visitor that overlap or lie within the gap of each other become one."""
    order = ["start_time", "last_time", "visits"]
    reach = Running("__reach", "max", F.col("last_time"), inclusive=False)
    seen = running(parts, ["visitor_id"], order, reach)
    opens = F.col("__reach").isNull() | (seconds_between("__reach", "start_time") > gap_seconds)
    flagged = seen.withColumn("__opens", F.when(opens, 1).otherwise(0).cast("long"))
    numbered = running(flagged, ["visitor_id"], order, Running("__no", "sum", F.col("__opens")))
    return numbered.groupBy("visitor_id", "__no").agg(
        F.min("start_time").alias("start_time"), F.max("last_time").alias("last_time"), F.sum("visits").alias("visits")
    ).drop("__no")


def open_sessions(stream: DataFrame, out: str, gap_seconds: int, late_seconds: int = 0) -> None:
    """One row per open visitor session; a session ends when time has passed it by.

    ``stream`` has ``visitor_id`` and ``date_time``. Batch n writes ``out/open/batch=n``: the
    sessions that may still grow, ``visitor_id, start_time, last_time, visits``;
    ``out/ended/batch=n``: those whose last visit lies more than the gap and ``late_seconds``
    before the newest visit; and ``out/newest/batch=n``, that time in microseconds. Visits later than that are
    counted in ``out/late/batch=n`` and open nothing, as under a watermark. Of the folders of
    open sessions, the last two stay.
    """
    spark = stream.sparkSession
    kind = stream.schema["visitor_id"].dataType.simpleString()
    rows = f"visitor_id {kind}, start_time timestamp, last_time timestamp, visits bigint"

    def empty(schema: str) -> DataFrame:
        return spark.createDataFrame([], schema)

    def step(batch: DataFrame, number: int) -> None:
        before = f"batch={number - 1}"
        old = spark.read.schema(rows).parquet(f"{out}/open/{before}") if number else empty(rows)
        newest = spark.read.parquet(f"{out}/newest/{before}").first().newest if number else None
        visits = batch.select("visitor_id", F.col("date_time").cast("timestamp").alias("at")).filter("at IS NOT NULL")
        # a retried batch may find its own output: everything is overwritten
        in_time = F.lit(True) if newest is None else F.unix_micros("at") >= newest - late_seconds * 1_000_000
        visits.filter(~in_time).agg(F.count("*").alias("late")).write.mode("overwrite").parquet(f"{out}/late/batch={number}")
        fresh = (
            visits.filter(in_time)
            .groupBy("visitor_id", F.session_window("at", f"{gap_seconds} seconds"))
            .agg(F.min("at").alias("start_time"), F.max("at").alias("last_time"), F.count("*").alias("visits"))
            .drop("session_window")
        )
        parts = old.unionByName(fresh)
        parts.agg(F.max(F.unix_micros("last_time")).alias("newest")).select(
            F.greatest("newest", F.lit(newest).cast("long")).alias("newest")
        ).write.mode("overwrite").parquet(f"{out}/newest/batch={number}")
        limit = spark.read.parquet(f"{out}/newest/batch={number}").first().newest
        merged = merged_sessions(parts, gap_seconds)
        silent = F.floor((F.lit(limit).cast("long") - F.unix_micros("last_time")) / 1_000_000)
        merged = merged.withColumn("ended", F.coalesce(silent > gap_seconds + late_seconds, F.lit(False)))
        merged.write.mode("overwrite").partitionBy("ended").parquet(f"{out}/merged")
        both = spark.read.schema(f"{rows}, ended boolean").parquet(f"{out}/merged")
        both.filter("NOT ended").drop("ended").write.mode("overwrite").parquet(f"{out}/open/batch={number}")
        both.filter("ended").drop("ended").write.mode("overwrite").parquet(f"{out}/ended/batch={number}")
        if number > 1:
            remove_dir(spark, f"{out}/open/batch={number - 2}")

    run(stream, out, step)


def open_now(spark: SparkSession, out: str) -> DataFrame:
    """The sessions open at the newest visit: of the last batch, those not yet ended but kept
    for late visits included."""
    rows = spark.read.parquet(f"{out}/open")
    last = rows.agg(F.max("batch")).scalar()
    return rows.filter(F.col("batch") == last).drop("batch")


def ended(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/ended").drop("batch")


# ---- ledgered ingest -----------------------------------------------------------


def ledgered(stream: DataFrame, out: str, ok: Column, order: list[str]) -> None:
    """Take uploaded rows once: an id that was loaded, or has failed too often, is not tried.

    ``stream`` has ``ext_id``; ``ok`` tells whether an attempt succeeds and ``order`` the
    order of attempts within a batch. Batch n writes ``out/ledger/batch=n``, a row per attempt
    (``ext_id, ok``), and ``out/loaded/batch=n``, the rows that succeeded. Attempts are counted
    over the ledger of the earlier batches and the earlier rows of the batch; the ledger is
    summed up per id before the join. A batch that is run again reads the same ledger and
    overwrites its own folders, so it leaves the table as it was.
    """
    spark = stream.sparkSession
    kind = stream.schema["ext_id"].dataType.simpleString()

    def step(batch: DataFrame, number: int) -> None:
        earlier = (
            spark.read.schema(f"ext_id {kind}, ok boolean, batch int").parquet(f"{out}/ledger").filter(F.col("batch") < number)
            if number
            else spark.createDataFrame([], f"ext_id {kind}, ok boolean")
        )
        known = earlier.groupBy("ext_id").agg(F.bool_or("ok").alias("__loaded"), F.count_if(~F.col("ok")).alias("__failed"))
        open_ = F.coalesce(~F.col("__loaded") & (F.col("__failed") < MAX_FAILURES), F.lit(True))
        tried = batch.filter(F.col("ext_id").isNotNull()).withColumn("__ok", F.coalesce(ok, F.lit(False)))
        tried = tried.join(known, "ext_id", "left").filter(open_)
        counted = lambda c: F.when(c, 1).otherwise(0).cast("long")
        tried = running(
            tried, ["ext_id"], order,
            Running("__good", "sum", counted(F.col("__ok")), inclusive=False),
            Running("__bad", "sum", counted(~F.col("__ok")), inclusive=False),
        )
        tried = tried.filter((F.col("__good") == 0) & (F.col("__bad") + F.coalesce("__failed", F.lit(0)) < MAX_FAILURES))
        tried = tried.drop("__good", "__bad", "__loaded", "__failed")
        tried.write.mode("overwrite").parquet(f"{out}/tried")
        tried = spark.read.schema(tried.schema).parquet(f"{out}/tried")
        tried.filter("__ok").drop("__ok").write.mode("overwrite").parquet(f"{out}/loaded/batch={number}")
        tried.select("ext_id", F.col("__ok").alias("ok")).write.mode("overwrite").parquet(f"{out}/ledger/batch={number}")

    run(stream, out, step)


def loaded(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/loaded")


def ledger(spark: SparkSession, out: str) -> DataFrame:
    """Every attempt: ``ext_id, ok, batch``."""
    return spark.read.parquet(f"{out}/ledger")
