"""Streaming jobs: live visit counts, de-duplicated ingest and page extraction.

Every job runs with ``availableNow`` here, so it drains what is there and stops; the same
functions serve a long-running query with another trigger. Sinks are idempotent: a batch
overwrites the folder that carries its own number, so a retried batch leaves no copies.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringlens.operators import catalog as ct


def table_stream(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Stream one table below ``folder``: a parquet file, or a folder of part files.

    The source wants a folder, so the table is named by a pattern that only its path meets.
    """
    path = f"{folder}/{table}.parquet"
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{table}.[p]arquet")


def page_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Stream HTML files of a landing folder: (path, html)."""
    return (
        spark.readStream.option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.[hH][tT][mM][lL]")
        .text(folder)
        .select(F.input_file_name().alias("path"), F.col("value").alias("html"))
    )


def arrived(rows: DataFrame, inbox: str) -> DataFrame:
    """Put rows into an inbox, in as many files as they have tasks, and stream the inbox.

    A job that drains the stream each time, with its progress stored, takes what has arrived
    since as one batch, however many files it is.
    """
    rows.write.mode("append").parquet(inbox)
    return rows.sparkSession.readStream.schema(rows.schema).parquet(inbox)


def drain(stream: DataFrame, out: str, mode: str = "append") -> None:
    """Run a stream to completion into ``out/batch=<n>`` folders.

    With mode 'update' a folder holds the rows changed by its batch. An empty folder -1
    keeps the schema, so a stream without input can be read back too.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], stream.schema).write.mode("ignore").parquet(f"{out}/batch=-1")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{out}-state")
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()


def drained(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out)


def latest_update(rows: DataFrame, keys: list[str]) -> DataFrame:
    """State after an 'update' stream: per key the row of the last batch."""
    return ct.last_wins(rows, keys, ["batch"]).drop("batch")


def visits_live(
    stream: DataFrame, ts: str = "ts", span: str = "30 minutes", step: str = "5 minutes"
) -> DataFrame:
    """Visits per sliding window. State is bounded by the watermark of one span."""
    events = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, span)
    window = F.window(ts, span, step)
    return events.groupBy(window).agg(F.count("*").alias("visits")).select(
        F.col("window.start").cast("timestamp_ntz").alias("from"),
        F.col("window.end").cast("timestamp_ntz").alias("till"),
        "visits",
    )


def visits_last(events: DataFrame, ts: str, span: str = "30 minutes") -> DataFrame:
    """Batch form: the visits of the last ``span`` before the newest event."""
    newest = events.agg(F.max(ts)).scalar()
    return events.filter(F.col(ts) > newest - F.expr(f"INTERVAL {span}"))


def ingest_stream(stream: DataFrame, ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """Rows with a new ``ext_id``. State is bounded by ``late``; older repeats are removed
    by the batch rule of ``ingest.ingest_sessions`` against the stored table."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return timed.dropDuplicatesWithinWatermark(["ext_id"])


def pages_results(stream: DataFrame) -> DataFrame:
    """Extraction and result rows of arriving pages: the batch columns, row by row."""
    return ct.batch_results(ct.extract(stream.withColumn("size", F.length("html"))), "size")
