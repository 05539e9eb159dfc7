"""Writers and readers of catalogs, batch reports and report exports."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from ringlens.functions.text import safe_name
from ringlens.operators import catalog as ct

EXPORT_FORMATS = ("csv", "json", "parquet", "orc")
#: What ``write_catalog`` stores as 'openapi'.
DOCUMENTS = StructType([StructField(c, StringType()) for c in ("file", "document", "api", "domain")])


def write_catalog(catalog: DataFrame, path: str, fmt: str = "json", brand: str = "Service") -> None:
    """Write the methods of a catalog, one folder per API and domain.

    'json' and 'parquet' keep the records, 'openapi' writes one document per line.
    """
    items = ct.keyed(ct.methods(catalog)).withColumn("file", safe_name("name"))
    if fmt == "openapi":
        documents = ct.openapi(catalog, brand)
        out = ct.keyed(documents).withColumn("file", safe_name("name"))
        out = out.select("api", "domain", "file", "document")
        # few files a folder: a folder's rows meet, and AQE splits a large folder again
        out.hint("rebalance", "api", "domain").write.partitionBy("api", "domain").mode("overwrite").json(path)
    elif fmt in ("json", "parquet"):
        items.hint("rebalance", "api", "domain").write.partitionBy("api", "domain").mode("overwrite").format(fmt).save(path)
    else:
        raise ValueError(f"unknown catalog format {fmt!r}")


def write_bundles(bundles: DataFrame, path: str) -> None:
    """Write ``catalog.bundle_output``: one folder per bundle and kind of entry, as JSON."""
    bundles.hint("rebalance", "bundle", "kind").write.partitionBy("bundle", "kind").mode("overwrite").json(path)


def read_catalog(
    spark: SparkSession, path: str, fmt: str = "json", schema: StructType | None = None
) -> DataFrame:
    """Discover and read a written catalog. A known schema saves the JSON inference pass."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def write_batch_report(report: DataFrame, path: str) -> None:
    """The report is one row, so a single output file is its natural size."""
    report.coalesce(1).write.mode("overwrite").json(path)


def export_report(report: DataFrame, path: str, fmt: str = "csv") -> None:
    if fmt not in EXPORT_FORMATS:
        raise ValueError(f"unknown export format {fmt!r}")
    writer = report.write.mode("overwrite").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)


def write_fact(
    df: DataFrame, table: str, key: str, buckets: int, path: str, partition: str | None = None
) -> None:
    """Store a fact bucketed by its join key, and partitioned for pruning if asked.

    Facts bucketed alike on one key join and aggregate on it without a shuffle.
    """
    writer = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path)
    (writer.partitionBy(partition) if partition else writer).saveAsTable(table)
