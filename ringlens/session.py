"""Session defaults and the shared work folder."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", app: str = "ringlens") -> SparkSession:
    """A local session for tests and the bench. A cluster brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def settled(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame that several branches read to the shared folder and read it back.

    The work behind it runs once, and a lost executor does not bring it back. Such tables may
    hold whole texts and stay until ``release``, so they are compressed with zstd.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Work folders that this process has named, for ``release``.
WORK: list[str] = []


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, or else below the warehouse folder.

    Both are readable by every executor, so a lost executor takes nothing with it. On a
    cluster a warehouse on a local disk is no such place and raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
        if root.startswith(("/", "file:")) and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    WORK.append(f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}")
    return WORK[-1]


def remove_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder from whatever file system its path names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> int:
    """Remove the work folders named so far by this process, once no frame read from them is
    needed any more. Returns how many."""
    paths, WORK[:] = WORK[:], []
    for path in paths:
        remove_dir(spark, path)
    return len(paths)
