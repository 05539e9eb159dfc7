"""An index of transcripts by trigram postings, and phrase search that reads candidates only."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringlens.operators.flat import phrase_matches
from ringlens.session import settled

GRAM = 3
#: Grams of a search text that are looked up: its rarest ones.
LOOKED_UP = 4
#: Characters of the transcripts whose postings are listed together.
BLOCK = 2_000_000


@dataclass(frozen=True)
class TranscriptIndex:
    """``postings`` (gram, ids), ``counts`` (gram, n) and the ``texts``, each a folder
    partitioned by a bucket of its key, so a search opens the buckets of its grams and of the
    transcripts that it finds. A gram has a posting for each block of transcripts that holds
    it, so a list of ids is bounded by the block."""

    path: str
    id: str
    text: str
    buckets: int

    def folder(self, part: str) -> str:
        return f"{self.path}/{part}"

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")


def _codes(low: bytes) -> np.ndarray:
    """The distinct grams of a text, each as one number of its three characters."""
    signs = np.frombuffer(low.decode("utf-8", "replace").encode("utf-32-le"), dtype="<u4").astype(np.int64)
    return np.unique(signs[:-2] << 42 | signs[1:-1] << 21 | signs[2:])


def _spelled(codes: np.ndarray) -> list[str]:
    signs = np.stack([codes >> 42, codes >> 21 & 0x1FFFFF, codes & 0x1FFFFF], axis=1)
    text = signs.astype("<u4").tobytes().decode("utf-32-le")
    return [text[i : i + GRAM] for i in range(0, len(text), GRAM)]


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Rows of a batch and the codes of their texts, some ``BLOCK`` characters at a time."""
    rows, codes, size = [], [], 0
    for row, low in enumerate(batch.column("low")):
        text = low.as_py()
        rows.append(row)
        codes.append(_codes(text))
        size += len(text)
        if size >= BLOCK:
            yield rows, codes
            rows, codes, size = [], [], 0
    if rows:
        yield rows, codes


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, low) to (gram, ids), a row per gram of a block."""
    for batch in batches:
        for rows, codes in _blocks(batch):
            held = np.concatenate(codes)
            of = np.repeat(np.array(rows, dtype=np.int64), [len(c) for c in codes])
            order = np.argsort(held, kind="stable")
            every, first = np.unique(held[order], return_index=True)
            ends = pa.array(np.append(first, len(held)).astype(np.int32))
            ids = pa.ListArray.from_arrays(ends, batch.column("id").take(pa.array(of[order])))
            yield pa.RecordBatch.from_arrays([pa.array(_spelled(every), pa.string()), ids], ["gram", "ids"])


def build(rows: DataFrame, index: TranscriptIndex) -> None:
    """Write the index of a table of transcripts. NULL texts are not in it."""
    spark = rows.sparkSession

    def write(df: DataFrame, part: str, key: str) -> None:
        placed = df.withColumn("bucket", index.bucket(F.col(key))).hint("rebalance", "bucket")
        placed.sortWithinPartitions("bucket", key).write.mode("overwrite").partitionBy("bucket").parquet(index.folder(part))

    known = rows.select(F.col(index.id).alias("id"), F.col(index.text).alias("text")).filter("text IS NOT NULL")
    write(known, "texts", "id")
    kind = known.schema["id"].dataType.simpleString()
    stored = spark.read.schema(known.schema).parquet(index.folder("texts"))
    low = stored.select("id", F.lower("text").cast("binary").alias("low")).filter(F.length("low") >= GRAM)
    write(low.mapInArrow(_postings, f"gram string, ids array<{kind}>"), "postings", "gram")
    held = spark.read.parquet(index.folder("postings")).groupBy("gram")
    write(held.agg(F.sum(F.size("ids")).alias("n")), "counts", "gram")


def _read(spark: SparkSession, index: TranscriptIndex, part: str, keys: list, key: str) -> DataFrame:
    """The rows of the listed keys: a partition filter and a pushed filter on the key."""
    of = spark.createDataFrame([(k,) for k in keys], spark.read.parquet(index.folder(part)).select(key).schema)
    held = sorted({r[0] for r in of.select(index.bucket(F.col(key))).collect()})
    rows = spark.read.parquet(index.folder(part)).filter(F.col("bucket").isin(held))
    return rows.filter(F.col(key).isin(keys)).drop("bucket")


def candidates(spark: SparkSession, index: TranscriptIndex, texts: list[str]) -> DataFrame | None:
    """Ids of the transcripts that hold the rarest grams of a search text; None where a text
    is too short for a gram, so that any transcript may hold it."""
    wanted = {t.lower() for t in texts}
    if any(len(t) < GRAM for t in wanted):
        return None
    pieces = {t: sorted({t[i : i + GRAM] for i in range(len(t) - GRAM + 1)}) for t in wanted}
    every = sorted({g for own in pieces.values() for g in own})
    count = {r.gram: r.n for r in _read(spark, index, "counts", every, "gram").collect()}  # a number a gram of the texts
    looked_up = []
    for t, own in pieces.items():
        if all(g in count for g in own):
            looked_up += [(t, g) for g in sorted(own, key=lambda g: (count[g], g))[:LOOKED_UP]]
    asked = spark.createDataFrame(looked_up, "search string, gram string")
    need = asked.groupBy("search").agg(F.count("*").alias("need"))
    listed = _read(spark, index, "postings", [g for _, g in looked_up], "gram")
    postings = listed.select("gram", F.explode("ids").alias("id")).distinct()  # an id may come with several texts
    held = postings.join(asked, "gram").groupBy("search", "id").agg(F.count("*").alias("n"))
    return held.join(need, "search").filter("n = need").select("id").distinct()


def search(spark: SparkSession, index: TranscriptIndex, texts: list[str], separator: str) -> DataFrame:
    """Phrases that contain any search text, ignoring case: what ``phrase_matches`` finds in
    all transcripts, from the candidates' texts alone."""
    if not texts:
        raise ValueError("no search text given")
    stored = spark.read.parquet(index.folder("texts"))
    found = candidates(spark, index, texts)
    if found is not None:
        found = settled(found, "candidates")
        buckets = [r[0] for r in found.select(index.bucket(F.col("id"))).distinct().collect()]  # at most `buckets` numbers
        stored = stored.filter(F.col("bucket").isin(buckets)).join(found, "id", "left_semi")
    rows = stored.select(F.col("id").alias(index.id), F.col("text").alias(index.text))
    return phrase_matches(rows, index.text, texts, separator)
