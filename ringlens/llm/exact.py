"""Exact duplicates: a tree merge of sorted digest runs."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.llm.common import WHITE, whole
from ringlens.session import settled

#: Runs at the leaves of the tree, and runs that one merge takes; both powers of two.
RUNS, FAN_IN_BITS = 512, 3


def digests(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One narrow row per document: tag, run, id, code points, and what identifies its text.

    ``sha`` is the SHA-256 of the text without white space; ``check`` (another hash) and
    ``length`` are compared with it in every merge, so a digest alone never joins two texts.
    """
    original = whole(text)
    bare = F.translate(original, WHITE, "")
    tag = F.monotonically_increasing_id()
    return docs.select(
        tag.alias("tag"),
        (F.shiftright(tag, 33) % RUNS).cast("int").alias("run"),
        F.col(id).alias("id"),
        F.char_length(original).alias("chars"),
        F.unhex(F.sha2(bare, 256)).alias("sha"),
        F.xxhash64(bare).alias("check"),
        F.octet_length(bare).alias("length"),
    )


def exact_groups(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The group of every row: ``tag, id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they agree without white space. Of equal texts the row with the
    most code points stays, then the one with the smallest id.

    Upwards, each round merges eight neighbouring runs, sorted by digest, into one and keeps
    the best row and the row count per text; the map side of a round merges what one task
    holds, so a text that fills a third of the table is one row per run. Downwards, the
    winners go back the same way, so the last join meets a hot text once per run, not once.

    Each level is stored, so it is merged once. Ids may be of any type that has an order.

    Null texts count as empty (one group). Null ids come after all others and may be kept.
    Rows that repeat in full form a group of which one row is kept. An empty table gives an
    empty result. Other columns are not read.
    """
    leaves = settled(digests(docs, text, id), "digests")
    identity = ["sha", "check", "length"]
    level = leaves.select(
        F.struct((-F.col("chars")).alias("chars"), F.col("id").isNull().alias("none"), "id", "tag").alias("best"),
        F.lit(1).cast("long").alias("n"),
        "run",
        *identity,
    )
    levels = []
    for _ in range((RUNS - 1).bit_length() // FAN_IN_BITS):
        level = (
            level.withColumn("run", F.shiftright("run", FAN_IN_BITS))
            .groupBy("run", *identity)
            .agg(F.min("best").alias("best"), F.sum("n").alias("n"))
        )
        level = settled(level, "digest-runs")
        levels.append(level)
    verdict = levels.pop().filter("n > 1")
    while levels:
        below = levels.pop().select("run", *identity)
        verdict = verdict.withColumnRenamed("run", "up").join(
            below.withColumn("up", F.shiftright("run", FAN_IN_BITS)), ["up", *identity]
        ).drop("up")
    rows = leaves.withColumn("up", F.shiftright("run", FAN_IN_BITS)).join(
        verdict.withColumnRenamed("run", "up"), ["up", *identity], "left"
    )
    alone = F.col("n").isNull()
    return rows.select(
        "tag",
        "id",
        F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("tag") == F.col("best.tag"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The rows that stay, with all their columns: one of each group of equal texts.

    Rows are told apart by a stored tag, so null and repeated ids are no matter. Ties, empty
    and null texts are settled as in ``exact_groups``.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = settled(docs.select(F.monotonically_increasing_id().alias("row"), row), "rows")
    own = F.col(f"doc.`{id}`")
    name = F.struct(own.isNull().alias("none"), own.alias("id"), "row").alias("name")
    groups = exact_groups(rows.select(F.col(f"doc.`{text}`").alias("text"), name), "text", "name")
    kept = groups.filter("kept").select(F.col("id.row").alias("row"))
    return rows.join(kept, "row", "left_semi").select("doc.*")
