"""Mixing sources to target weights with a low-discrepancy schedule."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringlens.llm.common import WORD, whole
from ringlens.session import settled

#: Multiplier of the golden-ratio sequence in 32-bit fractions: floor(2**32 / golden ratio).
GOLDEN = 2654435769
ONE = 1 << 32
#: Slots of the schedule: so many (or one a word, if that is less), and one more for each 2**20
#: words of the mix.
SLOTS, WORDS_A_SLOT = 1 << 16, 1 << 20
#: Random buckets in which a source's documents are put in order, and slots ranked at a time.
ORDER_BUCKETS, RANK_CHUNK = 4096, 4096
#: Most times that a word is taken.
EPOCHS = 2


@dataclass(frozen=True)
class Mix:
    """``input``: tag, id, source, size and, where asked for, all columns in ``doc``.
    ``documents``: the same but doc, with sid. ``sources``: sid, source, source_size, weight,
    target, quota, slots, end (the words its slots take). ``pieces``: the mix itself, a row
    per run of words taken from one document into one slot."""

    input: DataFrame
    documents: DataFrame
    sources: DataFrame
    pieces: DataFrame


def source_targets(sources: DataFrame, weights: tuple[int, ...], percent: int) -> DataFrame:
    """``sid, source, source_size, weight, target`` from ``source, source_size``.

    Sources in order of code points (null last) take ``weights`` in turn and share
    ``percent`` of all sizes; none gets more than ``EPOCHS`` times its size, and what that
    leaves goes to the others by weight. Capped sources are those with the least room for
    their weight, so one pass in that order finds the level at which nobody else is capped.
    Works on one row per source.
    """
    everything = Window.partitionBy(F.lit(0))
    named = sources.withColumn(
        "sid", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_last("source")))
    ).withColumn(
        "weight", F.get(F.array(*[F.lit(w) for w in weights]), (F.col("sid") - 1) % len(weights)).cast("long")
    )
    by_room = everything.orderBy(F.col("source_size") / F.col("weight"), "sid")
    filled = (
        named.withColumn("rank", F.row_number().over(by_room))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("before", F.sum("source_size").over(by_room.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("source_size"))
        .withColumn("den", 100 * (F.sum("weight").over(everything) - F.sum("weight").over(by_room.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("weight")))
        .withColumn("num", percent * F.col("total") - 100 * EPOCHS * F.col("before"))
        .withColumn("capped", F.col("num").cast("double") * F.col("weight") >= F.col("den").cast("double") * EPOCHS * F.col("source_size"))
        .withColumn("level", F.min(F.when(~F.col("capped"), F.struct("rank", "num", "den"))).over(everything))
    )
    level = F.col("level")
    target = F.when(
        level.isNull() | (F.col("rank") < level["rank"]), (EPOCHS * F.col("source_size")).cast("double")
    ).otherwise((F.col("weight") * level["num"]).cast("double") / level["den"].cast("double"))
    return filled.select("sid", "source", "source_size", "weight", target.alias("target"))


def schedule(spark, sources: DataFrame, slots: int) -> DataFrame:
    """``sid, rank, slot``: the source of each slot, and the slot's rank within its source.

    Slot t's point is the t-th of the golden-ratio sequence; it falls on the source whose
    interval of cumulative quota holds it. Intervals and points meet on equal cells of the
    unit interval, each cell holding the few sources that touch it.
    """
    cells = 4096
    share = F.sum("quota").over(Window.partitionBy(F.lit(0)).orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.sum("quota").over(Window.partitionBy(F.lit(0)))
    bound = lambda c: F.floor(c / F.greatest(total, F.lit(1)).cast("double") * float(ONE)).cast("long")
    lines = (
        sources.select("sid", "quota", bound((share - F.col("quota")).cast("double")).alias("low"), bound(share.cast("double")).alias("high"))
        .filter("low < high")
        .withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / (ONE // cells)), F.floor((F.col("high") - 1) / (ONE // cells)))))
    )
    points = spark.range(slots).select(
        F.col("id").alias("slot"), ((F.col("id") * GOLDEN) % ONE).alias("point")
    ).withColumn("cell", F.floor(F.col("point") / (ONE // cells)))
    placed = points.join(lines, "cell").filter("low <= point AND point < high").select("slot", "sid")
    chunk = F.floor(F.col("slot") / RANK_CHUNK)
    ranked = placed.withColumn("chunk", chunk).withColumn(
        "place", F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1
    )
    before = (
        placed.groupBy("sid", chunk.alias("chunk")).agg(F.count("*").alias("n"))
        .withColumn("offset", F.sum("n").over(Window.partitionBy("sid").orderBy("chunk")) - F.col("n"))
    )
    return ranked.join(before, ["sid", "chunk"]).select(
        "sid", (F.col("offset") + F.col("place")).alias("rank"), "slot"
    )


def _div(a: Column, b: Column) -> Column:
    """Whole quotient of products that may outgrow a long."""
    return F.call_function("div", a, b)


def _wide(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def _block_start(rank: Column, words: int, slots: int) -> Column:
    """First word of a source's block of that rank; the blocks of all sources are equal, to a word."""
    return _div(_wide(rank) * _wide(F.lit(words)), _wide(F.lit(slots)))


def _block_of(word: Column, words: int, slots: int) -> Column:
    return _div(_wide(word + 1) * _wide(F.lit(slots)) - 1, _wide(F.lit(words)))


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), percent: int = 150, seed: int = 2,
    text: str = "text", id: str = "doc_id", source: str = "source", payload: bool = False,
) -> Mix:
    """A mix of all sources by target weight, ``percent`` of the input's words long.

    A document's size is its number of words. The mix is a row of slots of equally many
    words; a low-discrepancy schedule gives every slot to a source, so every stretch of slots
    has nearly the target proportions, and a source's share is the number of its slots. Each
    source's documents are put in a random order (by a digest of seed and id) and laid on a
    line, twice over for a second epoch; the slot of rank r takes the r-th block of the line.
    What a source gives differs from its target by a few blocks at most, and no word is taken
    more than twice: a block beyond that is left short.

    Prefix sums over a source are taken in random buckets with summed offsets, so a source
    with a third of all documents is never in one task; source tables are one row a source.

    Null texts and texts without words have size 0 and give nothing; a null source is a
    source of its own, the last one; a source without words has target 0. Null and repeated
    ids, and rows that repeat in full, are documents of their own. An empty table gives empty
    frames. A source too small for any point of the schedule gets one slot at its end, with
    the words of its target.
    """
    spark = docs.sparkSession
    words = F.regexp_count(whole(text), F.lit(WORD)).cast("long")
    raw = settled(
        docs.select(
            F.monotonically_increasing_id().alias("tag"), F.col(id).alias("id"),
            F.col(source).alias("source"), words.alias("size"),
            F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit("")))).alias("order"),
            *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if payload else []),
        ),
        "mix-input",
    )
    per_source = raw.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(per_source, weights, percent).withColumn(
        "quota", F.floor(F.col("target") + 0.5).cast("long")
    )
    targets = settled(targets, "mix-targets")
    total = targets.agg(F.sum("quota")).first()[0] or 0
    slots = max(1, min(SLOTS, total) + total // WORDS_A_SLOT)
    total = max(total, 1)
    planned = settled(schedule(spark, targets, slots), "mix-schedule")
    counts = planned.groupBy("sid").agg(F.count("*").alias("slots"))
    most = EPOCHS * F.col("source_size")
    sources = settled(
        targets.join(counts, "sid", "left").withColumn("scheduled", F.col("slots").isNotNull())
        .withColumn("slots", F.coalesce("slots", F.lit(1)).cast("long"))
        .withColumn("end", F.when(
            F.col("scheduled"), F.least(_block_start(F.col("slots"), total, slots), most)
        ).otherwise(F.col("quota"))),
        "mix-sources",
    )
    closing = sources.filter("NOT scheduled AND quota > 0").select(
        "sid", F.lit(0).cast("long").alias("rank"), (F.col("sid") + slots).cast("long").alias("slot")
    )
    planned = planned.unionByName(closing)

    documents = raw.select("tag", "id", "source", "size", "order").join(
        sources.select("sid", F.col("source").alias("of")), F.col("source").eqNullSafe(F.col("of"))
    ).drop("of")
    bucket = F.conv(F.substring("order", 1, 3), 16, 10).cast("int") % ORDER_BUCKETS
    line = documents.withColumn("bucket", bucket)
    within = Window.partitionBy("sid", "bucket").orderBy("order", "tag").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    before = (
        line.groupBy("sid", "bucket").agg(F.sum("size").alias("n"))
        .withColumn("offset", F.sum("n").over(Window.partitionBy("sid").orderBy("bucket")) - F.col("n"))
        .drop("n")
    )
    # a source without a scheduled slot has one block, as long as its target
    rank_of = lambda word: F.when(F.col("scheduled"), _block_of(word, total, slots)).otherwise(0)
    laid = (
        line.withColumn("place", F.sum("size").over(within) - F.col("size"))
        .join(before, ["sid", "bucket"])
        .join(sources.select("sid", "source_size", F.col("end").alias("line_end"), "scheduled"), "sid")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(EPOCHS - 1))))
        .withColumn("first", F.col("offset") + F.col("place") + F.col("epoch") * F.col("source_size"))
        .withColumn("end", F.least(F.col("first") + F.col("size"), F.col("line_end")))
        .filter("first < end")
        .withColumn("rank", F.explode(F.sequence(rank_of(F.col("first")), rank_of(F.col("end") - 1))))
    )
    rank = F.col("rank")
    start = F.when(F.col("scheduled"), F.greatest(F.col("first"), _block_start(rank, total, slots))).otherwise(F.col("first"))
    stop = F.when(F.col("scheduled"), F.least(F.col("end"), _block_start(rank + 1, total, slots))).otherwise(F.col("end"))
    pieces = laid.select(
        "sid", "rank", "tag", "id", "epoch", (start - F.col("first")).alias("first_word"),
        (stop - start).alias("n_words"), start.alias("position"),
    ).join(planned, ["sid", "rank"])
    return Mix(raw, documents, sources, pieces)


def taken_words(mix: Mix) -> DataFrame:
    """``id, size, source_size, target, taken, first_slot, n_slots`` (and ``tag``) of every
    document; ``first_slot`` is NULL where nothing is taken."""
    taken = mix.pieces.groupBy("tag").agg(
        F.sum("n_words").alias("taken"), F.min("slot").alias("first_slot"), F.count("*").alias("n_slots")
    )
    return (
        mix.documents.join(mix.sources.select("sid", "source_size", "target"), "sid")
        .join(taken, "tag", "left")
        .withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("taken", "n_slots")})
    )


def mixed_documents(
    docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars", stretch: int = 1 << 10, **settings
) -> DataFrame:
    """The mix as documents, with the columns that came: a row for each time that words of
    a document are taken, in the order of the slots.

    Rows lie together by stretches of ``stretch`` slots and, within a stretch, in the order of
    slot and place, so a reader that takes the stretches as they come reads the mix. A
    document whose words are taken in part (at most one a source, where its slots end) has
    the words taken, joined by blanks, and its length in ``n_chars`` if that exists. One none
    of whose words are taken is not in the mix. Null, empty, tied and repeated rows are as in
    ``mix_sources``; columns of any name are carried along.
    """
    mix = mix_sources(docs, text=text, payload=True, **settings)
    times = mix.pieces.groupBy("tag", "epoch").agg(
        F.sum("n_words").alias("own"), F.min("slot").alias("slot"), F.min("position").alias("position")
    )
    rows = mix.input.select("tag", "size", "doc").join(times, "tag")
    cut = F.col("own") < F.col("size")
    full = F.col(f"doc.`{text}`")
    part = F.array_join(F.slice(F.regexp_extract_all(full, F.lit(f"({WORD})")), F.lit(1), F.col("own").cast("int")), " ")
    rows = rows.withColumn("cut", cut).withColumn("part", F.when(cut, part))

    def column(name: str) -> Column:
        came = F.col(f"doc.`{name}`")
        if name == text:
            came = F.when(F.col("cut"), F.col("part")).otherwise(came)
        elif name == n_chars:
            came = F.when(F.col("cut"), F.char_length("part").cast(docs.schema[name].dataType)).otherwise(came)
        return came.alias(name)

    rows = rows.select(F.struct(*[column(c) for c in docs.columns]).alias("doc"), "slot", "position")
    together = rows.repartition(F.floor(F.col("slot") / stretch)).sortWithinPartitions("slot", "position")
    return together.select("doc.*")
