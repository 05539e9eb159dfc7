"""Benchmark decontamination by winnowing: fingerprints find, exact windows decide."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlens.llm.common import let, row_key, whole
from ringlens.session import settled

WINDOW = 13
#: A packed fingerprint: the upper 40 bits of a k-gram's hash over 24 bits of its place.
PLACE_BITS = 24
PLACES = 1 << PLACE_BITS
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> Column:
    """Words of a text with A-Z lower-cased: runs of digits, letters and non-ASCII."""
    raw = whole(text)
    plain = F.octet_length(raw) == F.char_length(raw)
    lowered = F.when(plain, F.lower(raw)).otherwise(F.translate(raw, ascii_uppercase, ascii_lowercase))
    return F.array_remove(F.split(lowered, NOT_WORD), "")


def _spread(values: Column, span: int, op: Callable[[Column, Column], Column], then: Callable[[Column], Column]) -> Column:
    """``then`` of ``op`` folded over every ``span`` neighbours, by doubling."""

    def widen(v: Column, width: int) -> Column:
        if width == span:
            return then(v)
        shift = min(width, span - width)
        n = F.greatest(F.size(v) - shift, F.lit(0))
        return let(
            F.zip_with(F.slice(v, 1, n), F.slice(v, shift + 1, n), op),
            lambda wider: widen(wider, width + shift),
        )

    return let(values, lambda v: widen(v, 1))


def shape(guarantee: int) -> tuple[int, int]:
    """Words of a k-gram and k-grams of a window, so that any shared run of ``guarantee``
    words holds a whole window."""
    k = max(1, guarantee // 2)
    return k, guarantee + 1 - k


def winnow(words: Column, guarantee: int) -> Column:
    """The distinct smallest k-gram hashes of all windows, each packed with its place.

    Two texts that share ``guarantee`` words in a row share the window of k-grams within,
    hence its smallest hash. Texts with fewer words have none.
    """
    k, window = shape(guarantee)
    high = F.lit(-PLACES).cast("long")

    def pack(hashes: Column) -> Column:
        return F.transform(
            hashes,
            lambda h, i: F.xxhash64(h, F.lit(guarantee)).bitwiseAND(high).bitwiseOR(
                i.cast("long").bitwiseAND(F.lit(PLACES - 1).cast("long"))
            ),
        )

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return _spread(
        hashed, k, lambda a, b: F.xxhash64(a, b),
        lambda h: _spread(pack(h), window, lambda a, b: F.least(a, b), F.array_distinct),
    )


@dataclass(frozen=True)
class Hits:
    """``documents``: key, n_words, n_hit, combo (null without a hit). ``combos``: combo, items:
    the sorted ids of the items whose windows occur, once for each set of items."""

    documents: DataFrame
    combos: DataFrame


def contamination(docs: DataFrame, bench: DataFrame, **settings) -> DataFrame:
    """``key, n_words, n_hit, items`` of each document (see ``find_hits``); ``items`` are the
    sorted ids of the items whose windows occur, null where none does."""
    hits = find_hits(docs, bench, **settings)
    return hits.documents.join(hits.combos, "combo", "left").select("key", "n_words", "n_hit", "items")


def find_hits(
    docs: DataFrame, bench: DataFrame, window: int = WINDOW, text: str = "text", id: str = "doc_id",
    item_text: str = "text", item_id: str = "item_id",
) -> Hits:
    """What of each document lies in benchmark windows.

    A window is ``window`` words in a row of an item; a shorter item with words is one window.
    ``n_hit`` counts the document's words inside any occurrence of a window.

    1. Both sides keep the smallest k-gram hash of each sliding window; the join of these
       fingerprints gives places in documents. Every whole window is among them.
    2. Around these places only, the document's words are cut into windows and joined with
       the benchmark's windows by their text. A window stands for its set of items under one
       key, and sets are united once for each combination of them that documents have, so
       documents and items that share a passage are never paired.

    Which side of a join is broadcast is Spark's choice from the size of the settled tables;
    beyond the threshold they are shuffled, and AQE splits a passage that fills many rows.

    Null texts have no words. Documents with the same id and text share one result row's
    values (each row is returned); null ids are allowed, null item ids count as one item ''.
    A text of more than 2**24 words is handled (places repeat, all are tried). Empty tables
    give no hits. Other columns are not read.
    """
    spark = docs.sparkSession
    items = settled(
        bench.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words_of(item_text).alias("words"))
        .filter(F.size("words") > 0)
        .withColumn("t", F.least(F.size("words"), F.lit(window))),
        "bench-words",
    )
    lengths = sorted(r.t for r in items.select("t").distinct().collect())  # at most `window` numbers
    if lengths:
        marks = settled(
            reduce(
                DataFrame.unionByName,
                (
                    items.filter(F.col("t") == t).select("t", F.explode(winnow(F.col("words"), t)).alias("packed"))
                    for t in lengths
                ),
            )
            .select("t", F.shiftright("packed", PLACE_BITS).alias("mark"))
            .distinct(),
            "bench-marks",
        )
        packed = let(words_of(text), lambda w: F.concat(*[winnow(w, t) for t in lengths]))
        found = (
            docs.select(row_key(id, text), F.explode(packed).alias("packed"))
            .select("key", F.shiftright("packed", PLACE_BITS).alias("mark"), F.col("packed").bitwiseAND(PLACES - 1).alias("place"))
            .join(marks, "mark")
            .groupBy("key")
            .agg(F.collect_set(F.struct("t", "place")).alias("places"))
        )
    else:
        kind = docs.select(row_key(id, text)).schema["key"].dataType.simpleString()
        found = spark.createDataFrame([], f"key {kind}, places array<struct<t:int,place:bigint>>")
    found = settled(found, "places").withColumnRenamed("key", "at")

    def starts(n: Column) -> Column:
        """Where windows that hold a matched k-gram may begin."""

        def around(hit: Column) -> Column:
            k = F.greatest(F.lit(1), F.floor(hit["t"] / 2)).cast("int")
            reach = hit["t"] - k
            return F.flatten(
                F.transform(
                    F.sequence(hit["place"], F.greatest(hit["place"], n.cast("long") - k), F.lit(PLACES).cast("long")),
                    lambda p: F.transform(
                        F.sequence(F.greatest(p - reach, F.lit(0).cast("long")), F.least(p, n.cast("long") - hit["t"])),
                        lambda s: F.struct(s.cast("int").alias("s"), hit["t"].alias("t")),
                    ),
                )
            )

        return F.array_distinct(F.flatten(F.transform("places", around)))

    def cut(words: Column) -> Column:
        windows = F.when(
            F.col("places").isNotNull(),
            F.transform(
                starts(F.size(words)),
                lambda a: F.struct(a["s"].alias("s"), a["t"].alias("t"), F.array_join(F.slice(words, a["s"] + 1, a["t"]), " ").alias("window")),
            ),
        )
        return F.struct(F.size(words).cast("long").alias("n_words"), windows.alias("windows"))

    marked = settled(
        docs.select(row_key(id, text), F.col(text).alias("text"))
        .join(found, F.col("key") == F.col("at"), "left")
        .select("key", let(words_of("text"), cut).alias("c"))
        .select("key", "c.n_words", "c.windows"),
        "marked",
    )
    digest = lambda names: F.sha2(F.to_json(F.struct(names)), 256)
    own = (
        items.select(
            "item",
            F.explode(
                F.transform(
                    F.sequence(F.lit(0), F.size("words") - F.col("t")),
                    lambda s: F.array_join(F.slice("words", s + 1, F.col("t")), " "),
                )
            ).alias("window"),
        )
        .groupBy("window")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    own = settled(own.withColumn("of", digest(F.col("items"))), "bench-windows")
    hits = (
        marked.select("key", F.explode("windows").alias("w"))
        .select("key", "w.s", "w.t", "w.window")
        .join(own.select("window", "of"), "window")
        .groupBy("key")
        .agg(
            F.sort_array(F.collect_set(F.struct("s", "t"))).alias("spans"),
            F.sort_array(F.collect_set("of")).alias("sets"),
        )
    )
    begin = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def covered(a: Column, span: Column) -> Column:
        end = span["s"] + span["t"]
        return F.struct(
            F.greatest(a["end"], end).alias("end"),
            (a["n"] + F.greatest(F.lit(0), end - F.greatest(a["end"], span["s"]))).alias("n"),
        )

    hits = settled(
        hits.select(
            F.col("key").alias("at"), F.aggregate("spans", begin, covered, lambda a: a["n"].cast("long")).alias("n_hit"),
            "sets", digest(F.col("sets")).alias("combo"),
        ),
        "hits",
    )
    once = hits.groupBy("combo").agg(F.any_value("sets").alias("sets")).select("combo", F.explode("sets").alias("of"))
    sets = own.groupBy("of").agg(F.any_value("items").alias("items"))
    combos = (
        once.join(sets, "of").select("combo", F.explode("items").alias("item"))
        .groupBy("combo").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    documents = (
        marked.select("key", "n_words")
        .join(hits.select("at", "n_hit", "combo"), F.col("key") == F.col("at"), "left")
        .select("key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), "combo")
    )
    return Hits(documents, settled(combos, "combos"))


def is_contaminated() -> Column:
    """At least one word in twenty lies in benchmark windows."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def decontaminate(docs: DataFrame, bench: DataFrame, text: str = "text", id: str = "doc_id", **names) -> DataFrame:
    """The documents that are not contaminated, with all their columns as they came.

    Null and empty texts and texts without words stay, long ones are read whole, rows that
    agree in id and text go or stay together, ids may be null or repeat, columns of any name
    are carried along; an empty table gives an empty one, an empty benchmark drops nothing.
    """
    bad = find_hits(docs, bench, text=text, id=id, **names).documents.filter(is_contaminated())
    bad = settled(bad.select("key").distinct(), "contaminated")
    return docs.join(bad, row_key(id, text) == bad["key"], "left_anti")
