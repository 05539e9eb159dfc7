"""Sharding: a uniform shuffle with exact shard sizes from a hypergeometric matrix."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringlens.llm.common import let, uniform, whole
from ringlens.session import settled

#: Children of a node when the matrix is drawn level by level.
FAN_BITS = 4


def hypergeometric(n: Column, good: Column, total: Column, *seed: Column) -> Column:
    """How many of ``n`` draws without replacement from ``total`` fall on ``good``.

    One walk outwards from the mode, with the ratio of neighbouring probabilities as weight;
    each value replaces the pick so far with probability weight / sum of weights so far.
    Values more than ten deviations out have less probability than a double resolves.
    """
    as_double = [c.cast("double") for c in (n, good, total)]

    def drawn(a: Column) -> Column:
        n, m, size = a["n"], a["m"], a["size"]
        low, high = F.greatest(F.lit(0.0), n + m - size), F.least(n, m)
        mode = F.greatest(low, F.least(high, F.floor((n + 1) * (m + 1) / (size + 2)).cast("double")))
        share = m / F.greatest(size, F.lit(1.0))
        spread = F.sqrt(n * share * (1 - share) * (size - n) / F.greatest(size - 1, F.lit(1.0)))
        steps = F.least(high - low, F.ceil(spread * 10).cast("double") + 10).cast("int")
        start = F.struct(
            mode.alias("up"), mode.alias("down"), F.lit(1.0).alias("w_up"),
            F.lit(1.0).alias("w_down"), F.lit(1.0).alias("sum"), mode.alias("pick"),
        )

        def step(s: Column, i: Column) -> Column:
            up, down = s["up"], s["down"]
            w_up = F.when(
                up < high,
                s["w_up"] * (m - up) * (n - up) / ((up + 1) * (size - m - n + up + 1)),
            ).otherwise(0.0)
            w_down = F.when(
                down > low,
                s["w_down"] * down * (size - m - n + down) / ((m - down + 1) * (n - down + 1)),
            ).otherwise(0.0)

            def choose(w: Column) -> Column:
                total_up = s["sum"] + w["up"]
                total = total_up + w["down"]
                pick = (
                    F.when(uniform(*seed, i, F.lit(2)) * total < w["down"], down - 1)
                    .when(uniform(*seed, i, F.lit(1)) * total_up < w["up"], up + 1)
                    .otherwise(s["pick"])
                )
                return F.struct(
                    (up + 1).alias("up"), (down - 1).alias("down"), w["up"].alias("w_up"),
                    w["down"].alias("w_down"), total.alias("sum"), pick.alias("pick"),
                )

            return let(F.struct(w_up.alias("up"), w_down.alias("down")), choose)

        walk = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(walk, start, step, lambda s: s["pick"].cast("long"))

    names = ("n", "m", "size")
    return let(F.struct(*(c.alias(k) for c, k in zip(as_double, names))), drawn)


def _rows_of_matrix(counts: Column, sizes: Column, shards: int, *seed: Column) -> Column:
    """Shard counts for every child: a random matrix with these row and column sums."""

    def row(n: Column, left: Column, child: Column) -> Column:
        start = F.struct(
            n.alias("n"),
            F.aggregate(left, F.lit(0).cast("long"), lambda a, x: a + x).alias("rest"),
            F.array().cast("array<bigint>").alias("row"),
        )

        def cell(s: Column, k: Column) -> Column:
            good = F.get(left, k)
            x = hypergeometric(s["n"], good, s["rest"], *seed, child, k)
            return let(
                x,
                lambda x: F.struct(
                    (s["n"] - x).alias("n"), (s["rest"] - good).alias("rest"),
                    F.concat(s["row"], F.array(x)).alias("row"),
                ),
            )

        return F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), start, cell, lambda s: s["row"])

    start = F.struct(
        sizes.alias("left"), F.array().cast("array<array<bigint>>").alias("rows")
    )

    def child(s: Column, c: Column) -> Column:
        return let(
            row(c["n"], s["left"], c["child"]),
            lambda r: F.struct(
                F.zip_with(s["left"], r, lambda a, b: a - b).alias("left"),
                F.concat(s["rows"], F.array(r)).alias("rows"),
            ),
        )

    return F.aggregate(counts, start, child, lambda s: s["rows"])


def communication_matrix(counts: DataFrame, sizes: list[int], seed: int) -> DataFrame:
    """``part, row``: how many rows of each part go to each shard.

    ``counts`` has one row per part (``part`` from 0, ``n`` rows). The matrix is uniform
    among the outcomes of a random permutation: drawn for 16 groups of parts, then within
    each group, down to single parts, so levels below the first are drawn in parallel and a
    row of the work never holds more than 16 x shards numbers.
    """
    parts = (counts.agg(F.max("part")).first()[0] or 0) + 1
    depth = max(1, -(-(parts - 1).bit_length() // FAN_BITS))
    literal = F.array(*[F.lit(x).cast("long") for x in sizes])
    nodes = None
    for level in range(1, depth + 1):
        children = (
            counts.groupBy(F.shiftright("part", FAN_BITS * (depth - level)).alias("child"))
            .agg(F.sum("n").alias("n"))
            .groupBy(F.shiftright("child", FAN_BITS).alias("part"))
            .agg(F.sort_array(F.collect_list(F.struct("child", "n"))).alias("children"))
        )
        above = (
            children.withColumn("row", literal) if nodes is None else children.join(nodes, "part")
        )
        drawn = _rows_of_matrix(
            F.col("children"), F.col("row"), len(sizes),
            F.lit(seed).cast("long"), F.lit(level).cast("long"),
        )
        nodes = above.select(
            F.explode(F.arrays_zip(F.col("children.child").alias("part"), drawn.alias("row"))).alias("c")
        ).select(F.col("c.part").alias("part"), F.col("c.row").alias("row"))
    return nodes


def shard_rows(
    docs: DataFrame, shards: int = 16, seed: int = 10, text: str = "text", id: str = "doc_id",
    payload: bool = False,
) -> DataFrame:
    """Every row with its shard and its place there: a uniform random order of all rows.

    Returns ``id, size, text_crc32, shard, slot`` (and ``tag``, the row's number), or with
    ``payload`` all columns of ``docs`` in a struct ``doc`` besides. Shard sizes are exact:
    rows / shards, at most one apart. ``slot`` counts from 0 without gaps in each shard.

    The rows are settled once, so that a retried task finds the same parts. A part is an
    input partition. Its rows are put in random order and dealt by its row of the
    communication matrix; each shard orders what it got again. That last order is taken in
    random buckets whose offsets are summed beside it, so no task holds a whole shard.

    Null texts count as empty (size 1). Null and repeated ids, and rows that repeat in full,
    are rows of their own. An empty table gives an empty result. With ``payload``, columns of
    any name are carried untouched.
    """
    tag = F.monotonically_increasing_id()
    base = settled(
        docs.select(
            tag.alias("tag"),
            F.col(id).alias("id"),
            (F.octet_length(whole(text)).cast("long") + 1).alias("size"),
            F.crc32(F.encode(whole(text), "UTF-8")).alias("text_crc32"),
            *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if payload else []),
        ),
        "shard-input",
    )
    thin = base.select("tag", F.shiftright("tag", 33).cast("int").alias("part"))
    counts = settled(thin.groupBy("part").agg(F.count("*").alias("n")), "shard-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    sizes = [total // shards + (k < total % shards) for k in range(shards)]
    matrix = settled(communication_matrix(counts, sizes, seed), "shard-matrix").select(
        "part",
        F.transform(
            F.sequence(F.lit(1), F.lit(shards)),
            lambda k: F.aggregate(F.slice("row", 1, k), F.lit(0).cast("long"), lambda a, x: a + x),
        ).alias("ends"),
    )

    def order(k: int) -> Column:
        return F.xxhash64(F.lit(seed + k).cast("long"), "tag")

    local = Window.partitionBy("part").orderBy(order(1), "tag")
    dealt = (
        thin.withColumn("place", F.row_number().over(local) - 1)
        .join(matrix, "part")
        .select("tag", F.size(F.filter("ends", lambda e: e <= F.col("place"))).alias("shard"))
    )
    # as many buckets a shard as input parts: a bucket then shrinks with the shard count
    parts = (counts.agg(F.max("part")).first()[0] or 0) + 1
    dealt = settled(dealt.withColumn("bucket", F.pmod(order(2), F.lit(parts)).cast("int")), "shard-dealt")
    offsets = (
        dealt.groupBy("shard", "bucket")
        .agg(F.count("*").alias("n"))
        .withColumn(
            "offset", F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")
        )
        .drop("n")
    )
    within = Window.partitionBy("shard", "bucket").orderBy(order(3), "tag")
    placed = (
        dealt.withColumn("place", F.row_number().over(within) - 1)
        .join(offsets, ["shard", "bucket"])
        .select("tag", "shard", (F.col("offset") + F.col("place")).cast("long").alias("slot"))
    )
    return base.join(placed, "tag")


def sharded_documents(docs: DataFrame, **settings) -> DataFrame:
    """All columns of ``docs`` with ``size, text_crc32, law, shard, slot, grown_shard``.

    A column of ``docs`` that has one of these names gives way to it.
    """
    rows = shard_rows(docs, payload=True, **settings)
    own = {
        "size": F.col("size"), "text_crc32": F.col("text_crc32"), "law": F.lit("rows"),
        "shard": F.col("shard"), "slot": F.col("slot"), "grown_shard": F.lit(None).cast("int"),
    }
    came = [F.col(f"doc.`{c}`") for c in docs.columns if c.lower() not in own]
    return rows.select(*came, *[c.alias(name) for name, c in own.items()])
