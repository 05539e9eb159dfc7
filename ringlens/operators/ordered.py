"""Ordered computations per key that survive a key holding a large share of all rows.

A plain window sends every row of a key to one task. Here the rows of each key are counted
first, from the scan and with map-side combine. Where no key is heavy, which is the rule, the
rows are windowed as they come and nothing is written. The rows of heavy keys alone are put
in order by range partitions and settled; each partition is a piece of about ``HEAVY_ROWS``
rows, whatever the size of the table. Rows are windowed inside (key, piece), piece totals are
carried over a key's pieces, and the carry is joined back on (key, piece). A NULL key is a
key like any other.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringlens.session import settled

GROUP, PIECE = "__group", "__piece"
# A key with more rows is heavy, and a piece has about as many.
HEAVY_ROWS = 1_000_000


@dataclass(frozen=True)
class Running:
    """One derived column.

    ``kind``: 'sum' (running sum), 'max' (running maximum), 'last' (latest non-null before the
    row) or 'next' (earliest non-null after the row). ``inclusive`` counts the row itself.
    """

    name: str
    kind: str
    value: Column
    inclusive: bool = True


def number(name: str) -> Running:
    """Row number within the key."""
    return Running(name, "sum", F.lit(1).cast("long"))


def previous(name: str, value: Column) -> Running:
    return Running(name, "last", value, inclusive=False)


def following(name: str, value: Column) -> Running:
    return Running(name, "next", value, inclusive=False)


@dataclass(frozen=True)
class Line:
    """Rows with their key, their piece of it (NULL for an ordinary key) and order."""

    rows: DataFrame
    order: tuple[str, ...]
    heavy: bool

    @staticmethod
    def of(df: DataFrame, keys: list[str], order: list[str]) -> Line:
        """``order`` is total within a key; NULL comes first."""
        base = df.withColumn(GROUP, F.struct(*keys) if keys else F.struct(F.lit(0).alias("all")))
        counts = base.groupBy(GROUP).agg(F.count("*").alias("__rows"))
        heavy = settled(counts.filter(F.col("__rows") > HEAVY_ROWS), "heavy-keys")
        rows = heavy.agg(F.sum("__rows")).first()[0]
        if not rows:
            return Line(base.withColumn(PIECE, F.lit(None).cast("int")), tuple(order), False)
        if not keys:  # all rows are heavy; a join on a constant would be a pairing
            return Line(_pieces(base, order, rows), tuple(order), True)
        pieces = _pieces(base.join(heavy.select(GROUP), GROUP, "left_semi"), order, rows)
        ordinary = base.join(heavy.select(GROUP), GROUP, "left_anti")
        ordinary = ordinary.withColumn(PIECE, F.lit(None).cast("int"))
        return Line(ordinary.unionByName(pieces), tuple(order), True)

    def add(self, df: DataFrame, *specs: Running) -> DataFrame:
        """One column per spec on ``df``: ``rows``, or what came of them by adding columns."""
        return _added(df, list(self.order), self.heavy, specs)

    @staticmethod
    def bare(df: DataFrame) -> DataFrame:
        return df.drop(GROUP, PIECE)


def _pieces(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """The rows of the heavy keys in order, cut into pieces and settled with the piece.

    The cuts follow the whole order, so rows that tie in its first column don't stay together.
    """
    pieces = -(-n // HEAVY_ROWS)
    dealt = rows.repartitionByRange(pieces, GROUP, *order).withColumn(PIECE, F.spark_partition_id())
    return settled(dealt, "pieces")


def running(df: DataFrame, keys: list[str], order: list[str], *specs: Running) -> DataFrame:
    """Add one column per spec, computed over each key in ``order`` (a total order)."""
    line = Line.of(df, keys, order)
    return line.bare(line.add(line.rows, *specs))


def _added(df: DataFrame, order: list[str], heavy: bool, specs) -> DataFrame:
    group = [GROUP, PIECE]
    local = Window.partitionBy(*group).orderBy(*order)
    pieces = Window.partitionBy(GROUP).orderBy(PIECE)
    # Looking ahead is looking back in descending order: Spark grows a preceding frame row
    # by row but evaluates an unbounded following frame anew for every row.
    local_back = Window.partitionBy(*group).orderBy(*[F.col(o).desc() for o in order])
    pieces_back = Window.partitionBy(GROUP).orderBy(F.col(PIECE).desc())
    before = Window.unboundedPreceding
    rank = F.struct(*order)

    inside, totals, carries = {}, [], {}
    for s in specs:
        edge = 0 if s.inclusive else -1
        t = f"__t_{s.name}"
        if s.kind == "sum":
            inside[s.name] = F.sum(s.value).over(local.rowsBetween(before, edge))
            totals.append(F.sum(s.value).alias(t))
            carries[t] = F.sum(t).over(pieces.rowsBetween(before, -1))
        elif s.kind == "max":
            inside[s.name] = F.max(s.value).over(local.rowsBetween(before, edge))
            totals.append(F.max(s.value).alias(t))
            carries[t] = F.max(t).over(pieces.rowsBetween(before, -1))
        elif s.kind == "last":
            inside[s.name] = F.last(s.value, True).over(local.rowsBetween(before, edge))
            totals.append(F.max_by(s.value, F.when(s.value.isNotNull(), rank)).alias(t))
            carries[t] = F.last(t, True).over(pieces.rowsBetween(before, -1))
        elif s.kind == "next":
            inside[s.name] = F.last(s.value, True).over(local_back.rowsBetween(before, edge))
            totals.append(F.min_by(s.value, F.when(s.value.isNotNull(), rank)).alias(t))
            carries[t] = F.last(t, True).over(pieces_back.rowsBetween(before, -1))
        else:
            raise ValueError(f"unknown kind {s.kind!r}")

    zero = F.lit(0)
    if not heavy:
        sums = {s.name: F.coalesce(F.col(s.name), zero) for s in specs if s.kind == "sum"}
        return df.withColumns(inside).withColumns(sums) if sums else df.withColumns(inside)
    summary = (
        df.filter(F.col(PIECE).isNotNull())
        .groupBy(*group)
        .agg(*totals)
        .select(*group, *[c.alias(t) for t, c in carries.items()])
    )
    joined = df.withColumns(inside).join(summary, group, "left")
    final = {}
    for s in specs:
        t = F.col(f"__t_{s.name}")
        if s.kind == "sum":
            final[s.name] = F.coalesce(F.col(s.name), zero) + F.coalesce(t, zero)
        elif s.kind == "max":
            final[s.name] = F.greatest(F.col(s.name), t)
        else:
            final[s.name] = F.coalesce(F.col(s.name), t)
    return joined.withColumns(final).drop(*carries)


def exact_quantile(
    df: DataFrame, keys: list[str], value: str, name: str, positions, times: Column | None = None
) -> DataFrame:
    """Mean of the values at the 1-based ``positions(size)`` of each key's values in order.

    No key's values meet in one task: equal values are counted first, the counts are
    accumulated in value order, and the positions are read off. NULL values don't count;
    NULL keys form a group. ``times``: how often a row's value occurs, where it isn't once.
    """
    times = F.lit(1).cast("long") if times is None else times
    base = df.filter(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("__v"), times.alias("__times")
    )
    line = Line.of(base.groupBy(*keys, "__v").agg(F.sum("__times").alias("__n")), keys, ["__v"])
    size = line.rows.groupBy(GROUP).agg(F.sum("__n").alias("__size"))
    cum = line.add(line.rows, Running("__cum", "sum", F.col("__n"))).join(size, GROUP)
    wanted = positions(F.col("__size"))
    first = F.col("__cum") - F.col("__n")
    holds = lambda p: (first < p) & (p <= F.col("__cum"))
    hit = cum.filter(holds(wanted[0]) | holds(wanted[-1]))
    return hit.groupBy(*keys).agg(((F.min("__v") + F.max("__v")) / 2).alias(name))


def exact_median(
    df: DataFrame, keys: list[str], value: str, name: str, times: Column | None = None
) -> DataFrame:
    """Exact median per key: the middle value, or the mean of the two middle ones."""
    return exact_quantile(
        df, keys, value, name, lambda n: (F.floor((n + 1) / 2), F.floor(n / 2) + 1), times
    )


def exact_percentile(df: DataFrame, keys: list[str], value: str, name: str, share: float) -> DataFrame:
    """The smallest value that at least ``share`` of a key's values don't exceed."""
    return exact_quantile(df, keys, value, name, lambda n: (F.greatest(F.lit(1), F.ceil(n * F.lit(share).cast("decimal(9,6)")).cast("long")),))
