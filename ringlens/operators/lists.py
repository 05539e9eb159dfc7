"""Dictionary lists, trees, filter values and number pools."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.operators import filters as flt
from ringlens.session import settled


def dim_list(
    table: DataFrame,
    key: str,
    fields: list[str] | None = None,
    where: flt.Cond | flt.Tree | None = None,
    sort: list[tuple[str, str]] | None = None,
    limit: int | None = None,
    offset: int = 0,
) -> DataFrame:
    """A dimension with the usual clauses; all rows unless a page is asked for."""
    rows = flt.where(table, where)
    if limit is not None:
        rows = flt.page(rows, sort or [], [key], limit, offset)
    elif sort:
        rows = flt.order(rows, sort)
    return flt.select_fields(rows, fields)


def tree(nodes: DataFrame, separator: str = " / ") -> DataFrame:
    """Path and depth of every node of an (id, parent_id, name) table.

    Every unfinished node knows a stretch of its path and the node above the stretch. A round
    joins each with that node's own stretch, which doubles both, so a tree of depth d takes
    about log2(d) rounds; ids are unique, so no join multiplies rows. Rounds end when no node
    is unfinished, or none was finished: what is left then runs in a circle, or into one, is
    on no tree, and has NULL for path and depth.
    """
    nodes = settled(nodes.select("id", "parent_id", "name"), "nodes")
    known = nodes.select(F.col("id").alias("__up"))
    start = nodes.join(known, F.col("parent_id") == F.col("__up"), "left").select(
        "id", F.col("name").alias("path"), F.lit(0).alias("depth"), F.col("__up").alias("__next")
    )
    done, left = [], start
    while True:
        left = settled(left, "tree")
        top, left = left.filter("__next IS NULL"), left.filter("__next IS NOT NULL")
        if left.isEmpty():
            return reduce(DataFrame.unionByName, [*done, top]).drop("__next")
        if done and top.isEmpty():
            lost = F.lit(None)
            circle = left.select("id", lost.cast("string").alias("path"), lost.cast("int").alias("depth"))
            return reduce(DataFrame.unionByName, done).drop("__next").unionByName(circle)
        done.append(top)
        above = reduce(DataFrame.unionByName, [*done, left])
        above = above.select(*[F.col(c).alias(f"__{c}") for c in ("id", "path", "depth")], F.col("__next").alias("__then"))
        left = left.join(above, F.col("__next") == F.col("__id")).select(
            "id",
            F.concat("__path", F.lit(separator), "path").alias("path"),
            (F.col("depth") + F.col("__depth") + 1).alias("depth"),
            F.col("__then").alias("__next"),
        )


def filter_values(df: DataFrame, field: str) -> DataFrame:
    """Distinct values a report field can be filtered by, with their counts."""
    return df.groupBy(F.col(field).alias("value")).agg(F.count("*").alias("n"))


def available(all_numbers: DataFrame, used: DataFrame, key: str) -> DataFrame:
    """Numbers not in use."""
    return all_numbers.join(used.select(key).distinct(), key, "left_anti")
