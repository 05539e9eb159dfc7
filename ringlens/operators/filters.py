"""Filter trees compiled to one Column, so Catalyst can fold and push them down."""
from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringlens.session import settled


@dataclass(frozen=True)
class Cond:
    """One comparison. ``value=None`` asks for an empty field (NULL or '')."""

    field: str
    op: str = "="
    value: Any = None


@dataclass(frozen=True)
class Tree:
    """``connective`` is 'and', 'or' or 'not' (none of the parts holds)."""

    connective: str
    filters: tuple["Cond | Tree", ...]


OPERATORS = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(*v),
    "not_in": lambda c, v: ~c.isin(*v),
    "sub": lambda c, v: c.contains(v),
    "not_sub": lambda c, v: ~c.contains(v),
    "~": lambda c, v: c.rlike(v),
    "between": lambda c, v: c.between(v[0], v[1]),
}


def is_empty(c: Column) -> Column:
    return c.isNull() | (c.cast("string") == "")


def compile_filter(node: Cond | Tree) -> Column:
    if isinstance(node, Cond):
        c = F.col(node.field)
        if node.op == "is_null" or (node.op == "=" and node.value is None):
            return is_empty(c)
        if node.op == "!=" and node.value is None:
            return ~is_empty(c)
        if node.op not in OPERATORS:
            raise ValueError(f"unknown operator {node.op!r}")
        return OPERATORS[node.op](c, node.value)
    parts = [compile_filter(f) for f in node.filters]
    if not parts:
        return F.lit(True)
    if node.connective == "and":
        return reduce(lambda a, b: a & b, parts)
    if node.connective == "or":
        return reduce(lambda a, b: a | b, parts)
    if node.connective == "not":
        return ~reduce(lambda a, b: a | b, parts)
    raise ValueError(f"unknown connective {node.connective!r}")


def where(df: DataFrame, node: Cond | Tree | None) -> DataFrame:
    return df if node is None else df.filter(compile_filter(node))


class SavedFilters:
    """Filters stored under a name and reused by reports."""

    def __init__(self):
        self._trees: dict[str, Cond | Tree] = {}

    def save(self, name: str, node: Cond | Tree) -> None:
        self._trees[name] = node

    def get(self, name: str) -> Cond | Tree:
        if name not in self._trees:
            raise KeyError(f"no saved filter {name!r}")
        return self._trees[name]


def _moment(text: str) -> tuple[datetime, bool]:
    return datetime.fromisoformat(text), len(text) == 10


def date_range(
    df: DataFrame, column: str, date_from: str, date_till: str, max_days: int = 366
) -> DataFrame:
    """Keep rows of an inclusive range; a bare end date covers its whole day."""
    start, _ = _moment(date_from)
    end, bare = _moment(date_till)
    if bare:
        end = end + timedelta(days=1) - timedelta(microseconds=1)
    if end < start:
        raise ValueError("date_till lies before date_from")
    if end - start > timedelta(days=max_days):
        raise ValueError(f"the range exceeds {max_days} days")
    c = F.col(column)
    return df.filter(
        (c >= F.lit(start.isoformat(" ")).cast("timestamp_ntz"))
        & (c <= F.lit(end.isoformat(" ")).cast("timestamp_ntz"))
    )


def order(df: DataFrame, sort: list[tuple[str, str]]) -> DataFrame:
    return df.orderBy(*sort_columns(sort))


def placed(df: DataFrame, sort: list[tuple[str, str]], name: str = "place") -> DataFrame:
    """The sorted list with every row's place, counted from 1; ``sort`` must be total.

    Rows are sorted by range partitions and settled, numbered inside their partition, and
    moved by the rows of the partitions before: no task sees more than its share.
    """
    columns = sort_columns(sort)
    rows = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    rows = settled(rows.withColumn("__at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("__at", 33)
    sizes = rows.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    ahead = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("__part", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__ahead"))
    inside = F.col("__at").bitwiseAND((1 << 33) - 1)
    return (
        rows.withColumn("__part", part)
        .join(sizes, "__part")
        .withColumn(name, F.col("__ahead") + inside + 1)
        .drop("__part", "__ahead", "__at")
    )


def sort_columns(sort) -> list[Column]:
    """(field, 'asc'|'desc') pairs; empty values come last either way."""
    out = []
    for field, direction in sort:
        if direction not in ("asc", "desc"):
            raise ValueError(f"unknown order {direction!r}")
        c = F.col(field)
        out.append(c.asc_nulls_last() if direction == "asc" else c.desc_nulls_last())
    return out


#: A page that ends within so many rows is a top-k; one further down is found by place.
HEAP_ROWS = 100_000


def page(
    df: DataFrame,
    sort: list[tuple[str, str]],
    tie_break: list[str],
    limit: int = 50,
    offset: int = 0,
) -> DataFrame:
    """One page of a fully ordered result; ``tie_break`` is a unique key.

    A page near the top plans as a top-k, not as a full sort. For one deep down, the sort
    columns and the key alone are put in place, and the page's rows are joined to their places.
    """
    named = {f for f, _ in sort}
    keys = list(sort) + [(c, "asc") for c in tie_break if c not in named]
    if offset + limit <= HEAP_ROWS:
        ordered = order(df, keys)
        return (ordered.offset(offset) if offset else ordered).limit(limit)
    places = placed(df.select(*[f for f, _ in keys]), keys, "__place")
    wanted = places.filter(F.col("__place").between(offset + 1, offset + limit))
    wanted = settled(wanted.select(F.struct(*tie_break).alias("__key"), "__place"), "page")
    rows = df.withColumn("__key", F.struct(*tie_break)).join(wanted, "__key")
    return rows.orderBy("__place").drop("__key", "__place")


def select_fields(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    return df.select(*fields) if fields else df


def by_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is listed. Catalyst broadcasts the list only below its size threshold."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def include_flag(df: DataFrame, include: bool, special: Column) -> DataFrame:
    """Rows of a special class appear only when asked for."""
    return df if include else df.filter(~F.coalesce(special, F.lit(False)))


def for_tenant(df: DataFrame, column: str, tenant) -> DataFrame:
    return df.filter(F.col(column) == F.lit(tenant))
