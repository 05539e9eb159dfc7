"""Declarative reports: a ``ReportSpec`` turned into one DataFrame plan.

Clause order: tenant, dates, filters, derived dimensions, aggregate, formulas, shares,
column filter, sort and page, field list.
"""
from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlens.functions.numbers import money, money_avg, money_sum, ratio
from ringlens.operators import filters as flt
from ringlens.operators.filters import Cond, Tree, compile_filter
from ringlens.operators.ordered import exact_median

# aggregate name -> Column of an (optionally filtered) input column
AGGREGATES = {
    "sum": money_sum,
    "avg": money_avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "count_distinct": F.count_distinct,
    "approx_count_distinct": F.approx_count_distinct,
    # merges of columns made by ``preaggregate``
    "total": lambda c: F.coalesce(F.sum(c), F.lit(0).cast("long")),
    "money_total": lambda c: F.sum(c).cast("double"),
    "average_total": lambda c: F.sum(c["sum"]).cast("double") / F.nullif(F.sum(c["n"]), F.lit(0)),
    "sketch_total": lambda c: F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0).cast("long")),
}
# aggregates of values, not of rows: computed apart and joined on the dimensions
APART = ("median", "counted_median", "counted_distinct")


@dataclass(frozen=True)
class Metric:
    """An aggregate with its own optional filter; ``column=None`` counts rows."""

    name: str
    agg: str
    column: str | None = None
    where: Cond | Tree | None = None

    def source(self) -> Column:
        value = F.lit(1) if self.column is None else F.col(self.column)
        return value if self.where is None else F.when(compile_filter(self.where), value)

    def aggregate(self) -> Column:
        if self.agg not in AGGREGATES:
            raise ValueError(f"unknown aggregate {self.agg!r}")
        out = AGGREGATES[self.agg](self.source())
        if self.agg in ("sum", "money_total"):
            out = F.coalesce(out, F.lit(0.0))
        return out.alias(self.name)


@dataclass(frozen=True)
class Formula:
    """A column computed from other report columns.

    Tokens are (kind, value) with kind column, constant, operator or parenthesis.
    A zero divisor gives NULL.
    """

    name: str
    tokens: tuple[tuple[str, Any], ...]
    data_type: str = "double"


@dataclass(frozen=True)
class ReportSpec:
    dimensions: tuple[str, ...] = ()
    metrics: tuple[Metric, ...] = ()
    formulas: tuple[Formula, ...] = ()
    shares: tuple[str, ...] = ()
    derived: dict[str, Column] = field(default_factory=dict)
    tenant: tuple[str, Any] | None = None
    date_column: str | None = None
    date_from: str | None = None
    date_till: str | None = None
    max_days: int = 366
    filter: Cond | Tree | None = None
    rapid_filter: Cond | Tree | None = None
    columns_filter: Cond | Tree | None = None
    sort: tuple[tuple[str, str], ...] = ()
    limit: int | None = 50
    offset: int = 0
    fields: tuple[str, ...] | None = None


PRECEDENCE = {"+": 1, "-": 1, "*": 2, "/": 2}
ARITHMETIC = {
    "+": lambda a, b: a + b,
    "-": lambda a, b: a - b,
    "*": lambda a, b: a * b,
    "/": ratio,
}


def formula_column(formula: Formula, known: list[str]) -> Column:
    """Fold the token list into Column arithmetic; only known columns may be named."""
    operands: list[Column] = []
    pending: list[str] = []

    def fold():
        right, left = operands.pop(), operands.pop()
        operands.append(ARITHMETIC[pending.pop()](left, right))

    try:
        for kind, value in formula.tokens:
            if kind == "column":
                if value not in known:
                    raise ValueError(f"formula names unknown column {value!r}")
                operands.append(F.col(value).cast("double"))
            elif kind == "constant":
                operands.append(F.lit(float(value)))
            elif kind == "operator" and value in PRECEDENCE:
                while pending and PRECEDENCE.get(pending[-1], 0) >= PRECEDENCE[value]:
                    fold()
                pending.append(value)
            elif kind == "parenthesis" and value == "(":
                pending.append(value)
            elif kind == "parenthesis" and value == ")":
                while pending[-1] != "(":
                    fold()
                pending.pop()
            else:
                raise ValueError(f"unknown formula token {(kind, value)!r}")
        while pending:
            fold()
        (result,) = operands
    except (IndexError, KeyError) as e:
        raise ValueError(f"unbalanced formula {formula.name!r}") from e
    return result.cast(formula.data_type).alias(formula.name)


def scoped(df: DataFrame, spec: ReportSpec) -> DataFrame:
    """The detail rows a report looks at, with its derived dimensions."""
    if spec.tenant:
        df = flt.for_tenant(df, *spec.tenant)
    if bool(spec.date_from) != bool(spec.date_till):
        raise ValueError("a date range needs both date_from and date_till")
    if spec.date_from:
        df = flt.date_range(df, spec.date_column, spec.date_from, spec.date_till, spec.max_days)
    df = flt.where(flt.where(df, spec.filter), spec.rapid_filter)
    return df.withColumns(spec.derived) if spec.derived else df


def aggregate(df: DataFrame, dims: list[str | Column], metrics, extra=()) -> DataFrame:
    """Group once for all metrics; medians and what is counted by value are computed apart and
    joined on the dimensions."""
    plain = [m for m in metrics if m.agg not in APART]
    apart = [m for m in metrics if m.agg in APART]
    aggs = [m.aggregate() for m in plain] + list(extra)
    rows = df.filter(F.col(KIND) == "") if KIND in df.columns else df
    if not apart:
        return rows.groupBy(*dims).agg(*aggs) if dims else rows.agg(*aggs)
    out = rows.groupBy(*dims).agg(*(aggs or [F.count("*").alias("__rows")]))
    names = [d for d in dims]
    for m in apart:
        side = values_apart(df, names, m)
        renamed = side.select(*[F.col(n).alias(f"__r_{n}") for n in names], m.name)
        if names:
            match = [F.col(n).eqNullSafe(F.col(f"__r_{n}")) for n in names]
            out = out.join(renamed, match, "left").drop(*[f"__r_{n}" for n in names])
        else:
            out = out.withColumn(m.name, side.scalar())
    counts = [m.name for m in apart if m.agg == "counted_distinct"]
    return (out.na.fill(0, counts) if counts else out).drop("__rows")


def values_apart(df: DataFrame, names: list[str], m: Metric) -> DataFrame:
    """One metric of values per ``names``."""
    if m.agg == "median":
        return exact_median(df.withColumn("__m", m.source()), names, "__m", m.name)
    counted = df.filter(F.col(KIND) == m.column)
    if m.agg == "counted_median":
        return exact_median(counted, names, m.column, m.name, F.col("__times"))
    once = counted.groupBy(*names, m.column).agg(F.lit(1).alias("__once"))
    return once.groupBy(*names).agg(F.count("*").alias(m.name))


# aggregate -> (partial form, aggregate that merges the partial values); an average is kept
# as (sum, count), an approximate distinct count as a sketch
DECOMPOSED = {
    "count": (F.count, "total"),
    "sum": (lambda c: F.sum(money(c)), "money_total"),
    "min": (F.min, "min"),
    "max": (F.max, "max"),
    "avg": (lambda c: F.struct(F.sum(money(c)).alias("sum"), F.count(c).alias("n")), "average_total"),
    "approx_count_distinct": (F.hll_sketch_agg, "sketch_total"),
}
# aggregate -> what merges counted values: rows of (keys, value, times)
COUNTED = {"count_distinct": "counted_distinct", "median": "counted_median"}
KIND = "__kind"


def preaggregate(df: DataFrame, spec: ReportSpec, keys: list[str]) -> tuple[DataFrame, ReportSpec]:
    """Shrink a fact to its join keys before a dimension is joined to it.

    Returns partial rows per (keys, report dimensions the fact has itself) and the report
    that merges them. A key with very many fact rows leaves each map task as one row, so it
    can neither skew the join nor the shuffle before it. Distinct counts and medians need the
    values: for each of them follow rows of (keys, value, how often), marked by their kind, so
    a key leaves a map task as one row per distinct value. The report reads only the rows of
    the kind that a metric needs, and the other branches fall out of that plan.
    """
    own = [d for d in spec.dimensions if d in df.columns or d in spec.derived]
    group = list(dict.fromkeys([*keys, *own]))
    fact = scoped(df, spec)
    partial, merged, counted = [], [], []
    for m in spec.metrics:
        if m.agg in COUNTED:
            value = f"__v_{m.name}"
            rows = fact.withColumn(value, m.source()).filter(F.col(value).isNotNull())
            counted.append(
                rows.groupBy(*group, value).agg(F.count("*").alias("__times")).withColumn(KIND, F.lit(value))
            )
            merged.append(Metric(m.name, COUNTED[m.agg], value))
            continue
        if m.agg not in DECOMPOSED:
            raise ValueError(f"aggregate {m.agg!r} cannot be merged from parts")
        first, then = DECOMPOSED[m.agg]
        partial.append(first(m.source()).alias(f"__p_{m.name}"))
        merged.append(Metric(m.name, then, f"__p_{m.name}"))
    rows = fact.groupBy(*group).agg(*(partial or [F.count("*").alias("__rows")]))
    if counted:
        parts = [rows.withColumn(KIND, F.lit("")), *counted]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    rest = replace(
        spec, metrics=tuple(merged), tenant=None, date_from=None, date_till=None, filter=None,
        rapid_filter=None, derived={},
    )
    return rows, rest


def finish(df: DataFrame, spec: ReportSpec, dims: list[str], paged: bool = True) -> DataFrame:
    """Formulas, shares, column filter, order, page and field list over aggregated rows.

    Trees, charts and comparisons are whole: ``paged=False`` leaves ``limit`` aside, and an
    offset, which would cut them, raises. Shares of a tree would count its levels twice.
    """
    if not paged and spec.offset:
        raise ValueError("this report has no pages")
    if spec.shares and "level_mask" in df.columns:
        raise ValueError("a tree has no column shares")
    for f in spec.formulas:
        df = df.withColumn(f.name, formula_column(f, df.columns))
    for s in spec.shares:
        df = with_share(df, s)
    df = flt.where(df, spec.columns_filter)
    if paged and spec.limit is not None:
        df = flt.page(df, list(spec.sort), dims, spec.limit, spec.offset)
    elif spec.sort:
        df = flt.order(df, list(spec.sort))
    return flt.select_fields(df, list(spec.fields) if spec.fields else None)


def report_table(df: DataFrame, spec: ReportSpec) -> DataFrame:
    dims = list(spec.dimensions)
    return finish(aggregate(scoped(df, spec), dims, spec.metrics), spec, dims)


def report_level(df: DataFrame, spec: ReportSpec, parents: tuple = ()) -> DataFrame:
    """Children of one node of the dimension tree, with an ``expandable`` flag.

    A NULL parent value is a value of its own.
    """
    depth = len(parents)
    rows = scoped(df, spec)
    for name, value in zip(spec.dimensions, parents):
        rows = rows.filter(F.col(name).eqNullSafe(F.lit(value)))
    level = spec.dimensions[depth]
    deeper = depth + 1 < len(spec.dimensions)
    flag = (
        F.coalesce(F.bool_or(F.col(spec.dimensions[depth + 1]).isNotNull()), F.lit(False))
        if deeper
        else F.bool_and(F.lit(False))
    )
    out = aggregate(rows, [level], spec.metrics, [flag.alias("expandable")])
    return finish(out, spec, [level])


def report_tree(df: DataFrame, spec: ReportSpec) -> DataFrame:
    """Every level of the dimension tree and the grand total from one scan.

    Medians and counted values are computed once per level and joined to it.
    """
    dims, rows = list(spec.dimensions), scoped(df, spec)
    plain = [m.aggregate() for m in spec.metrics if m.agg not in APART]
    whole = rows.filter(F.col(KIND) == "") if KIND in rows.columns else rows
    out = whole.rollup(*dims).agg(F.grouping_id().alias("level_mask"), *plain)
    for m in spec.metrics:
        if m.agg not in APART:
            continue
        levels = []
        for depth in range(len(dims) + 1):
            side = values_apart(rows, dims[:depth], m)
            levels.append(
                side.select(
                    F.lit((1 << (len(dims) - depth)) - 1).cast("long").alias("__level"),
                    *[
                        (F.col(d) if i < depth else F.lit(None).cast(rows.schema[d].dataType)).alias(f"__r_{d}")
                        for i, d in enumerate(dims)
                    ],
                    m.name,
                )
            )
        match = [F.col("level_mask") == F.col("__level")]
        match += [F.col(d).eqNullSafe(F.col(f"__r_{d}")) for d in dims]
        joined = out.join(reduce(DataFrame.unionByName, levels), match, "left")
        out = joined.drop("__level", *[f"__r_{d}" for d in dims])
        out = out.na.fill(0, [m.name]) if m.agg == "counted_distinct" else out
    return finish(out, spec, ["level_mask", *dims], paged=False)


def report_total(df: DataFrame, spec: ReportSpec) -> DataFrame:
    out = aggregate(scoped(df, spec), [], spec.metrics)
    for f in spec.formulas:
        out = out.withColumn(f.name, formula_column(f, out.columns))
    return out


def with_share(df: DataFrame, column: str, parent: list[str] | None = None) -> DataFrame:
    """Share of the column total, or of the total below each ``parent`` value."""
    if not parent:
        total = df.agg(F.sum(money(column)).cast("double")).scalar()
        return df.withColumn(f"{column}_share", ratio(F.col(column), total))
    totals = df.groupBy(*parent).agg(money_sum(column).alias("__total"))
    return (
        df.join(totals, parent, "left")
        .withColumn(f"{column}_share", ratio(F.col(column), F.col("__total")))
        .drop("__total")
    )


def custom_dimension(groups: list[tuple[str, int, Cond | Tree]], default=None) -> Column:
    """Name of the first matching group; groups are (name, priority, filter), 0 goes first."""
    chain = None
    for name, _, node in sorted(groups, key=lambda g: g[1]):
        test = compile_filter(node)
        chain = F.when(test, name) if chain is None else chain.when(test, name)
    return chain.otherwise(F.lit(default))


def custom_dimension_by_entity(
    entity: str, rules: dict[str, list[tuple[str, int, Cond | Tree]]], default=None
) -> Column:
    chain = None
    for name, groups in sorted(rules.items()):
        test, value = F.col(entity) == name, custom_dimension(groups, default)
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return chain.otherwise(F.lit(default))


def benchmark_table(
    df: DataFrame, spec: ReportSpec, groups: list[tuple[str, Cond | Tree]]
) -> DataFrame:
    """A report split by tested groups; a row counts in every group it belongs to."""
    member = F.filter(
        F.array(*[F.when(compile_filter(node), F.lit(name)) for name, node in groups]),
        lambda g: g.isNotNull(),
    )
    rows = scoped(df, spec).withColumn("test_group", F.explode(member))
    inner = replace(spec, tenant=None, date_from=None, date_till=None, filter=None, rapid_filter=None, derived={})
    return report_table(rows, replace(inner, dimensions=("test_group", *spec.dimensions)))


def period_compare(
    df: DataFrame,
    spec: ReportSpec,
    main: tuple[str, str],
    compared: tuple[str, str],
) -> DataFrame:
    """Both periods from one scan: conditional aggregates, difference and ratio."""

    def inside(period):
        return Cond(spec.date_column, "between", [_edge(period[0]), _edge(period[1], end=True)])

    rows = scoped(df, replace(spec, date_from=None, date_till=None))
    rows = rows.filter(compile_filter(Tree("or", (inside(main), inside(compared)))))
    metrics = []
    for m in spec.metrics:
        for suffix, period in (("main", main), ("compared", compared)):
            test = inside(period)
            metrics.append(
                Metric(
                    f"{m.name}_{suffix}",
                    m.agg,
                    m.column,
                    test if m.where is None else Tree("and", (test, m.where)),
                )
            )
    out = aggregate(rows, list(spec.dimensions), metrics)
    for m in spec.metrics:
        a, b = F.col(f"{m.name}_main"), F.col(f"{m.name}_compared")
        out = out.withColumns({f"{m.name}_delta": a - b, f"{m.name}_ratio": ratio(a, b)})
    return finish(out, spec, list(spec.dimensions), paged=False)


def _edge(day: str, end: bool = False):
    text = f"{day} 23:59:59.999999" if end and len(day) == 10 else day
    return F.lit(text).cast("timestamp_ntz")


# chart unit -> step of one bucket
UNITS = {
    "hour": "INTERVAL 1 HOUR",
    "day": "INTERVAL 1 DAY",
    "week": "INTERVAL 7 DAYS",
    "month": "INTERVAL 1 MONTH",
    "quarter": "INTERVAL 3 MONTHS",
    "year": "INTERVAL 1 YEAR",
}


def bucket(ts: str | Column, unit: str) -> Column:
    if unit not in UNITS:
        raise ValueError(f"unknown time unit {unit!r}")
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_trunc(unit, c).cast("timestamp_ntz")


def linechart(df: DataFrame, spec: ReportSpec, unit: str) -> DataFrame:
    """Metrics per time bucket and series (the report dimensions)."""
    rows = scoped(df, spec).withColumn("bucket", bucket(spec.date_column, unit))
    out = aggregate(rows, ["bucket", *spec.dimensions], spec.metrics)
    return finish(out, spec, ["bucket", *spec.dimensions], paged=False)


def linechart_total(df: DataFrame, spec: ReportSpec, unit: str) -> DataFrame:
    """One row per bucket of the range with its bounds; a bucket without rows shows zeros."""
    rows = scoped(df, spec).withColumn("bucket", bucket(spec.date_column, unit))
    sums = aggregate(rows, ["bucket"], spec.metrics)
    steps = F.expr(
        f"sequence(date_trunc('{unit}', timestamp '{spec.date_from}'), "
        f"date_trunc('{unit}', timestamp '{spec.date_till}'), {UNITS[unit]})"
    )
    axis = df.sparkSession.range(1).select(F.explode(steps).alias("bucket"))
    axis = axis.select(F.col("bucket").cast("timestamp_ntz").alias("bucket"))
    zero = {m.name: F.coalesce(F.col(m.name), F.lit(0)) for m in spec.metrics}
    out = (
        axis.join(sums, "bucket", "left")
        .withColumns(zero)
        .withColumn("till", F.expr(f"bucket + {UNITS[unit]} - INTERVAL 1 SECOND"))
        .withColumnRenamed("bucket", "from")
    )
    return finish(out, spec, ["from"], paged=False)
