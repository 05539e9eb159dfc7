"""Filters, formulas and invariants between reports."""
from datetime import datetime

import pytest

from ringlens.operators import filters as flt
from ringlens.operators import report as rp
from ringlens.operators.filters import Cond, SavedFilters, Tree
from ringlens.operators.report import Formula, Metric, ReportSpec
from ringlens.sources.model import Model

SF = "/root/testdata/sf0.001"
SPEC = ReportSpec(
    dimensions=("site_name", "campaign_name"),
    metrics=(Metric("calls", "count"), Metric("revenue", "sum", "revenue")),
    limit=None,
)


@pytest.fixture(scope="module")
def rows(spark):
    data = [(1, "a", 5.0), (2, "", 7.0), (3, None, 9.0), (4, "abc", None)]
    return spark.createDataFrame(data, "id long, name string, x double")


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize(
    "node, expected",
    [
        (Cond("name", "=", "a"), [1]),
        (Cond("name", "="), [2, 3]),
        (Cond("name", "!="), [1, 4]),
        (Cond("name", "is_null"), [2, 3]),
        (Cond("name", "sub", "b"), [4]),
        (Cond("name", "~", "^a"), [1, 4]),
        (Cond("x", "between", [6, 9]), [2, 3]),
        (Cond("x", "is_null"), [4]),
        (Cond("id", "not_in", [1, 2]), [3, 4]),
        (Tree("and", (Cond("id", ">", 1), Cond("x", "<", 8.0))), [2]),
        (Tree("or", (Cond("id", "=", 1), Tree("not", (Cond("id", "<", 4),)))), [1, 4]),
        (Tree("and", ()), [1, 2, 3, 4]),
    ],
)
def test_conditions(rows, node, expected):
    assert ids(flt.where(rows, node)) == expected


def test_unknown_names_are_refused(rows):
    with pytest.raises(ValueError):
        flt.compile_filter(Cond("id", "like", 1))
    with pytest.raises(ValueError):
        flt.compile_filter(Tree("xor", (Cond("id", "=", 1),)))
    with pytest.raises(KeyError):
        SavedFilters().get("missing")
    with pytest.raises(ValueError):
        Metric("m", "mode", "x").aggregate()
    with pytest.raises(ValueError):
        rp.bucket("ts", "fortnight")


def test_date_range_edges(spark):
    times = [datetime(2024, 1, 1), datetime(2024, 1, 31, 23, 59, 59), datetime(2024, 2, 1)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id long, ts timestamp_ntz")
    assert ids(flt.date_range(df, "ts", "2024-01-01", "2024-01-31")) == [0, 1]
    assert ids(flt.date_range(df, "ts", "2024-01-01", "2024-01-31 00:00:00")) == [0]
    with pytest.raises(ValueError):
        flt.date_range(df, "ts", "2024-01-01", "2024-03-01", max_days=31)
    with pytest.raises(ValueError):
        flt.date_range(df, "ts", "2024-03-01", "2024-01-01")


def test_pages_join_to_the_whole_list(spark):
    calls = Model(spark, SF).calls().select("call_id", "status")
    sort = [("status", "desc")]
    whole = [r.call_id for r in flt.order(calls, sort + [("call_id", "asc")]).collect()]
    paged = []
    for offset in range(0, len(whole), 600):
        part = flt.page(calls, sort, ["call_id"], limit=600, offset=offset)
        paged += [r.call_id for r in part.collect()]
    assert paged == whole


@pytest.mark.parametrize(
    "tokens, expected",
    [
        ("a + b * 2", 8.0),
        ("( a + b ) * 2", 10.0),
        ("a - b - 1", -2.0),
        ("a / ( b - b )", None),
        ("8 / b / 2", 4.0 / 3),
    ],
)
def test_formula(spark, tokens, expected):
    def token(t):
        if t in "()":
            return ("parenthesis", t)
        if t in "+-*/":
            return ("operator", t)
        return ("constant", float(t)) if t.isdigit() else ("column", t)

    df = spark.createDataFrame([(2, 3)], "a int, b int")
    formula = Formula("f", tuple(token(t) for t in tokens.split()))
    value = df.select(rp.formula_column(formula, df.columns)).first().f
    assert value == (None if expected is None else pytest.approx(expected))


@pytest.mark.parametrize(
    "tokens",
    [
        (("column", "z"),),
        (("parenthesis", "("), ("column", "a")),
        (("operator", "+"), ("column", "a")),
        (("operator", "%"),),
        (("parenthesis", ")"),),
        (),
    ],
)
def test_bad_formulas(tokens):
    with pytest.raises(ValueError):
        rp.formula_column(Formula("f", tokens), ["a"])


def test_levels_add_up(spark):
    wide = Model(spark, SF).calls_wide()
    total = rp.report_total(wide, SPEC).first()
    tree = rp.report_tree(wide, SPEC).collect()
    (grand,) = [r for r in tree if r.level_mask == 3]
    assert (grand.calls, grand.revenue) == (total.calls, total.revenue)
    top = rp.report_level(wide, SPEC).collect()
    assert sum(r.calls for r in top) == total.calls and all(r.expandable for r in top)
    for parent in top:
        children = rp.report_level(wide, SPEC, (parent.site_name,)).collect()
        assert sum(r.calls for r in children) == parent.calls
        assert not any(r.expandable for r in children)


def test_null_dimension_is_a_value(spark):
    df = spark.createDataFrame([("a", "x"), (None, "y"), (None, "z")], "d string, e string")
    spec = ReportSpec(dimensions=("d", "e"), metrics=(Metric("n", "count"),), limit=None)
    assert {r.d: r.n for r in rp.report_table(df, ReportSpec(("d",), spec.metrics)).collect()} == {
        "a": 1,
        None: 2,
    }
    assert {r.e for r in rp.report_level(df, spec, (None,)).collect()} == {"y", "z"}


def test_shares_sum_to_one(spark):
    calls = Model(spark, SF).calls()
    spec = ReportSpec(("tag",), (Metric("n", "count"),), shares=("n",), limit=None)
    assert sum(r.n_share for r in rp.report_table(calls, spec).collect()) == pytest.approx(1)


def test_median_of_groups_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 5.0), ("a", 2.0), ("b", 1.0), ("b", 2.0), (None, 4.0), ("c", None)],
        "g string, x double",
    )
    spec = ReportSpec(("g",), (Metric("m", "median", "x"), Metric("n", "count")), limit=None)
    got = {r.g: (r.m, r.n) for r in rp.report_table(df, spec).collect()}
    assert got == {"a": (2.0, 3), "b": (1.5, 2), None: (4.0, 1), "c": (None, 1)}
    total = ReportSpec((), (Metric("m", "median", "x"),))
    assert rp.report_total(df, total).first().m == 2.0


def test_linechart_fills_empty_buckets(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 2),)], "ts timestamp_ntz")
    spec = ReportSpec(
        metrics=(Metric("n", "count"),),
        date_column="ts",
        date_from="2024-01-01",
        date_till="2024-01-04",
    )
    out = rp.linechart_total(df, spec, "day").orderBy("from").collect()
    assert [r.n for r in out] == [0, 1, 0, 0]
    assert out[0].till == datetime(2024, 1, 1, 23, 59, 59)
