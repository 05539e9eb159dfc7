"""Aggregated reports."""
from __future__ import annotations

from pyspark.sql import functions as F

from ringlens.operators import report as rp
from ringlens.operators.filters import Cond, Tree
from ringlens.operators.report import Formula, Metric, ReportSpec
from ringlens.plans.clauses import TREE, TREE_SQL
from ringlens.plans.registry import query

WIDE_SQL = """orders LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""


def dsum(expression):
    return f"CAST(sum(CAST({expression} AS DECIMAL(18,4))) AS DOUBLE)"


CALLS = Metric("calls", "count")
REVENUE = Metric("revenue", "sum", "revenue")


@query(
    "report_table",
    f"""
    SELECT r_name AS site_name, n_name AS campaign_name, count(*) AS calls,
      {dsum('o_totalprice')} AS revenue
    FROM {WIDE_SQL}
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'
      AND ({TREE_SQL})
    GROUP BY 1, 2 ORDER BY revenue DESC, site_name, campaign_name LIMIT 50
    """,
)
def report_table(m):
    spec = ReportSpec(
        dimensions=("site_name", "campaign_name"),
        metrics=(CALLS, REVENUE),
        date_column="start_time",
        date_from="1996-01-01",
        date_till="1996-12-31",
        filter=TREE,
        sort=(("revenue", "desc"),),
    )
    return rp.report_table(m.calls_wide(), spec)


def star(m, spec, contacts=None):
    """Calls summed per contact, then joined to the contact's columns."""
    rows, merged = rp.preaggregate(m.calls(), spec, ["contact_id"])
    contacts = m.contacts_wide() if contacts is None else contacts
    return rows.join(contacts, "contact_id", "left"), merged


VALUE_METRICS = (
    CALLS, REVENUE,
    Metric("average", "avg", "revenue"),
    Metric("least", "min", "revenue"),
    Metric("most", "max", "revenue"),
    Metric("tags", "count_distinct", "tag"),
    Metric("open_days", "count_distinct", "day", Cond("status", "=", "O")),
    Metric("median", "median", "revenue"),
    Metric("contacts", "count_distinct", "contact_id"),
    Metric("about_contacts", "approx_count_distinct", "contact_id"),
)
VALUES_SQL = f"""count(*) AS calls, {dsum('o_totalprice')} AS revenue,
      {dsum('o_totalprice')} / count(*) AS average, min(o_totalprice) AS least, max(o_totalprice) AS most,
      count(DISTINCT o_orderpriority) AS tags,
      count(DISTINCT CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d') END) AS open_days,
      median(o_totalprice) AS median, count(DISTINCT o_custkey) AS contacts, true AS about_right"""


def _values(m, spec):
    calls = m.calls().withColumn("day", F.date_format("start_time", "yyyy-MM-dd"))
    rows, merged = rp.preaggregate(calls, spec, ["contact_id"])
    return rows.join(m.contacts_wide(), "contact_id", "left"), merged


def _about(df):
    near = F.abs(F.col("about_contacts") - F.col("contacts")) <= F.greatest(F.lit(2), F.col("contacts") * 0.05)
    return df.withColumn("about_right", near).drop("about_contacts")


@query(
    "report_values",
    f"""SELECT n_name AS campaign_name, {VALUES_SQL} FROM {WIDE_SQL} GROUP BY 1""",
)
def report_values(m):
    rows, spec = _values(m, ReportSpec(dimensions=("campaign_name",), metrics=VALUE_METRICS, limit=None))
    return _about(rp.report_table(rows, spec))


@query(
    "report_values_tree",
    f"""
    SELECT CAST(grouping(r_name, c_mktsegment) AS BIGINT) AS level_mask, r_name AS site_name,
      c_mktsegment AS segment, {VALUES_SQL} FROM {WIDE_SQL} GROUP BY ROLLUP (r_name, c_mktsegment)""",
)
def report_values_tree(m):
    rows, spec = _values(m, ReportSpec(dimensions=("site_name", "segment"), metrics=VALUE_METRICS, limit=None))
    return _about(rp.report_tree(rows, spec))


@query("report_values_total", f"SELECT {VALUES_SQL} FROM orders")
def report_values_total(m):
    rows, spec = _values(m, ReportSpec(dimensions=(), metrics=VALUE_METRICS))
    return _about(rp.report_total(rows, spec))


TREE_SPEC = ReportSpec(
    dimensions=("site_name", "campaign_name", "segment"), metrics=(CALLS, REVENUE), limit=None
)


@query(
    "report_drilldown",
    f"""
    SELECT n_name AS campaign_name, count(*) AS calls, {dsum('o_totalprice')} AS revenue,
      coalesce(bool_or(c_mktsegment IS NOT NULL), false) AS expandable
    FROM {WIDE_SQL} WHERE r_name = 'ASIA' GROUP BY 1
    """,
)
def report_drilldown(m):
    rows, spec = star(m, TREE_SPEC)
    return rp.report_level(rows, spec, ("ASIA",))


@query(
    "report_expandable",
    f"""
    SELECT r_name AS site_name, count(*) AS calls, {dsum('o_totalprice')} AS revenue,
      coalesce(bool_or(n_name IS NOT NULL), false) AS expandable
    FROM {WIDE_SQL} GROUP BY 1
    """,
)
def report_expandable(m):
    return rp.report_level(*star(m, TREE_SPEC))


@query(
    "report_rollup",
    f"""
    SELECT r_name AS site_name, n_name AS campaign_name, c_mktsegment AS segment,
      grouping(r_name) * 4 + grouping(n_name) * 2 + grouping(c_mktsegment) AS level_mask,
      count(*) AS calls, {dsum('o_totalprice')} AS revenue
    FROM {WIDE_SQL} GROUP BY ROLLUP (r_name, n_name, c_mktsegment)
    """,
)
def report_rollup(m):
    return rp.report_tree(*star(m, TREE_SPEC))


@query(
    "report_total",
    f"""SELECT count(*) AS calls, {dsum('o_totalprice')} AS revenue,
      CAST({dsum('o_totalprice')} / nullif(count(*), 0) AS DOUBLE) AS average FROM orders""",
)
def report_total(m):
    average = Formula("average", (("column", "revenue"), ("operator", "/"), ("column", "calls")))
    return rp.report_total(m.calls(), ReportSpec(metrics=(CALLS, REVENUE), formulas=(average,)))


@query(
    "custom_metric",
    """
    SELECT c_mktsegment AS segment, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished,
      coalesce(CAST(sum(CAST(o_totalprice AS DECIMAL(18,4)))
        FILTER (WHERE o_orderpriority IN ('1-URGENT','2-HIGH') AND NOT o_orderstatus = 'O')
        AS DOUBLE), 0) AS urgent_revenue
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1
    """,
)
def custom_metric(m):
    urgent = Tree(
        "and",
        (Cond("tag", "in", ["1-URGENT", "2-HIGH"]), Tree("not", (Cond("status", "=", "O"),))),
    )
    spec = ReportSpec(
        dimensions=("segment",),
        metrics=(
            Metric("finished", "count", where=Cond("status", "=", "F")),
            Metric("urgent_revenue", "sum", "revenue", urgent),
        ),
        limit=None,
    )
    return rp.report_table(*star(m, spec, m.contacts()))


# aggregate name -> SQL form over o_totalprice / o_custkey
AGGREGATE_CASES = {
    "sum": ("revenue", dsum("o_totalprice")),
    "avg": ("revenue", f"{dsum('o_totalprice')} / count(o_totalprice)"),
    "min": ("revenue", "min(o_totalprice)"),
    "max": ("revenue", "max(o_totalprice)"),
    "count": ("revenue", "count(o_totalprice)"),
    "count_distinct": ("contact_id", "count(DISTINCT o_custkey)"),
    "median": ("revenue", "median(o_totalprice)"),
}


def _aggregate_query(name, column):
    def build(m):
        spec = ReportSpec(
            dimensions=("tag",), metrics=(Metric("value", name, column),), limit=None
        )
        return rp.report_table(m.calls(), spec)

    return build


for _name, (_column, _sql) in AGGREGATE_CASES.items():
    query(
        f"agg_{_name}",
        f"SELECT o_orderpriority AS tag, {_sql} AS value FROM orders GROUP BY 1",
    )(_aggregate_query(_name, _column))


@query(
    "formula_column",
    f"""
    SELECT campaign_id, calls, CAST(finished AS BIGINT) AS finished, revenue,
      (revenue - 1000) * 0.5 / nullif(finished + calls * 0, 0) AS per_finished,
      revenue / nullif(calls - calls, 0) AS undefined
    FROM (SELECT c_nationkey AS campaign_id, count(*) AS calls,
            CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS finished,
            {dsum('o_totalprice')} AS revenue
          FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1)
    """,
)
def formula_column(m):
    def col(c):
        return ("column", c)

    def op(o):
        return ("operator", o)

    left, right = ("parenthesis", "("), ("parenthesis", ")")
    per_finished = Formula(
        "per_finished",
        (
            left, col("revenue"), op("-"), ("constant", 1000), right, op("*"), ("constant", 0.5),
            op("/"),
            left, col("finished"), op("+"), col("calls"), op("*"), ("constant", 0), right,
        ),
    )
    undefined = Formula(
        "undefined",
        (col("revenue"), op("/"), left, col("calls"), op("-"), col("calls"), right),
    )
    spec = ReportSpec(
        dimensions=("campaign_id",),
        metrics=(CALLS, Metric("finished", "count", where=Cond("status", "=", "F")), REVENUE),
        formulas=(per_finished, undefined),
        limit=None,
    )
    return rp.report_table(*star(m, spec, m.contacts()))


@query(
    "share_of_total",
    f"""
    SELECT *, revenue / CAST(sum(CAST(revenue AS DECIMAL(18,4))) OVER () AS DOUBLE) AS revenue_share
    FROM (SELECT o_orderpriority AS tag, {dsum('o_totalprice')} AS revenue FROM orders GROUP BY 1)
    """,
)
def share_of_total(m):
    spec = ReportSpec(dimensions=("tag",), metrics=(REVENUE,), shares=("revenue",), limit=None)
    return rp.report_table(m.calls(), spec)


@query(
    "share_of_parent",
    f"""
    SELECT *, revenue / CAST(sum(CAST(revenue AS DECIMAL(18,4))) OVER (PARTITION BY site_name)
      AS DOUBLE) AS revenue_share
    FROM (SELECT r_name AS site_name, n_name AS campaign_name, {dsum('o_totalprice')} AS revenue
          FROM {WIDE_SQL} GROUP BY 1, 2)
    """,
)
def share_of_parent(m):
    spec = ReportSpec(dimensions=("site_name", "campaign_name"), metrics=(REVENUE,), limit=None)
    return rp.with_share(rp.report_table(*star(m, spec)), "revenue", ["site_name"])


VALUE_GROUPS = [
    ("low", 2, Cond("revenue", "<", 100000.0)),
    ("big", 0, Cond("revenue", ">", 350000.0)),
    ("urgent", 1, Cond("tag", "=", "1-URGENT")),
]


@query(
    "custom_dimension",
    """
    SELECT CASE WHEN o_totalprice > 350000 THEN 'big' WHEN o_orderpriority = '1-URGENT'
      THEN 'urgent' WHEN o_totalprice < 100000 THEN 'low' ELSE 'other' END AS value_group,
      count(*) AS calls FROM orders GROUP BY 1
    """,
)
def custom_dimension(m):
    spec = ReportSpec(
        dimensions=("value_group",),
        metrics=(CALLS,),
        derived={"value_group": rp.custom_dimension(VALUE_GROUPS, "other")},
        limit=None,
    )
    return rp.report_table(m.calls(), spec)


@query(
    "custom_dimension_entity",
    """
    SELECT entity, CASE WHEN entity = 'goal' THEN CASE WHEN amount > 50 THEN 'rich' ELSE 'other' END
      WHEN entity = 'visit' THEN CASE WHEN amount < 10 THEN 'cheap' ELSE 'other' END
      ELSE 'other' END AS grade, count(*) AS n
    FROM (SELECT CASE event_type WHEN 'signup' THEN 'goal' WHEN 'view' THEN 'visit'
            ELSE 'message' END AS entity, value AS amount FROM events) GROUP BY 1, 2
    """,
)
def custom_dimension_entity(m):
    entity = (
        F.when(F.col("kind") == "signup", "goal")
        .when(F.col("kind") == "view", "visit")
        .otherwise("message")
    )
    rows = m.events().withColumn("entity", entity)
    grade = rp.custom_dimension_by_entity(
        "entity",
        {
            "goal": [("rich", 0, Cond("amount", ">", 50.0))],
            "visit": [("cheap", 0, Cond("amount", "<", 10.0))],
        },
        "other",
    )
    return rows.withColumn("grade", grade).groupBy("entity", "grade").agg(F.count("*").alias("n"))


@query(
    "benchmark_table",
    f"""
    SELECT test_group, o_orderstatus AS status, count(*) AS calls, {dsum('o_totalprice')} AS revenue
    FROM (SELECT *, 'urgent' AS test_group FROM orders WHERE o_orderpriority = '1-URGENT'
      UNION ALL SELECT *, 'big' FROM orders WHERE o_totalprice > 200000)
    WHERE o_orderdate >= TIMESTAMP '1995-06-01' AND o_orderdate < TIMESTAMP '1996-06-01'
    GROUP BY 1, 2
    """,
)
def benchmark_table(m):
    spec = ReportSpec(
        dimensions=("status",),
        metrics=(CALLS, REVENUE),
        date_column="start_time",
        date_from="1995-06-01",
        date_till="1996-05-31",
        limit=None,
    )
    groups = [("urgent", Cond("tag", "=", "1-URGENT")), ("big", Cond("revenue", ">", 200000.0))]
    return rp.benchmark_table(m.calls(), spec, groups)


@query(
    "period_compare",
    f"""
    SELECT *, calls_main - calls_compared AS calls_delta,
      CAST(calls_main AS DOUBLE) / nullif(calls_compared, 0) AS calls_ratio,
      revenue_main - revenue_compared AS revenue_delta,
      revenue_main / nullif(revenue_compared, 0) AS revenue_ratio
    FROM (SELECT o_orderpriority AS tag,
      count(*) FILTER (WHERE year(o_orderdate) = 1997) AS calls_main,
      count(*) FILTER (WHERE year(o_orderdate) = 1996) AS calls_compared,
      coalesce(CAST(sum(CAST(o_totalprice AS DECIMAL(18,4)))
        FILTER (WHERE year(o_orderdate) = 1997) AS DOUBLE), 0) AS revenue_main,
      coalesce(CAST(sum(CAST(o_totalprice AS DECIMAL(18,4)))
        FILTER (WHERE year(o_orderdate) = 1996) AS DOUBLE), 0) AS revenue_compared
      FROM orders WHERE year(o_orderdate) IN (1996, 1997) GROUP BY 1)
    """,
)
def period_compare(m):
    spec = ReportSpec(dimensions=("tag",), metrics=(CALLS, REVENUE), date_column="start_time")
    return rp.period_compare(
        m.calls(), spec, ("1997-01-01", "1997-12-31"), ("1996-01-01", "1996-12-31")
    )


@query(
    "linechart",
    f"""
    SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS bucket, o_orderstatus AS status,
      count(*) AS calls, {dsum('o_totalprice')} AS revenue
    FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'
      AND o_orderdate < TIMESTAMP '1997-01-01' GROUP BY 1, 2
    """,
)
def linechart(m):
    spec = ReportSpec(
        dimensions=("status",),
        metrics=(CALLS, REVENUE),
        date_column="start_time",
        date_from="1996-01-01",
        date_till="1996-12-31",
    )
    return rp.linechart(m.calls(), spec, "month")


@query(
    "linechart_total",
    """
    SELECT b."from", b."from" + INTERVAL 1 DAY - INTERVAL 1 SECOND AS till,
      coalesce(n, 0) AS visits
    FROM (SELECT unnest(generate_series(TIMESTAMP '2023-12-20', TIMESTAMP '2024-02-05',
            INTERVAL 1 DAY)) AS "from") b
    LEFT JOIN (SELECT date_trunc('day', ts)::TIMESTAMP AS d, count(*) AS n FROM events
      WHERE event_type = 'view' GROUP BY 1) ON d = b."from"
    """,
)
def linechart_total(m):
    spec = ReportSpec(
        metrics=(Metric("visits", "count"),),
        filter=Cond("kind", "=", "view"),
        date_column="date_time",
        date_from="2023-12-20",
        date_till="2024-02-05",
    )
    return rp.linechart_total(m.events(), spec, "day")


@query(
    "tree_clauses",
    f"""
    SELECT site_name, segment, level_mask, calls, revenue, middle, revenue / nullif(calls, 0) AS each_call FROM (
      SELECT r_name AS site_name, c_mktsegment AS segment, grouping(r_name) * 2 + grouping(c_mktsegment) AS level_mask,
        count(*) AS calls, {dsum('o_totalprice')} AS revenue, median(o_totalprice) AS middle
      FROM {WIDE_SQL} GROUP BY ROLLUP (r_name, c_mktsegment))
    WHERE calls > 20
    """,
)
def tree_clauses(m):
    """A tree with an exact median, a formula and a column filter on every level."""
    spec = ReportSpec(
        dimensions=("site_name", "segment"),
        metrics=(CALLS, REVENUE, Metric("middle", "median", "revenue")),
        formulas=(EACH_CALL,),
        columns_filter=Cond("calls", ">", 20),
        sort=(("calls", "desc"),),
    )
    return rp.report_tree(m.calls_wide(), spec)


EACH_CALL = Formula("each_call", (("column", "revenue"), ("operator", "/"), ("column", "calls")))


@query(
    "linechart_clauses",
    f"""
    SELECT *, revenue / nullif(calls, 0) AS each_call, CAST(calls AS DOUBLE) / sum(calls) OVER () AS calls_share
    FROM (SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS bucket, o_orderstatus AS status, count(*) AS calls,
      {dsum('o_totalprice')} AS revenue, median(o_totalprice) AS middle FROM orders GROUP BY 1, 2)
    QUALIFY calls > 3
    """,
)
def linechart_clauses(m):
    spec = ReportSpec(
        dimensions=("status",),
        metrics=(CALLS, REVENUE, Metric("middle", "median", "revenue")),
        formulas=(EACH_CALL,),
        shares=("calls",),
        columns_filter=Cond("calls", ">", 3),
        date_column="start_time",
    )
    return rp.linechart(m.calls(), spec, "month")


@query(
    "compare_clauses",
    """
    SELECT tag, main AS calls_main, compared AS calls_compared, main - compared AS calls_delta,
      CAST(main AS DOUBLE) / nullif(compared, 0) AS calls_ratio, CAST(main + compared AS DOUBLE) AS both_periods
    FROM (SELECT o_orderpriority AS tag, count(*) FILTER (WHERE year(o_orderdate) = 1997) AS main,
      count(*) FILTER (WHERE year(o_orderdate) = 1996) AS compared FROM orders
      WHERE year(o_orderdate) IN (1996, 1997) GROUP BY 1) WHERE main > 10
    """,
)
def compare_clauses(m):
    both = (("column", "calls_main"), ("operator", "+"), ("column", "calls_compared"))
    spec = ReportSpec(
        dimensions=("tag",), metrics=(CALLS,), formulas=(Formula("both_periods", both),),
        columns_filter=Cond("calls_main", ">", 10), date_column="start_time",
    )
    return rp.period_compare(
        m.calls(), spec, ("1997-01-01", "1997-12-31"), ("1996-01-01", "1996-12-31")
    )


@query(
    "average_by_site",
    f"""SELECT r_name AS site_name, count(*) AS calls, {dsum('o_totalprice')} / count(o_totalprice) AS average
    FROM {WIDE_SQL} GROUP BY 1""",
)
def average_by_site(m):
    """An average merged from partial sums and counts per contact."""
    spec = ReportSpec(dimensions=("site_name",), metrics=(CALLS, Metric("average", "avg", "revenue")), limit=None)
    return rp.report_table(*star(m, spec))
