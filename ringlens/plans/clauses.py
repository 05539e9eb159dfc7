"""Report clauses: fields, filters, dates, order, pages, saved filters, tenant."""
from __future__ import annotations

from pyspark.sql import functions as F

from ringlens.functions.numbers import money_sum
from ringlens.operators import filters as flt
from ringlens.operators.filters import Cond, SavedFilters, Tree
from ringlens.operators.report import Metric, ReportSpec, preaggregate, report_table
from ringlens.plans.registry import query

CALL_FIELDS = ["call_id", "contact_id", "start_time", "status", "revenue", "tag"]
CALL_SQL = """o_orderkey AS call_id, o_custkey AS contact_id, o_orderdate AS start_time,
    o_orderstatus AS status, o_totalprice AS revenue, o_orderpriority AS tag"""


@query("fields_projection", "SELECT o_orderkey AS call_id, o_orderstatus AS status FROM orders")
def fields_projection(m):
    return flt.select_fields(m.calls(), ["call_id", "status"])


@query("filter_simple", f"SELECT {CALL_SQL} FROM orders WHERE o_orderstatus = 'F'")
def filter_simple(m):
    return flt.where(m.calls(), Cond("status", "=", "F"))


@query(
    "filter_empty",
    """
    SELECT count(*) AS n, min(call_id) AS first_id FROM (
      SELECT o_orderkey AS call_id,
        CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '4-NOT SPECIFIED' THEN ''
             ELSE o_orderpriority END AS tag FROM orders)
    WHERE tag IS NULL OR tag = ''
    """,
)
def filter_empty(m):
    blanked = m.calls().withColumn(
        "tag",
        F.when(F.col("tag") == "5-LOW", F.lit(None))
        .when(F.col("tag") == "4-NOT SPECIFIED", "")
        .otherwise(F.col("tag")),
    )
    return flt.where(blanked, Cond("tag", "=")).agg(
        F.count("*").alias("n"), F.min("call_id").alias("first_id")
    )


TREE = Tree(
    "or",
    (
        Tree("and", (Cond("status", "in", ["F", "P"]), Cond("revenue", ">", 200000.0))),
        Tree(
            "and",
            (Cond("tag", "sub", "URGENT"), Tree("not", (Cond("segment", "=", "BUILDING"),))),
        ),
    ),
)
TREE_SQL = """(o_orderstatus IN ('F', 'P') AND o_totalprice > 200000)
    OR (contains(o_orderpriority, 'URGENT') AND NOT c_mktsegment = 'BUILDING')"""


@query(
    "filter_tree",
    f"""
    SELECT o_orderkey AS call_id, o_orderstatus AS status, o_totalprice AS revenue,
      o_orderpriority AS tag, c_mktsegment AS segment
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE {TREE_SQL}
    """,
)
def filter_tree(m):
    rows = m.calls().join(m.contacts(), "contact_id", "left")
    return flt.where(rows, TREE).select("call_id", "status", "revenue", "tag", "segment")


# one query per operator: (query suffix, condition, SQL predicate)
OPERATOR_CASES = [
    ("eq", Cond("status", "=", "F"), "o_orderstatus = 'F'"),
    ("ne", Cond("status", "!=", "F"), "o_orderstatus <> 'F'"),
    ("lt", Cond("revenue", "<", 100000.0), "o_totalprice < 100000"),
    ("le", Cond("call_id", "<=", 5000), "o_orderkey <= 5000"),
    ("gt", Cond("revenue", ">", 400000.0), "o_totalprice > 400000"),
    ("ge", Cond("call_id", ">=", 900), "o_orderkey >= 900"),
    ("in", Cond("tag", "in", ["1-URGENT", "2-HIGH"]), "o_orderpriority IN ('1-URGENT', '2-HIGH')"),
    ("not_in", Cond("tag", "not_in", ["5-LOW"]), "o_orderpriority NOT IN ('5-LOW')"),
    ("sub", Cond("tag", "sub", "SPEC"), "contains(o_orderpriority, 'SPEC')"),
    ("not_sub", Cond("tag", "not_sub", "I"), "NOT contains(o_orderpriority, 'I')"),
    ("regex", Cond("tag", "~", "^[1-3]-[HM]"), "regexp_matches(o_orderpriority, '^[1-3]-[HM]')"),
    ("is_null", Cond("tag", "is_null"), "(o_orderpriority IS NULL OR o_orderpriority = '')"),
    ("between", Cond("revenue", "between", [1e5, 2e5]), "o_totalprice BETWEEN 1e5 AND 2e5"),
]


def _operator_query(cond):
    def build(m):
        return flt.where(m.calls(), cond).agg(
            F.count("*").alias("n"),
            F.coalesce(F.min("call_id"), F.lit(-1)).alias("first_id"),
            F.coalesce(money_sum("revenue"), F.lit(0.0)).alias("revenue"),
        )

    return build


for _suffix, _cond, _predicate in OPERATOR_CASES:
    query(
        f"filter_op_{_suffix}",
        f"""
        SELECT count(*) AS n, coalesce(min(o_orderkey), -1) AS first_id,
          coalesce(CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE), 0) AS revenue
        FROM orders WHERE {_predicate}
        """,
    )(_operator_query(_cond))


@query(
    "date_range",
    f"""SELECT {CALL_SQL} FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1997-03-01'""",
)
def date_range(m):
    return flt.date_range(m.calls(), "start_time", "1996-03-01", "1997-02-28")


@query(
    "sort_multi",
    """
    SELECT o_orderkey AS call_id, o_orderstatus AS status, o_totalprice AS revenue,
      row_number() OVER (ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey) AS place
    FROM orders
    """,
)
def sort_multi(m):
    """The whole sorted list with every row's place in it."""
    return flt.placed(
        m.calls().select("call_id", "status", "revenue"),
        [("status", "asc"), ("revenue", "desc"), ("call_id", "asc")],
    )


@query(
    "page_topk",
    f"""SELECT {CALL_SQL} FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100""",
)
def page_topk(m):
    return flt.page(m.calls(), [("revenue", "desc")], ["call_id"], limit=50, offset=100)


@query(
    "columns_filter",
    """
    SELECT c_nationkey AS campaign_id, count(*) AS calls,
      CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS revenue
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    GROUP BY 1 HAVING count(*) > 500 AND
      CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) > 1e6
    """,
)
def columns_filter(m):
    spec = ReportSpec(
        dimensions=("campaign_id",),
        metrics=(Metric("calls", "count"), Metric("revenue", "sum", "revenue")),
        columns_filter=Tree("and", (Cond("calls", ">", 500), Cond("revenue", ">", 1e6))),
        limit=None,
    )
    rows, merged = preaggregate(m.calls(), spec, ["contact_id"])
    return report_table(rows.join(m.contacts(), "contact_id", "left"), merged)


@query(
    "saved_filter",
    "SELECT o_orderkey AS call_id, o_totalprice AS revenue FROM orders "
    "WHERE o_orderstatus = 'P' AND o_totalprice >= 300000",
)
def saved_filter(m):
    saved = SavedFilters()
    saved.save(
        "big_open", Tree("and", (Cond("status", "=", "P"), Cond("revenue", ">=", 300000.0)))
    )
    return flt.where(m.calls(), saved.get("big_open")).select("call_id", "revenue")


@query(
    "rapid_filter",
    """
    SELECT o_orderpriority AS tag, count(*) AS calls FROM orders
    WHERE o_orderstatus IN ('F', 'O') AND o_totalprice > 150000 GROUP BY 1
    """,
)
def rapid_filter(m):
    spec = ReportSpec(
        dimensions=("tag",),
        metrics=(Metric("calls", "count"),),
        filter=Cond("status", "in", ["F", "O"]),
        rapid_filter=Cond("revenue", ">", 150000.0),
        limit=None,
    )
    return report_table(m.calls(), spec)


@query(
    "entity_ids_semi",
    f"""SELECT {CALL_SQL} FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 50)""",
)
def entity_ids_semi(m):
    ids = m.legs().filter(F.col("duration") >= 50)
    return flt.by_ids(m.calls(), ids, "call_id").select(*CALL_FIELDS)


@query(
    "include_ongoing",
    """
    SELECT include, count(*) AS calls FROM
      (SELECT 'without' AS include FROM orders WHERE NOT o_orderstatus = 'O'
       UNION ALL SELECT 'with' FROM orders) GROUP BY 1
    """,
)
def include_ongoing(m):
    ongoing = F.col("status") == "O"
    parts = [
        flt.include_flag(m.calls(), flag, ongoing).select(F.lit(name).alias("include"))
        for name, flag in (("without", False), ("with", True))
    ]
    return parts[0].unionByName(parts[1]).groupBy("include").agg(F.count("*").alias("calls"))


@query(
    "tenant_scope",
    "SELECT c_custkey AS contact_id, c_name AS contact_name FROM customer WHERE c_nationkey = 7",
)
def tenant_scope(m):
    return flt.for_tenant(m.contacts(), "campaign_id", 7).select("contact_id", "contact_name")
