"""Dictionary lists, trees, filter values and free numbers."""
from __future__ import annotations

from pyspark.sql import functions as F

from ringlens.operators import lists as ls
from ringlens.plans.registry import query
from ringlens.sources.model import named, phone


@query(
    "list_campaigns",
    """SELECT n_nationkey AS campaign_id, n_name AS campaign_name, r_name AS site_name
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def list_campaigns(m):
    table = m.campaigns().join(m.sites(), "site_id", "left")
    return ls.dim_list(table, "campaign_id", ["campaign_id", "campaign_name", "site_name"])


@query(
    "list_employees",
    """SELECT s_suppkey AS employee_id, s_name AS employee_name, n_name AS group_name
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def list_employees(m):
    groups = named(m.campaigns(), group_id="campaign_id", group_name="campaign_name")
    return ls.dim_list(
        m.employees().join(groups, "group_id", "left"),
        "employee_id",
        ["employee_id", "employee_name", "group_name"],
        sort=[("employee_name", "desc")],
    )


@query(
    "list_contacts",
    """SELECT c_custkey AS contact_id, c_name AS contact_name, c_mktsegment AS segment FROM customer""",
)
def list_contacts(m):
    return ls.dim_list(
        m.contacts(),
        "contact_id",
        ["contact_id", "contact_name", "segment"],
    )


@query(
    "list_numbers",
    """SELECT p_partkey AS number_id, p_name AS number_name, p_type AS category, p_retailprice AS charge
    FROM part""",
)
def list_numbers(m):
    return ls.dim_list(
        m.numbers(),
        "number_id",
        ["number_id", "number_name", "category", "charge"],
    )


@query("list_tags", "SELECT o_orderpriority AS tag_name, count(*) AS used FROM orders GROUP BY 1")
def list_tags(m):
    tags = m.calls().groupBy(F.col("tag").alias("tag_name")).agg(F.count("*").alias("used"))
    return ls.dim_list(tags, "tag_name", sort=[("used", "desc")])


@query(
    "list_customers",
    """SELECT c_custkey AS customer_id, c_name AS customer_name, c_acctbal AS balance,
    c_mktsegment AS tariff FROM customer""",
)
def list_customers(m):
    table = named(
        m.contacts(),
        customer_id="contact_id",
        customer_name="contact_name",
        balance="balance",
        tariff="segment",
    )
    return ls.dim_list(table, "customer_id", sort=[("balance", "desc")])


@query(
    "tree_paths",
    """
    SELECT 'r' || r_regionkey AS id, r_name AS path, 0 AS depth FROM region
    UNION ALL SELECT 'n' || n_nationkey, r_name || ' / ' || n_name, 1 FROM nation
      JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT 's' || s_suppkey, r_name || ' / ' || n_name || ' / ' || s_name, 2 FROM supplier
      JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT 'c' || c_custkey, r_name || ' / ' || n_name || ' / ' || s_name || ' / ' || c_name, 3
      FROM customer JOIN supplier ON s_suppkey = c_custkey % 10
      JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT * FROM (VALUES ('x1', NULL, NULL), ('x2', NULL, NULL), ('x3', 'lone', 0))
    """,
)
def tree_paths(m):
    def node(df, ident, name, parent=None):
        prefix, key = ident
        above = F.lit(None).cast("string")
        if parent:
            above = F.concat(F.lit(parent[0]), F.col(parent[1]).cast("string"))
        return df.select(
            F.concat(F.lit(prefix), F.col(key).cast("string")).alias("id"),
            above.alias("parent_id"),
            F.col(name).alias("name"),
        )

    # customers as a fourth level, two nodes in a circle, one whose parent is unknown
    served = m.contacts().withColumn("served_by", F.col("contact_id") % 10)
    circle = m.spark.createDataFrame(
        [("x1", "x2", "a"), ("x2", "x1", "b"), ("x3", "nobody", "lone")], "id string, parent_id string, name string"
    )
    nodes = (
        node(m.sites(), ("r", "site_id"), "site_name")
        .unionByName(node(m.campaigns(), ("n", "campaign_id"), "campaign_name", ("r", "site_id")))
        .unionByName(node(m.employees(), ("s", "employee_id"), "employee_name", ("n", "group_id")))
        .unionByName(node(served, ("c", "contact_id"), "contact_name", ("s", "served_by")))
        .unionByName(circle)
    )
    return ls.tree(nodes)


@query("filter_values", "SELECT p_brand AS value, count(*) AS n FROM part GROUP BY 1")
def filter_values(m):
    return ls.filter_values(m.numbers(), "brand")


@query(
    "available_except",
    """SELECT p_partkey AS number_id FROM part
    WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 47)""",
)
def available_except(m):
    used = m.legs().filter("duration > 47")
    return ls.available(m.numbers().select("number_id"), used, "number_id")


@query(
    "list_lines",
    """SELECT s_suppkey AS line_id, '7' || lpad(s_suppkey::VARCHAR, 10, '0') AS phone, s_suppkey AS employee_id,
      s_name AS employee_name, n_nationkey AS group_id, n_name AS group_name
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def list_lines(m):
    """Lines with the employee and the group they belong to, a line for each employee."""
    groups = named(m.campaigns(), group_id="campaign_id", group_name="campaign_name")
    lines = m.employees().withColumns({"line_id": F.col("employee_id"), "phone": phone(F.col("employee_id"))})
    fields = ["line_id", "phone", "employee_id", "employee_name", "group_id", "group_name"]
    return ls.dim_list(lines.join(groups, "group_id", "left"), "line_id", fields)


@query(
    "list_scenarios",
    """SELECT p_brand AS scenario_name, p_type AS category, count(*) AS numbers FROM part GROUP BY 1, 2""",
)
def list_scenarios(m):
    """Scenarios with their categories: the nested group as rows of its own."""
    rows = m.numbers().groupBy(F.col("brand").alias("scenario_name"), "category").agg(F.count("*").alias("numbers"))
    return ls.dim_list(rows, "scenario_name")


@query(
    "list_schedules",
    """SELECT c_nationkey AS campaign_id, isodow(o_orderdate) - 1 AS weekday, min(hour(o_orderdate)) AS hour_from,
      max(hour(o_orderdate)) AS hour_till FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def list_schedules(m):
    """Hours of each weekday in which a campaign is called: the schedule as rows."""
    calls = m.calls().join(m.contacts(), "contact_id")
    hour = F.hour("start_time")
    rows = calls.groupBy("campaign_id", F.weekday("start_time").cast("long").alias("weekday")).agg(
        F.min(hour).cast("long").alias("hour_from"), F.max(hour).cast("long").alias("hour_till")
    )
    return ls.dim_list(rows, "campaign_id")


@query(
    "list_funnels",
    """SELECT o_orderpriority AS funnel, o_orderstatus AS stage, count(*) AS deals FROM orders GROUP BY 1, 2""",
)
def list_funnels(m):
    """Sales funnels with their stages, a stage a row."""
    rows = m.calls().groupBy(F.col("tag").alias("funnel"), F.col("status").alias("stage")).agg(F.count("*").alias("deals"))
    return ls.dim_list(rows, "funnel")


@query(
    "list_fields",
    """SELECT event_type AS kind, field, count(*) AS used
    FROM (SELECT event_type, unnest(json_keys(props)) AS field FROM events) GROUP BY 1, 2""",
)
def list_fields(m):
    """Fields that messages and deals of each kind carry, and how many do."""
    named_fields = F.explode(F.json_object_keys("properties")).alias("field")
    rows = m.events().select("kind", named_fields).groupBy("kind", "field").agg(F.count("*").alias("used"))
    return ls.dim_list(rows, "field")


@query(
    "visitor_card",
    """SELECT user_id AS visitor_id, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS events,
      count(DISTINCT event_type) AS kinds FROM events GROUP BY 1""",
)
def visitor_card(m):
    """What a visitor's card shows: first and last event, their number and kinds."""
    card = m.events().groupBy("visitor_id", "kind").agg(
        F.min("date_time").alias("first"), F.max("date_time").alias("last"), F.count("*").alias("n")
    )
    rows = card.groupBy("visitor_id").agg(
        F.min("first").alias("first_seen"), F.max("last").alias("last_seen"),
        F.sum("n").alias("events"), F.count("kind").alias("kinds"),
    )
    return ls.dim_list(rows, "visitor_id")
