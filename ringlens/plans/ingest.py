"""Bulk loads over batches derived from the tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from ringlens.operators import ingest as ig
from ringlens.plans.registry import query
from ringlens.session import shared_dir
from ringlens.sources import store as st
from ringlens.sources.model import named


@query(
    "ingest_sessions_dedupe",
    """
    SELECT ext_id, event_id, visitor_id FROM (SELECT user_id || '-' || (event_id % 500) AS ext_id, event_id,
      user_id AS visitor_id FROM events WHERE event_type = 'view')
    WHERE ext_id NOT IN (SELECT user_id || '-' || (event_id % 500) FROM events WHERE event_type = 'error')
    QUALIFY row_number() OVER (PARTITION BY ext_id ORDER BY event_id) = 1
    """,
)
def ingest_sessions_dedupe(m):
    ext = F.concat_ws("-", F.col("visitor_id").cast("string"), (F.col("event_id") % 500).cast("string"))
    rows = m.events().select(ext.alias("ext_id"), "event_id", "visitor_id", "kind")
    batch = rows.filter("kind = 'view'").drop("kind")
    return ig.ingest_sessions(batch, rows.filter("kind = 'error'"), ["event_id"])


def _audit(m):
    """Upload attempts: one per leg, a long answered leg being a success."""
    ok = (F.col("finish_reason") == "A") & (F.col("duration") > 40)
    return m.legs().select(F.col("call_id").alias("ext_id"), ok.alias("ok"))


@query(
    "ingest_calls",
    """
    SELECT o_orderkey AS ext_id, CASE WHEN NOT finish >= o_orderdate THEN 'finish before start' END AS reason
    FROM (SELECT *, o_orderdate + INTERVAL 1 DAY * (o_orderkey % 5 - 1) AS finish FROM orders)
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem GROUP BY 1
      HAVING bool_or(l_returnflag = 'A' AND l_quantity > 40) OR
        count(*) FILTER (WHERE NOT (l_returnflag = 'A' AND l_quantity > 40)) >= 3)
    """,
)
def ingest_calls(m):
    finish = F.expr("start_time + make_interval(0, 0, 0, CAST(call_id % 5 - 1 AS INT))")
    batch = m.calls().select(F.col("call_id").alias("ext_id"), "start_time", finish.alias("finish_time"))
    return ig.ingest_calls(batch, _audit(m)).select("ext_id", "reason")


@query(
    "uploaded_calls",
    """
    SELECT *, CASE WHEN failures < attempts THEN 'loaded' WHEN failures >= 3 THEN 'given up'
      ELSE 'retry' END AS state
    FROM (SELECT l_orderkey AS ext_id, count(*) AS attempts,
      count(*) FILTER (WHERE NOT (l_returnflag = 'A' AND l_quantity > 40)) AS failures
      FROM lineitem GROUP BY 1)
    """,
)
def uploaded_calls(m):
    return ig.upload_status(_audit(m))


def _named_rows(m):
    """Contacts naming an employee: known ones in odd case, and some unknown."""
    return m.contacts().select(
        "contact_id",
        F.expr(
            """CASE WHEN contact_id % 4 = 0 THEN concat('New', contact_id % 30)
            ELSE upper(concat('Supplier#', lpad(CAST(contact_id % 120 AS STRING), 9, '0'))) END"""
        ).alias("employee_name"),
    )


NAMED_SQL = """(SELECT c_custkey AS contact_id, CASE WHEN c_custkey % 4 = 0 THEN 'New' || c_custkey % 30
    ELSE upper('Supplier#' || lpad((c_custkey % 120)::VARCHAR, 9, '0')) END AS employee_name FROM customer)"""


@query(
    "resolve_names",
    f"""SELECT contact_id, coalesce(s_suppkey::VARCHAR, md5(lower(employee_name))) AS resolved_id
    FROM {NAMED_SQL} LEFT JOIN supplier ON lower(s_name) = lower(employee_name)""",
)
def resolve_names(m):
    rows, _ = ig.resolve_names(
        _named_rows(m), "employee_name", m.employees(), "employee_id", "employee_name", False
    )
    return rows.select("contact_id", "resolved_id")


@query(
    "created_names",
    f"""SELECT md5(lower(employee_name)) AS id, min(employee_name) AS name FROM {NAMED_SQL}
    WHERE lower(employee_name) NOT IN (SELECT lower(s_name) FROM supplier) GROUP BY 1""",
)
def created_names(m):
    _, created = ig.resolve_names(
        _named_rows(m), "employee_name", m.employees(), "employee_id", "employee_name", False
    )
    return created


@query(
    "ingest_chats",
    """SELECT conv_id AS chat_id, arg_min(role, turn) AS initiator,
      coalesce(arg_max(conv_id % 9 + turn, turn) FILTER (WHERE role = 'assistant'), -1) AS owner
    FROM conversations GROUP BY 1""",
)
def ingest_chats(m):
    return ig.ingest_chats(m.messages(), F.col("chat_id") % 9 + F.col("turn")).na.fill(-1)


@query(
    "ingest_offline",
    """
    SELECT event_id, CASE WHEN sent IS NULL THEN 'no time' WHEN NOT sent <= TIMESTAMP '2024-01-25'
      THEN 'time in the future' WHEN processed IS NOT NULL AND NOT processed >= sent
      THEN 'processed before sent' END AS reason
    FROM (SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN ts END AS sent,
      CASE WHEN event_id % 3 > 0 THEN ts + INTERVAL 1 HOUR * (user_id % 5 - 1) END AS processed
      FROM events WHERE event_type = 'click')
    """,
)
def ingest_offline(m):
    batch = m.events().filter("kind = 'click'").select(
        "event_id",
        F.expr("CASE WHEN event_id % 13 <> 0 THEN date_time END").alias("sent"),
        F.expr(
            """CASE WHEN event_id % 3 > 0 THEN
            date_time + make_interval(0, 0, 0, 0, CAST(visitor_id % 5 - 1 AS INT)) END"""
        ).alias("processed_at"),
    )
    batch = batch.withColumnRenamed("sent", "date_time")
    now = F.lit("2024-01-25").cast("timestamp_ntz")
    return ig.ingest_offline(batch, now).select("event_id", "reason")


def _emails(m):
    return m.contacts().select(
        F.col("contact_id").alias("ext_id"),
        F.expr("CASE WHEN contact_id % 3 = 0 THEN array(concat('to', contact_id)) END").alias("to"),
        F.expr("CASE WHEN contact_id % 5 = 0 THEN array(concat('a', contact_id), 'b') END").alias("cc"),
        F.expr("CASE WHEN contact_id % 7 = 0 THEN array() ELSE NULL END")
        .cast("array<string>")
        .alias("bcc"),
    )


@query(
    "ingest_emails",
    """SELECT c_custkey AS ext_id, CASE WHEN c_custkey % 3 > 0 AND c_custkey % 5 > 0
    THEN 'no recipient' END AS reason FROM customer""",
)
def ingest_emails(m):
    checked, _ = ig.ingest_emails(_emails(m))
    return checked.select("ext_id", "reason")


@query(
    "email_recipients",
    """SELECT c_custkey AS ext_id, 'to' AS field, 'to' || c_custkey AS address FROM customer WHERE c_custkey % 3 = 0
    UNION ALL SELECT c_custkey, 'cc', 'a' || c_custkey FROM customer WHERE c_custkey % 5 = 0
    UNION ALL SELECT c_custkey, 'cc', 'b' FROM customer WHERE c_custkey % 5 = 0""",
)
def email_recipients(m):
    _, recipients = ig.ingest_emails(_emails(m))
    return recipients


@query(
    "ingest_deals",
    """
    WITH batch AS (SELECT l_orderkey AS ext_id, l_suppkey AS main_contact, l_extendedprice AS amount,
        CASE WHEN l_linenumber <> 7 THEN l_shipdate ELSE TIMESTAMP '2002-01-01' END AS modified
      FROM lineitem WHERE l_suppkey IN (l_partkey % 100, l_suppkey - l_suppkey % 2)),
    stored AS (SELECT o_orderkey AS ext_id, CAST(NULL AS BIGINT) AS main_contact, o_totalprice AS amount,
        o_orderdate AS modified FROM orders)
    SELECT ext_id, max(modified) AS modified,
      count(*) FILTER (WHERE main_contact IS NOT NULL) > 0 AND
        coalesce(max(modified) FILTER (WHERE main_contact IS NOT NULL) >= max(modified), false) AS updated
    FROM (SELECT * FROM batch UNION ALL SELECT * FROM stored) GROUP BY 1
    """,
)
def ingest_deals(m):
    batch = m.legs().select(
        F.col("call_id").alias("ext_id"),
        F.col("employee_id").alias("main_contact"),
        F.expr("array(number_id % 100, employee_id - employee_id % 2)").alias("contacts"),
        F.col("charge").alias("amount"),
        F.expr("CASE WHEN leg_no <> 7 THEN leg_time END").alias("modified"),
    )
    stored = m.calls().select(
        F.col("call_id").alias("ext_id"),
        F.lit(None).cast("long").alias("main_contact"),
        F.lit(None).cast("array<bigint>").alias("contacts"),
        F.col("revenue").alias("amount"),
        F.col("start_time").alias("modified"),
    )
    now = F.lit("2002-01-01").cast("timestamp_ntz")
    return ig.ingest_deals(batch, stored, now).select(
        "ext_id", "modified", F.col("main_contact").isNotNull().alias("updated")
    )


UPLOAD_SQL = """(SELECT o_custkey % 25 AS campaign_id, o_orderdate AS date_from,
    o_orderdate + INTERVAL 1 DAY * (o_orderkey % 4) + INTERVAL 5 HOUR AS date_till,
    CASE WHEN o_orderkey % 6 = 0 THEN 0 ELSE o_totalprice END AS cost, o_orderkey AS upload_id FROM orders)"""


def _uploads(m):
    return m.calls().select(
        (F.col("contact_id") % 25).alias("campaign_id"),
        F.col("start_time").alias("date_from"),
        F.expr("start_time + make_interval(0, 0, 0, CAST(call_id % 4 AS INT), 5)").alias("date_till"),
        F.expr("CASE WHEN call_id % 6 = 0 THEN 0D ELSE revenue END").alias("cost"),
        F.col("call_id").alias("upload_id"),
    )


@query(
    "cost_spread",
    f"""SELECT upload_id, strftime(day, '%Y-%m-%d') AS day, daily_cost FROM (SELECT upload_id,
      cost / (upload_id % 4 + 1) AS daily_cost,
      unnest(generate_series(date_from, date_from + INTERVAL 1 DAY * (upload_id % 4), INTERVAL 1 DAY)) AS day
      FROM {UPLOAD_SQL})""",
)
def cost_spread(m):
    return ig.spread_costs(_uploads(m)).select(
        "upload_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "daily_cost"
    )


ORACLE_COSTS = f"""
    WITH days AS (SELECT campaign_id, upload_id, cost / (upload_id % 4 + 1) AS daily_cost,
        unnest(generate_series(date_from, date_from + INTERVAL 1 DAY * (upload_id % 4), INTERVAL 1 DAY)) AS day
      FROM {UPLOAD_SQL}),
    latest AS (SELECT * FROM days QUALIFY row_number() OVER (PARTITION BY campaign_id, day
      ORDER BY upload_id DESC) = 1),
    stored AS (SELECT DISTINCT l_suppkey % 25 AS campaign_id, l_shipdate AS day, 1.0::DOUBLE AS daily_cost FROM lineitem)
    SELECT campaign_id, strftime(day, '%Y-%m-%d') AS day, daily_cost FROM (
      SELECT campaign_id, day, daily_cost FROM latest WHERE daily_cost <> 0
      UNION ALL SELECT s.* FROM stored s ANTI JOIN latest USING (campaign_id, day))
    """


def _daily_costs(m):
    return m.legs().select(
        (F.col("employee_id") % 25).alias("campaign_id"),
        F.to_date("leg_time").alias("day"),
        F.lit(1.0).alias("daily_cost"),
    ).distinct()


@query("ingest_costs", ORACLE_COSTS)
def ingest_costs(m):
    out = ig.ingest_costs(_uploads(m), _daily_costs(m), ["upload_id"])
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(
    "batch_cap",
    """SELECT event_id, place > 50 AS rejected FROM (SELECT event_id,
      row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events)""",
)
def batch_cap(m):
    rows = m.events().select(F.col("visitor_id").alias("batch"), "event_id")
    return ig.batch_cap(rows, "batch", ["event_id"], 50).select("event_id", "rejected")


@query(
    "apply_tags",
    """
    SELECT * FROM (SELECT l_orderkey AS communication_id, l_returnflag AS tag FROM lineitem WHERE l_quantity > 20
      UNION SELECT l_orderkey, l_returnflag FROM lineitem WHERE l_quantity < 5)
    EXCEPT SELECT l_orderkey, l_returnflag FROM lineitem WHERE l_linestatus = 'O' AND l_quantity > 40
    """,
)
def apply_tags(m):
    links = m.legs().select(
        F.col("call_id").alias("communication_id"),
        F.col("finish_reason").alias("tag"),
        "duration",
        "direction",
    )
    removed = links.filter("direction = 'O' AND duration > 40").select("communication_id", "tag")
    return ig.apply_tags(
        links.filter("duration > 20"), links.filter("duration < 5"), removed.distinct()
    )


@query(
    "apply_sales",
    """
    SELECT l_orderkey AS communication_id, l_linenumber AS sale_no, l_shipdate AS sale_date,
      CASE WHEN o_orderdate IS NULL THEN 'unknown communication'
        WHEN NOT l_shipdate - INTERVAL 30 DAY >= o_orderdate THEN 'sale before communication' END AS reason
    FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 10 <> 0) ON l_orderkey = o_orderkey
    """,
)
def apply_sales(m):
    comms = named(m.calls(), communication_id="call_id", date_time="start_time")
    sales = m.legs().select(
        F.col("call_id").alias("communication_id"),
        F.col("leg_no").alias("sale_no"),
        F.col("leg_time").alias("shown"),
        F.expr("leg_time - INTERVAL 30 DAY").alias("sale_date"),
    )
    known = comms.filter(F.col("communication_id") % 10 != 0)
    return ig.apply_sales(known, sales).select(
        "communication_id", "sale_no", F.col("shown").alias("sale_date"), "reason"
    )


@query(
    "bulk_delete",
    """SELECT conv_id AS chat_id, turn FROM conversations WHERE conv_id NOT IN
    (SELECT conv_id FROM conversations WHERE role = 'system')""",
)
def bulk_delete(m):
    ids = m.messages().filter("role = 'system'")
    return ig.delete_by_ids(m.messages(), ids, "chat_id").select("chat_id", "turn")


STORED_SQL = """(SELECT o_orderkey AS ext_id, o_orderdate AS modified, o_totalprice AS amount, 0 AS version FROM orders
      WHERE o_orderkey % 3 <> 0
    UNION ALL SELECT l_orderkey, max(l_shipdate), sum(l_quantity), 1 FROM lineitem WHERE l_orderkey % 16 < 4 GROUP BY 1)"""


def _deal_updates(m):
    rows = m.legs().filter("call_id % 16 < 4").groupBy(F.col("call_id").alias("ext_id"))
    return rows.agg(
        F.max("leg_time").alias("modified"), F.sum(F.col("duration").cast("double")).alias("amount"), F.lit(1).alias("version")
    )


def _stored_deals(m):
    """Two thirds of the deals stored, then the same upload twice."""
    target = st.by_bucket(shared_dir(m.spark, "deals"), ["ext_id"], 16)
    deals = m.calls().filter("call_id % 3 <> 0").select(
        F.col("call_id").alias("ext_id"), F.col("start_time").alias("modified"), F.col("revenue").alias("amount"),
        F.lit(0).alias("version"),
    )
    st.create(deals, target)
    for _ in range(2):
        st.upsert(_deal_updates(m), target, ["ext_id"], ["modified", "version"])
    return target


@query(
    "stored_deals",
    f"""SELECT * FROM {STORED_SQL}
    QUALIFY row_number() OVER (PARTITION BY ext_id ORDER BY modified DESC, version DESC) = 1""",
)
def stored_deals(m):
    return st.stored(m.spark, _stored_deals(m)).drop("bucket")


@query(
    "stored_deals_deleted",
    f"""SELECT count(*) AS deals, CAST(sum(ext_id) AS BIGINT) AS ids FROM
    (SELECT DISTINCT ext_id FROM {STORED_SQL}) WHERE ext_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""",
)
def stored_deals_deleted(m):
    target = _stored_deals(m)
    ids = m.calls().filter("status = 'P'").select(F.col("call_id").alias("ext_id"))
    st.delete(ids, target, ["ext_id"])
    return st.stored(m.spark, target).agg(F.count("*").alias("deals"), F.sum("ext_id").alias("ids"))


@query("stored_costs", ORACLE_COSTS)
def stored_costs(m):
    """Costs stored by month; the uploads come in two parts, the second of them twice."""
    target = st.by_month(shared_dir(m.spark, "costs"), "day")
    st.create(_daily_costs(m), target)
    uploads = _uploads(m)
    middle = F.lit(uploads.agg(F.expr("percentile_approx(upload_id, 0.5)")).first()[0])
    early, late = uploads.filter(F.col("upload_id") <= middle), uploads.filter(F.col("upload_id") > middle)
    for part in (early, late, late):
        st.upsert_costs(part, target, ["upload_id"])
    return st.stored(m.spark, target).select("campaign_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "daily_cost")
