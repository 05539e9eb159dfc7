"""Join queries."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.functions.numbers import money_sum
from ringlens.operators import conditions as cn
from ringlens.operators import joins as jn
from ringlens.operators.joins import CampaignCondition
from ringlens.plans.aggregates import WIDE_SQL, dsum
from ringlens.plans.registry import query
from ringlens.sources.model import phone

PHONE_SQL = "'7' || lpad(c_custkey::VARCHAR, 10, '0')"


@query(
    "join_broadcast_left",
    f"""
    SELECT s_nationkey AS group_id, p_type AS category, count(*) AS legs,
      {dsum('l_extendedprice')} AS charge
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN part ON l_partkey = p_partkey
    GROUP BY 1, 2
    """,
)
def join_broadcast_left(m):
    legs = m.legs().select("employee_id", "number_id", "charge")
    rows = jn.enrich(
        legs,
        (m.employees(), "employee_id"),
        (m.numbers().select("number_id", "category"), "number_id"),
    )
    return rows.groupBy("group_id", "category").agg(
        F.count("*").alias("legs"), money_sum("charge").alias("charge")
    )


@query(
    "join_calls_legs",
    f"""
    SELECT o_orderstatus AS status, l_returnflag AS finish_reason, count(*) AS legs,
      count(DISTINCT o_orderkey) AS calls, {dsum('l_quantity')} AS duration
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2
    """,
)
def join_calls_legs(m):
    return (
        jn.calls_legs(m.calls(), m.legs())
        .groupBy("status", "finish_reason")
        .agg(
            F.count("*").alias("legs"),
            F.count_distinct("call_id").alias("calls"),
            money_sum("duration").alias("duration"),
        )
    )


@query(
    "person_of_visitor",
    """
    SELECT user_id AS visitor_id, c_name AS contact_name, c_mktsegment AS segment
    FROM (SELECT DISTINCT user_id FROM events) JOIN customer ON user_id = c_custkey
    """,
)
def person_of_visitor(m):
    visitors = m.events().select("visitor_id").distinct()
    return jn.person_of(visitors, m.contacts()).select("visitor_id", "contact_name", "segment")


@query(
    "person_visitors",
    """
    SELECT c_custkey AS contact_id, count(*) AS visits, min(ts) AS first_seen, max(ts) AS last_seen
    FROM customer JOIN events ON user_id = c_custkey WHERE event_type = 'view' GROUP BY 1
    """,
)
def person_visitors(m):
    visits = m.events().filter("kind = 'view'")
    return jn.visitors_of(m.contacts().select("contact_id"), visits).drop("visitor_id")


@query(
    "non_session_anti",
    """
    SELECT o_orderkey AS call_id, o_custkey AS contact_id FROM orders
    WHERE o_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'view')
    """,
)
def non_session_anti(m):
    visits = m.events().filter("kind = 'view'")
    calls = m.calls().select("call_id", "contact_id")
    return jn.without_session(calls, visits, "contact_id", "visitor_id")


def _blacklist(keep):
    def build(m):
        contacts = m.contacts().withColumn("phone", phone(F.col("contact_id")))
        blocked = contacts.filter("balance < 1000")
        calls = m.calls().join(contacts.select("contact_id", "phone"), "contact_id")
        return jn.blacklist(calls, blocked, "phone", keep).select("call_id", "phone")

    return build


for _name, _keep, _test in (("anti", False, ">="), ("semi", True, "<")):
    query(
        f"blacklist_{_name}",
        f"""SELECT o_orderkey AS call_id, {PHONE_SQL} AS phone
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal {_test} 1000""",
    )(_blacklist(_keep))


PREFIXES = [
    ("7", "country"),
    ("70", "region"),
    ("7000000", "city"),
    ("70000001", "district"),
    ("700000004", "exchange"),
    ("70000000012", "block"),
    ("8", "other"),
]


@query(
    "prefix_match",
    f"""
    SELECT c_custkey AS contact_id, arg_max(prefix, length(prefix)) AS prefix,
      arg_max(prefix_name, length(prefix)) AS prefix_name
    FROM customer JOIN (VALUES {', '.join(str(p) for p in PREFIXES)}) p(prefix, prefix_name)
      ON starts_with({PHONE_SQL}, prefix)
    GROUP BY 1
    """,
)
def prefix_match(m):
    prefixes = m.spark.createDataFrame(PREFIXES, "prefix string, prefix_name string")
    contacts = m.contacts().select("contact_id", phone(F.col("contact_id")).alias("phone"))
    return jn.longest_prefix(contacts, "phone", prefixes).drop("phone")


# (schedule id, weekday, minute from, minute till)
SCHEDULE = [(s, d, 540 + 60 * s, 1080) for s in range(3) for d in range(1, 6)] + [
    (0, 6, 600, 720),
    (0, 6, 800, 900),
    (1, 7, 0, 1440),
]


@query(
    "schedule_match",
    f"""
    SELECT event_id, coalesce(bool_or(id IS NOT NULL), false) AS in_schedule
    FROM events LEFT JOIN (VALUES {', '.join(str(s) for s in SCHEDULE)}) s(id, weekday, f, t)
      ON id = user_id % 4 AND weekday = isodow(ts)
      AND hour(ts) * 60 + minute(ts) >= f AND hour(ts) * 60 + minute(ts) < t
    GROUP BY 1
    """,
)
def schedule_match(m):
    schedule = m.spark.createDataFrame(
        SCHEDULE, "schedule_id long, weekday int, minute_from int, minute_till int"
    )
    rows = m.events().withColumn("schedule_id", F.col("visitor_id") % 4)
    return jn.in_schedule(rows, "date_time", "schedule_id", schedule).select(
        "event_id", "in_schedule"
    )


CONDITIONS = [
    CampaignCondition(1, "utm_source", "=", "feed"),
    CampaignCondition(2, "host", "sub", "blog."),
    CampaignCondition(3, "path", "~", "^/en/[0-9]+$"),
    CampaignCondition(3, "host", "sub", ".org"),
    CampaignCondition(4, "page", "=", "2"),
    CampaignCondition(4, "host", "~", "^(www|m)[.]"),
]
VISIT_SQL = """(SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
    regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path,
    nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS utm_source,
    nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page,
    page_id % 5 AS site_id FROM pages)"""


def _visits(m):
    from ringlens.functions.urls import query_value, url_part

    return m.pages().select(
        "page_id",
        url_part("url", "HOST").alias("host"),
        url_part("url", "PATH").alias("path"),
        query_value("url", "utm_source").alias("utm_source"),
        query_value("url", "page").alias("page"),
        (F.col("page_id") % 5).alias("site_id"),
    )


MATCH_SQL = {
    1: ["coalesce(utm_source = 'feed', false)"],
    2: ["contains(host, 'blog.')"],
    3: ["regexp_matches(path, '^/en/[0-9]+$')", "contains(host, '.org')"],
    4: ["coalesce(page = '2', false)", "regexp_matches(host, '^(www|m)[.]')"],
}


@query(
    "campaign_match",
    " UNION ALL ".join(
        f"SELECT page_id, {c} AS campaign_id FROM {VISIT_SQL} WHERE {' AND '.join(t)}"
        for c, t in MATCH_SQL.items()
    ),
)
def campaign_match(m):
    return jn.assign_campaign(_visits(m), CONDITIONS).select("page_id", "campaign_id")


# (site, parameter, weight)
WEIGHTS = [
    (s, p, (s * 3 + i * 2) % 7 + 1)
    for s in range(5)
    for i, p in enumerate(("utm_source", "host", "path", "page"))
]


def _score_sql():
    weight = {(s, p): w for s, p, w in WEIGHTS}

    def term(parameter, test):
        case = " ".join(f"WHEN {s} THEN {weight[s, parameter]}" for s in range(5))
        return f"CASE WHEN {test} THEN CASE site_id {case} END ELSE 0 END"

    parameters = {1: ["utm_source"], 2: ["host"], 3: ["path", "host"], 4: ["page", "host"]}
    parts = [
        f"SELECT page_id, {c} AS campaign_id, "
        + " + ".join(term(p, t) for p, t in zip(parameters[c], tests))
        + f" AS score FROM {VISIT_SQL}"
        for c, tests in MATCH_SQL.items()
    ]
    return f"""
    SELECT page_id, score, CASE WHEN score > 0 THEN campaign_id ELSE -1 END AS campaign_id FROM (
      SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, campaign_id) AS rn
      FROM ({' UNION ALL '.join(parts)})) WHERE rn = 1
    """


@query("campaign_score", _score_sql())
def campaign_score(m):
    weights = m.spark.createDataFrame(WEIGHTS, "site_id long, parameter string, weight int")
    scored = jn.score_campaign(_visits(m), CONDITIONS, weights)
    return scored.select("page_id", "score", "campaign_id").na.fill(-1)


# campaigns whose conditions lie in a table: one for each nation, and one for each host
CONDITION_SQL = f"""
WITH visit AS {VISIT_SQL},
host AS (SELECT host, min(page_id) AS first_page FROM visit WHERE host IS NOT NULL GROUP BY 1),
cond AS (
  SELECT n_nationkey AS campaign_id, 'host' AS parameter, 'sub' AS operator,
    CASE n_nationkey % 5 WHEN 0 THEN 'blog.' WHEN 1 THEN 'm.' WHEN 2 THEN '.org' WHEN 3 THEN 'the' ELSE 'e' END AS value
  FROM nation
  UNION ALL SELECT n_nationkey, 'path', '~', '^/(en|fr)/[0-9]*' || (n_nationkey % 10) || '([.]html)?/?$'
  FROM nation WHERE n_nationkey % 3 = 0
  UNION ALL SELECT n_nationkey, 'path', 'sub', '/' || (n_nationkey % 9 + 1) FROM nation WHERE n_nationkey % 3 = 1
  UNION ALL SELECT n_nationkey, 'utm_source', '=', 'feed' FROM nation WHERE n_nationkey % 3 = 2
  UNION ALL SELECT 1000000 + first_page, 'host', '=', host FROM host),
hit AS (
  SELECT page_id, site_id, campaign_id, c.parameter, operator, value,
    CASE operator WHEN '=' THEN v.text = value WHEN 'sub' THEN contains(v.text, value)
      ELSE regexp_matches(v.text, value) END AS holds
  FROM cond c JOIN (
    SELECT page_id, site_id, 'host' AS parameter, host AS text FROM visit
    UNION ALL SELECT page_id, site_id, 'path', path FROM visit
    UNION ALL SELECT page_id, site_id, 'utm_source', utm_source FROM visit) v USING (parameter))"""


def _condition_table(m):
    k = F.col("campaign_id").cast("long")
    nations = m.campaigns().select(k.alias("campaign_id"))
    part = F.element_at(F.array(*[F.lit(x) for x in ("blog.", "m.", ".org", "the", "e")]), (F.col("campaign_id") % 5 + 1).cast("int"))
    hosts = _visits(m).filter("host IS NOT NULL").groupBy("host").agg(F.min("page_id").alias("first_page"))

    def rows(frame, parameter, operator, value):
        return frame.select("campaign_id", F.lit(parameter).alias("parameter"), F.lit(operator).alias("operator"), value.alias("value"))

    digit = lambda n, more: (F.col("campaign_id") % n + more).cast("string")
    pattern = F.concat(F.lit("^/(en|fr)/[0-9]*"), digit(10, 0), F.lit("([.]html)?/?$"))
    return reduce(
        DataFrame.unionByName,
        [
            rows(nations, "host", "sub", part),
            rows(nations.filter("campaign_id % 3 = 0"), "path", "~", pattern),
            rows(nations.filter("campaign_id % 3 = 1"), "path", "sub", F.concat(F.lit("/"), digit(9, 1))),
            rows(nations.filter("campaign_id % 3 = 2"), "utm_source", "=", F.lit("feed")),
            rows(hosts.withColumn("campaign_id", F.col("first_page") + 1000000), "host", "=", F.col("host")),
        ],
    )


@query(
    "campaign_match_table",
    f"""{CONDITION_SQL}
    SELECT page_id, campaign_id FROM (
      SELECT page_id, campaign_id, count(*) FILTER (WHERE holds) AS met FROM hit GROUP BY 1, 2)
    JOIN (SELECT campaign_id, count(*) AS n FROM cond GROUP BY 1) USING (campaign_id) WHERE met = n
    """,
)
def campaign_match_table(m):
    return cn.assign_campaigns(_visits(m), "page_id", _condition_table(m))


@query(
    "campaign_score_table",
    f"""{CONDITION_SQL},
    scored AS (
      SELECT page_id, campaign_id, sum(((site_id * 3 + CASE parameter WHEN 'utm_source' THEN 0 WHEN 'host' THEN 2
        ELSE 4 END) % 7 + 1) * holds::INT) AS score FROM hit GROUP BY 1, 2),
    best AS (SELECT page_id, max(score) AS score, arg_min(campaign_id, (-score, campaign_id)) AS campaign_id
      FROM scored WHERE score > 0 GROUP BY 1)
    SELECT v.page_id, coalesce(score, 0)::BIGINT AS score, coalesce(campaign_id, -1) AS campaign_id
    FROM visit v LEFT JOIN best USING (page_id)
    """,
)
def campaign_score_table(m):
    weights = m.spark.createDataFrame(WEIGHTS, "site_id long, parameter string, weight int")
    scored = cn.score_campaigns(_visits(m), "page_id", _condition_table(m), weights)
    return scored.na.fill(-1, ["campaign_id"])


# (stage, order, name)
STAGES = [("O", 1, "new"), ("P", 2, "in progress"), ("F", 3, "closed")]


@query(
    "deal_stage",
    f"""
    SELECT o_orderkey AS deal_id, stage_order, stage_name FROM orders
    LEFT JOIN (VALUES {', '.join(str(s) for s in STAGES)}) s(stage, stage_order, stage_name)
      ON o_orderstatus = stage
    """,
)
def deal_stage(m):
    stages = m.spark.createDataFrame(STAGES, "status string, stage_order int, stage_name string")
    return jn.with_stage(m.calls(), stages, ["status"]).select(
        F.col("call_id").alias("deal_id"), "stage_order", "stage_name"
    )


@query(
    "report_transfer",
    f"""
    SELECT c_custkey AS contact_id, c_name AS contact_name FROM customer WHERE c_custkey IN (
      SELECT o_custkey FROM {WIDE_SQL} WHERE r_name = 'ASIA' AND o_orderpriority = '2-HIGH')
    """,
)
def report_transfer(m):
    ids = jn.transfer(m.calls_wide(), {"site_name": "ASIA", "tag": "2-HIGH"}, "contact_id")
    return m.contacts().join(ids, "contact_id", "left_semi").select("contact_id", "contact_name")


@query(
    "group_members",
    """
    SELECT n_name AS group_name, s_suppkey AS employee_id FROM
      (SELECT s_suppkey, s_nationkey AS g FROM supplier
       UNION SELECT s_suppkey, s_suppkey % 7 FROM supplier)
    JOIN nation ON g = n_nationkey
    """,
)
def group_members(m):
    own = m.employees().withColumn(
        "groups", F.array(F.col("group_id").cast("long"), F.col("employee_id") % 7)
    )
    groups = m.campaigns().select(
        F.col("campaign_id").cast("long").alias("group_id"), F.col("campaign_name").alias("group_name")
    )
    return jn.group_members(own.select("employee_id", "groups"), "groups", groups).select(
        "group_name", "employee_id"
    )
