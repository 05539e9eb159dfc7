"""Window queries over the event stream."""
from __future__ import annotations

from pyspark.sql import functions as F

from ringlens.operators import windows as wn
from ringlens.plans.registry import query

ORDER = "PARTITION BY user_id ORDER BY ts, event_id"
# whole seconds between two timestamps
SECONDS = "CAST(floor(epoch_us({b}) / 1000000.0 - epoch_us({a}) / 1000000.0) AS BIGINT)"


def secs(a, b):
    return f"((epoch_us({b}) - epoch_us({a})) // 1000000)"


def campaign(properties="properties"):
    """Campaign of a visit on the sample data: the counter in its properties."""
    return (F.get_json_object(properties, "$.k").cast("int") % 25).alias("campaign_id")


CAMPAIGN_SQL = "CAST(json_extract(props, '$.k') AS INTEGER) % 25"


@query(
    "communication_number",
    f"""SELECT event_id, user_id AS visitor_id, row_number() OVER ({ORDER}) AS communication_number
    FROM events WHERE event_type <> 'view'""",
)
def communication_number(m):
    comms = m.events().filter("kind <> 'view'").select("event_id", "visitor_id", "date_time")
    return wn.communication_number(comms).drop("date_time")


@query(
    "running_visits",
    f"""SELECT event_id, visits_count FROM (
      SELECT event_id, event_type,
        count(*) FILTER (WHERE event_type = 'view') OVER ({ORDER}) AS visits_count
      FROM events) WHERE event_type <> 'view'""",
)
def running_visits(m):
    events = m.events().select("event_id", "visitor_id", "date_time", "kind")
    return wn.visits_count(events, F.col("kind") == "view").select("event_id", "visits_count")


@query(
    "first_campaign",
    f"""
    SELECT *, campaign_id <> first_campaign_id AS other_campaign FROM (
      SELECT event_id, {CAMPAIGN_SQL} AS campaign_id,
        first({CAMPAIGN_SQL}) OVER ({ORDER}) AS first_campaign_id
      FROM events WHERE event_type = 'view')
    """,
)
def first_campaign(m):
    visits = m.events().filter("kind = 'view'")
    visits = visits.select("event_id", "visitor_id", "date_time", campaign())
    return wn.first_campaign(visits, "campaign_id").drop("visitor_id", "date_time")


@query(
    "first_last_employee",
    """
    SELECT l_orderkey AS call_id,
      arg_min(l_suppkey, (l_shipdate, l_linenumber, l_suppkey)) AS first_employee_id,
      arg_max(l_suppkey, (l_shipdate, l_linenumber, l_suppkey)) AS last_employee_id
    FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1
    """,
)
def first_last_employee(m):
    return wn.call_employees(m.legs(), F.col("finish_reason") != "N")


@query(
    "stage_before_failure",
    f"""SELECT event_id, stage_before FROM (SELECT event_id, event_type,
      lag(event_type) OVER ({ORDER}) AS stage_before FROM events) WHERE event_type = 'error'""",
)
def stage_before_failure(m):
    history = m.events().select("event_id", "visitor_id", "date_time", "kind")
    return wn.stage_before_failure(history, "kind", "error").select("event_id", "stage_before")


@query(
    "latest_state",
    """SELECT user_id AS visitor_id, arg_max(event_type, (ts, event_id)) AS kind,
      max(ts) AS date_time FROM events GROUP BY 1""",
)
def latest_state(m):
    return wn.latest_state(m.events(), "visitor_id", "kind", ["date_time", "event_id"])


@query(
    "lost_call_reaction",
    f"""
    SELECT event_id, coalesce({secs('ts', 'nxt')}, -1) AS reaction FROM (
      SELECT event_id, event_type, ts, min(CASE WHEN event_type = 'click' THEN ts END) OVER
        ({ORDER} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM events)
    WHERE event_type = 'error'
    """,
)
def lost_call_reaction(m):
    events = m.events().select("event_id", "visitor_id", "date_time", "kind")
    return wn.lost_call_reaction(
        events, F.col("kind") == "error", F.col("kind") == "click"
    ).select("event_id", "reaction").na.fill(-1)


GAP = 6 * 3600


@query(
    "hit_durations",
    f"""
    SELECT event_id, CASE WHEN s <= {GAP} THEN s ELSE -1 END AS duration FROM (
      SELECT event_id, {secs('ts', f'lead(ts) OVER ({ORDER})')} AS s FROM events)
    """,
)
def hit_durations(m):
    hits = m.events().select("event_id", "visitor_id", "date_time")
    return wn.hit_durations(hits, GAP).select("event_id", "duration").na.fill(-1)


@query(
    "chat_answer_wait",
    """
    SELECT chat_id, coalesce(asked, -1) AS asked, coalesce(answered, -1) AS answered,
      coalesce(answered - asked, -1) AS wait FROM (SELECT conv_id AS chat_id,
      min(turn) FILTER (WHERE role = 'user') AS asked,
      min(turn) FILTER (WHERE role = 'assistant') AS answered
      FROM conversations GROUP BY 1)
    """,
)
def chat_answer_wait(m):
    return wn.answer_wait(m.messages()).na.fill(-1)
