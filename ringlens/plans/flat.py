"""Row-level reports and statistics."""
from __future__ import annotations

from pyspark.sql import functions as F

from ringlens.functions.numbers import money_sum
from ringlens.operators import filters as flt
from ringlens.operators import flat as fl
from ringlens.operators import sessions as ss
from ringlens.operators import transcripts as tr
from ringlens.operators import windows as wn
from ringlens.operators.windows import seconds_between
from ringlens.plans.aggregates import WIDE_SQL, dsum
from ringlens.plans.registry import query
from ringlens.plans.windows import CAMPAIGN_SQL, GAP, ORDER, campaign, secs
from ringlens.session import shared_dir
from ringlens.sources import store as st
from ringlens.sources.model import named


@query(
    "calls_report",
    f"""
    SELECT o_orderkey AS call_id, o_orderdate AS start_time, o_orderstatus AS status,
      c_name AS contact_name, n_name AS campaign_name, r_name AS site_name,
      coalesce(legs, -1) AS legs, coalesce(total_duration, -1) AS total_duration, coalesce(is_lost, false) AS is_lost
    FROM {WIDE_SQL} LEFT JOIN (SELECT l_orderkey, count(*) AS legs, {dsum('l_quantity')} AS total_duration,
      bool_or(l_returnflag = 'R') AS is_lost FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
    WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
    """,
)
def calls_report(m):
    calls = flt.date_range(m.calls_wide(), "start_time", "1997-01-01", "1997-12-31")
    fields = [
        "call_id", "start_time", "status", "contact_name", "campaign_name", "site_name",
        "legs", "total_duration", "is_lost",
    ]
    rows = flt.select_fields(fl.calls_report(calls, m.legs()), fields)
    return rows.na.fill(-1).na.fill(False)


@query(
    "call_legs_report",
    """
    SELECT l_orderkey AS call_id, l_linenumber AS leg_no, l_shipdate AS leg_time,
      l_returnflag AS finish_reason, o_orderstatus AS status, s_name AS employee_name
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey
    """,
)
def call_legs_report(m):
    return fl.call_legs_report(m.legs(), m.calls(), m.employees()).select(
        "call_id", "leg_no", "leg_time", "finish_reason", "status", "employee_name"
    )


@query(
    "financial_legs",
    """
    SELECT l_orderkey AS call_id, l_linenumber AS leg_no, minutes, CAST(bonus AS DOUBLE) AS bonus,
      CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * minutes - bonus AS DOUBLE) AS total_charge
    FROM (SELECT *, CAST(ceil(l_quantity * 7 / 60) AS INTEGER) AS minutes,
      CAST(l_extendedprice * l_discount AS DECIMAL(18,4)) AS bonus FROM lineitem)
    """,
)
def financial_legs(m):
    # the sample durations are short, so they are stretched to span several minutes
    legs = m.legs().withColumn("duration", F.col("duration") * 7)
    return fl.financial_legs(legs).select("call_id", "leg_no", "minutes", "bonus", "total_charge")


@query(
    "chats_report",
    """
    SELECT conv_id AS chat_id, count(*) AS messages,
      count(*) FILTER (WHERE role = 'user') AS visitor_messages,
      count(*) FILTER (WHERE role = 'assistant') AS operator_messages,
      arg_min(length(text), (turn, text)) FILTER (WHERE role = 'user') AS first_text_length
    FROM conversations GROUP BY 1
    """,
)
def chats_report(m):
    return fl.chats_report(m.messages())


@query(
    "chat_messages",
    """SELECT conv_id AS chat_id, turn, role, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place FROM conversations""",
)
def chat_messages(m):
    return fl.chat_messages(m.messages())


def _of_kind(m, kind):
    return m.events().filter(F.col("kind") == kind)


for _name, _kind, _label in (
    ("offline_messages", "click", "message_id"),
    ("goals_report", "signup", "goal_id"),
):

    def _build(m, kind=_kind, label=_label):
        rows = _of_kind(m, kind).join(
            m.contacts(), F.col("visitor_id") == F.col("contact_id"), "left"
        )
        return rows.join(m.campaigns(), "campaign_id", "left").select(
            F.col("event_id").alias(label), "date_time", "contact_name", "campaign_name", "amount"
        )

    query(
        _name,
        f"""
        SELECT event_id AS {_label}, ts AS date_time, c_name AS contact_name, n_name AS campaign_name,
          value AS amount FROM events LEFT JOIN customer ON user_id = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey WHERE event_type = '{_kind}'
        """,
    )(_build)


SESSION_CTE = f"""
WITH hit AS (SELECT *, CASE WHEN prev IS NULL OR {secs('prev', 'ts')} > {GAP} THEN 1 ELSE 0 END AS fresh
    FROM (SELECT *, lag(ts) OVER ({ORDER}) AS prev FROM events)),
numbered AS (SELECT *, sum(fresh) OVER ({ORDER}) AS session_no FROM hit)"""


@query(
    "session_hits",
    f"{SESSION_CTE} SELECT event_id, user_id AS visitor_id, CAST(session_no AS BIGINT) AS session_no FROM numbered",
)
def session_hits(m):
    hits = m.events().select("event_id", "visitor_id", "date_time")
    return wn.sessionize(hits, GAP).drop("date_time")


@query(
    "visitor_sessions",
    f"""{SESSION_CTE} SELECT visitor_id, CAST(session_no AS BIGINT) AS session_no, start_time, end_time, hits,
      entrance, exit, {secs('start_time', 'end_time')} AS duration FROM (
      SELECT user_id AS visitor_id, session_no, min(ts) AS start_time, max(ts) AS end_time, count(*) AS hits,
        arg_min(event_type, (ts, event_id)) AS entrance, arg_max(event_type, (ts, event_id)) AS exit
      FROM numbered GROUP BY 1, 2)""",
)
def visitor_sessions(m):
    hits = m.events().select("event_id", "visitor_id", "date_time", "kind")
    return fl.visitor_sessions(wn.sessionize(hits, GAP))


# hits open sessions; purchases and errors are the communications of the sample data
HIT_KINDS, COMM_KINDS = ("view", "click"), ("purchase", "error")
SESSION_ROWS = f"""
WITH line AS (
  SELECT event_id, user_id AS visitor_id, ts, event_type, value, event_type IN {HIT_KINDS} AS is_hit,
    CASE WHEN event_type IN {HIT_KINDS} THEN ts END AS hit_ts,
    CASE WHEN event_type IN {HIT_KINDS} THEN 0 ELSE 1 END AS side
  FROM events WHERE event_type IN {HIT_KINDS + COMM_KINDS}),
seen AS (
  SELECT *, max(hit_ts) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev,
    min(hit_ts) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt
  FROM line WINDOW w AS (PARTITION BY visitor_id ORDER BY ts, side, event_id)),
opened AS (
  SELECT *, is_hit AND (prev IS NULL OR {secs('prev', 'ts')} > {GAP}) AS opens,
    is_hit OR coalesce({secs('prev', 'ts')} <= {GAP}, false) AS inside FROM seen),
carried AS (
  SELECT *, sum(opens::INT) OVER w AS no, max(CASE WHEN opens THEN ts END) OVER w AS start
  FROM opened WINDOW w AS (PARTITION BY visitor_id ORDER BY ts, side, event_id ROWS UNBOUNDED PRECEDING)),
numbered AS (
  SELECT *, CASE WHEN inside THEN no::BIGINT END AS session_no, CASE WHEN inside THEN start END AS session_start,
    CASE WHEN is_hit AND {secs('ts', 'nxt')} <= {GAP} THEN {secs('ts', 'nxt')} END AS hit_duration
  FROM carried),
sessions AS (
  SELECT visitor_id, session_no, min(ts) AS start_time, max(hit_ts) AS end_time,
    count(*) FILTER (WHERE is_hit) AS hits_count, count(*) FILTER (WHERE NOT is_hit) AS communications_count,
    arg_min(event_id, (ts, event_id)) FILTER (WHERE is_hit) AS entrance_id,
    arg_max(event_id, (ts, event_id)) FILTER (WHERE is_hit) AS exit_id
  FROM numbered WHERE session_no IS NOT NULL GROUP BY 1, 2)"""


def _streams(m):
    events = m.events().select("event_id", "visitor_id", "date_time", "kind", "amount")
    hits = events.filter(F.col("kind").isin(*HIT_KINDS)).drop("amount")
    return hits, events.filter(F.col("kind").isin(*COMM_KINDS))


@query(
    "session_communications",
    f"""{SESSION_ROWS}
    SELECT event_id, visitor_id, event_type AS kind, coalesce(session_no, -1) AS session_no,
      coalesce({secs('session_start', 'ts')}, -1) AS seconds_in
    FROM numbered WHERE NOT is_hit""",
)
def session_communications(m):
    rows = ss.session_rows(*_streams(m), GAP).filter("NOT is_hit")
    return rows.select(
        "event_id", "visitor_id", "kind", "session_no",
        seconds_between("session_start", "date_time").alias("seconds_in"),
    ).na.fill(-1)


@query(
    "session_summary",
    f"""{SESSION_ROWS}
    SELECT *, {secs('start_time', 'end_time')} AS duration FROM sessions""",
)
def session_summary(m):
    return ss.session_summary(ss.session_rows(*_streams(m), GAP))


@query(
    "visitor_sessions_nested",
    f"""{SESSION_ROWS},
    page AS (
      SELECT * FROM sessions ORDER BY communications_count DESC, start_time DESC, visitor_id, session_no
      LIMIT 50 OFFSET 10),
    lists AS (
      SELECT visitor_id, session_no,
        string_agg(event_id || ':' || event_type || ':' || coalesce(hit_duration, -1), ',' ORDER BY ts, event_id)
          FILTER (WHERE is_hit) AS hits,
        string_agg(event_id || ':' || event_type, ',' ORDER BY ts, event_id) FILTER (WHERE NOT is_hit) AS communications
      FROM numbered WHERE session_no IS NOT NULL GROUP BY 1, 2)
    SELECT visitor_id, session_no, start_time, hits_count, communications_count, hits,
      coalesce(communications, '') AS communications, coalesce(c_mktsegment, '') AS segments
    FROM page JOIN lists USING (visitor_id, session_no) LEFT JOIN customer ON c_custkey = visitor_id""",
)
def visitor_sessions_nested(m):
    segments = m.contacts().select(F.col("contact_id").alias("visitor_id"), F.col("segment").alias("segment_name"))
    page = ss.nested_page(
        *_streams(m), segments, GAP, [("communications_count", "desc"), ("start_time", "desc")], 50, 10,
        hit_fields=("event_id", "kind", "hit_duration"), comm_fields=("event_id", "kind"),
    )
    hit = lambda h: F.concat_ws(":", h["event_id"], h["kind"], F.coalesce(h["hit_duration"], F.lit(-1)))
    comm = lambda c: F.concat_ws(":", c["event_id"], c["kind"])
    return page.select(
        "visitor_id", "session_no", "start_time", "hits_count", "communications_count",
        F.array_join(F.transform("hits", hit), ",").alias("hits"),
        F.array_join(F.transform("communications", comm), ",").alias("communications"),
        F.array_join("segments", ",").alias("segments"),
    )


@query(
    "visits_list",
    f"""SELECT event_id AS visit_id, ts AS date_time, user_id AS visitor_id, {CAMPAIGN_SQL} AS campaign_id
    FROM events WHERE event_type = 'view' AND ts >= TIMESTAMP '2024-01-03'
      AND ts < TIMESTAMP '2024-02-02'""",
)
def visits_list(m):
    rows = flt.date_range(
        _of_kind(m, "view"), "date_time", "2024-01-03", "2024-02-01", max_days=31
    )
    return rows.select(F.col("event_id").alias("visit_id"), "date_time", "visitor_id", campaign())


@query(
    "communications_union",
    """
    SELECT 'call' AS communication_type, o_orderkey AS id, o_custkey AS contact_id, o_orderdate AS date_time
      FROM orders
    UNION ALL SELECT 'goal', event_id, user_id, ts FROM events WHERE event_type = 'signup'
    UNION ALL SELECT 'offline_message', event_id, user_id, ts FROM events WHERE event_type = 'click'
    UNION ALL SELECT DISTINCT 'chat', conv_id, -1, CAST(NULL AS TIMESTAMP) FROM conversations
    """,
)
def communications_union(m):
    def events(kind):
        return named(_of_kind(m, kind), id="event_id", contact_id="visitor_id", date_time="date_time")

    return fl.communications(
        call=named(m.calls(), id="call_id", contact_id="contact_id", date_time="start_time"),
        goal=events("signup"),
        offline_message=events("click"),
        chat=named(m.messages(), id="chat_id").distinct(),
    ).na.fill(-1)


@query(
    "call_details",
    """
    SELECT l_orderkey AS call_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate,
      l_linenumber, l_suppkey, l_partkey, l_extendedprice) AS place, l_shipdate AS leg_time,
      l_returnflag AS event, s_name AS employee_name
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
    """,
)
def call_details(m):
    legs = m.legs().select(
        "call_id", "leg_time", "leg_no", "employee_id", "number_id", "charge", "finish_reason"
    )
    return fl.call_details(legs, m.employees().drop("group_id")).select(
        "call_id", "place", "leg_time", F.col("finish_reason").alias("event"), "employee_name"
    )


@query(
    "tags_history",
    f"""SELECT event_id, event_type AS tag, ts AS date_time, lead(ts) OVER ({ORDER}) AS until,
    value < 50 AS automatic FROM events""",
)
def tags_history(m):
    rows = m.events().select("event_id", "visitor_id", "date_time", "kind", "amount")
    return wn.state_intervals(rows).select(
        "event_id", F.col("kind").alias("tag"), "date_time", "until", (F.col("amount") < 50).alias("automatic")
    )


@query(
    "deals_list",
    """
    SELECT o_orderkey AS deal_id, c_name AS contact_name, o_totalprice AS revenue,
      coalesce(n, 0) AS communications
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN (SELECT user_id, count(*) AS n FROM events WHERE event_type <> 'view' GROUP BY 1)
      ON user_id = o_custkey
    """,
)
def deals_list(m):
    links = m.events().filter("kind <> 'view'").select(F.col("visitor_id").alias("contact_id"))
    contacts = m.contacts().select("contact_id", "contact_name")
    return fl.deals(m.calls(), contacts, links).select(
        F.col("call_id").alias("deal_id"),
        "contact_name",
        "revenue",
        F.coalesce("communications", F.lit(0)).alias("communications"),
    )


@query(
    "deal_communications",
    """
    SELECT l_orderkey AS deal_id, 'leg' AS communication_type, l_linenumber::BIGINT AS ref_id, l_shipdate AS at
    FROM lineitem SEMI JOIN orders ON l_orderkey = o_orderkey
    UNION ALL
    SELECT o_orderkey, event_type, event_id, ts FROM
      (SELECT * FROM events WHERE event_type IN ('purchase', 'error')) e ASOF JOIN
      (SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2) o
      ON e.user_id = o.o_custkey AND e.ts >= o.o_orderdate
    """,
)
def deal_communications(m):
    legs = m.legs().select(
        F.col("call_id").alias("deal_id"), F.col("leg_no").cast("long").alias("ref_id"), F.col("leg_time").alias("at")
    )
    made = m.events().select(
        F.col("visitor_id").alias("contact_id"), F.col("event_id").alias("ref_id"), F.col("date_time").alias("at"), "kind"
    )
    parts = {k: made.filter(F.col("kind") == k).drop("kind") for k in ("purchase", "error")}
    return fl.deal_links(m.calls(), leg=legs, **parts)


@query(
    "leads_list",
    f"""
    SELECT o_custkey AS contact_id, count(*) AS deals, count(*) FILTER (WHERE o_orderstatus = 'F') AS closed,
      {dsum('o_totalprice')} AS revenue, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_deal_id,
      arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_deal_id FROM orders GROUP BY 1
    """,
)
def leads_list(m):
    return fl.leads(m.calls())


@query(
    "lead_deals",
    """
    SELECT o_custkey AS contact_id, o_orderkey AS call_id, o_orderstatus AS status, o_orderdate AS start_time,
      o_totalprice AS revenue FROM orders
    """,
)
def lead_deals(m):
    return fl.lead_deals(m.calls())


@query(
    "api_requests",
    f"""
    SELECT event_type AS method, count(*) AS requests, CAST(sum(user_id) AS BIGINT) AS weight, {dsum('value')} AS total_time,
      max(value) AS max_time, min(value) FILTER (WHERE rank >= ceil(0.9 * n)) AS p90_time
    FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value) AS rank,
      count(*) OVER (PARTITION BY event_type) AS n FROM events) GROUP BY 1
    """,
)
def api_requests(m):
    return fl.api_requests(m.events(), "kind", "visitor_id", "amount").withColumnRenamed(
        "kind", "method"
    )


@query(
    "notifications",
    f"""
    SELECT o_orderkey AS notification_id, o_orderstatus AS status, min_delay
    FROM orders JOIN (SELECT l_orderkey, min({secs('o_orderdate', 'l_shipdate')}) AS min_delay
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1) ON l_orderkey = o_orderkey
    """,
)
def notifications(m):
    """Delay of the first attempt (leg) of each notification (call) in seconds."""
    first = m.legs().groupBy("call_id").agg(F.min("leg_time").alias("sent_at"))
    rows = m.calls().join(first, "call_id")
    return rows.select(
        F.col("call_id").alias("notification_id"),
        "status",
        wn.seconds_between("start_time", "sent_at").alias("min_delay"),
    )


@query(
    "sms_list",
    """
    SELECT event_id AS sms_id, '7' || lpad(user_id::VARCHAR, 10, '0') AS phone, ts AS date_time, value AS price
    FROM events WHERE event_type = 'click'
    """,
)
def sms_list(m):
    from ringlens.sources.model import phone

    return _of_kind(m, "click").select(
        F.col("event_id").alias("sms_id"),
        phone(F.col("visitor_id")).alias("phone"),
        "date_time",
        F.col("amount").alias("price"),
    )


@query(
    "mgf_calls",
    """
    SELECT l_orderkey AS call_id, l_linenumber AS leg_no, p_brand AS operator_name, s_nationkey AS region_id,
      CASE l_linestatus WHEN 'O' THEN 'out' ELSE 'in' END AS direction
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
    WHERE l_returnflag = 'A'
    """,
)
def mgf_calls(m):
    legs = m.legs().filter("finish_reason = 'A'")
    rows = legs.join(m.numbers().select("number_id", "brand"), "number_id", "left")
    return rows.join(m.employees(), "employee_id", "left").select(
        "call_id",
        "leg_no",
        F.col("brand").alias("operator_name"),
        F.col("group_id").alias("region_id"),
        F.when(F.col("direction") == "O", "out").otherwise("in").alias("direction"),
    )


@query(
    "transcript_search",
    """
    SELECT transcript_id, phrase FROM (SELECT doc_id AS transcript_id, unnest(string_split(text, '.')) AS phrase
      FROM documents) WHERE contains(lower(phrase), 'license') OR contains(lower(phrase), 'anth')
    """,
)
def transcript_search(m):
    rows = m.transcripts().select("transcript_id", "text")
    return fl.phrase_matches(rows, "text", ["License", "anth"], "\\.")


SEARCH_SQL = """
    SELECT transcript_id, phrase FROM (SELECT doc_id AS transcript_id, unnest(string_split(text, '.')) AS phrase
      FROM documents) WHERE contains(lower(phrase), 'license') OR contains(lower(phrase), 'anth')
    """


@query("transcript_search_indexed", SEARCH_SQL)
def transcript_search_indexed(m):
    """The same search from a stored index."""
    index = tr.TranscriptIndex(shared_dir(m.spark, "transcripts"), "transcript_id", "text", 16)
    tr.build(m.transcripts(), index)
    return tr.search(m.spark, index, ["License", "anth"], "\\.")


@query(
    "state_history",
    f"""SELECT event_id, event_type AS state, prev AS previous_state FROM (
      SELECT *, lag(event_type) OVER ({ORDER}) AS prev FROM events)
    WHERE event_type IS DISTINCT FROM prev""",
)
def state_history(m):
    rows = m.events().select("event_id", "visitor_id", "date_time", "kind")
    return wn.state_changes(rows, "kind").select(
        "event_id", F.col("kind").alias("state"), "previous_state"
    )


# ---- statistics ------------------------------------------------------------------


def _day_fact_sql(kind):
    return f"""(SELECT {CAMPAIGN_SQL} AS campaign_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n,
      {dsum('value')} AS v FROM events WHERE event_type = '{kind}' GROUP BY 1, 2)"""


DAILY_SQL = f"""
    SELECT campaign_id, day, coalesce(a.n, 0) AS visits, coalesce(a.v, 0) AS visit_amount,
      coalesce(b.n, 0) AS chats, coalesce(b.v, 0) AS chat_amount,
      coalesce(c.n, 0) AS goals, coalesce(c.v, 0) AS goal_amount
    FROM {_day_fact_sql('view')} a FULL JOIN {_day_fact_sql('click')} b USING (campaign_id, day)
    FULL JOIN {_day_fact_sql('signup')} c USING (campaign_id, day)
    """


@query("campaign_daily", DAILY_SQL)
def campaign_daily(m):
    def fact(kind):
        return _of_kind(m, kind).select(campaign(), "date_time", "amount")

    return fl.campaign_daily({"visit": fact("view"), "chat": fact("click"), "goal": fact("signup")})


@query("campaign_daily_stored", DAILY_SQL)
def campaign_daily_stored(m):
    """Three increments, the second of them late and added twice."""
    target = st.by_month(shared_dir(m.spark, "daily"), "day")
    kinds = {"visit": "view", "chat": "click", "goal": "signup"}

    def increment(n):
        rows = m.events().withColumn("part", F.when(F.col("event_id") % 10 == 0, 1).otherwise(2 * (F.col("event_id") % 2)))
        own = rows.filter(F.col("part") == n).select(campaign(), "date_time", "amount", "kind")
        return {name: own.filter(F.col("kind") == kind).drop("kind") for name, kind in kinds.items()}

    st.create(fl.daily_states(increment(0)).withColumn("increment", F.lit(0)), target)
    for n in (2, 1, 1):
        st.add_daily(increment(n), target, n)
    return st.daily(m.spark, target, list(kinds))


SUMMARY_SQL = """count(DISTINCT l_partkey) AS active_numbers, count(*) AS calls,
      count(*) FILTER (WHERE l_returnflag = 'N') AS non_session_calls,
      bool_or(l_linestatus = 'O') AS has_dynamic, bool_or(l_linestatus <> 'O') AS has_static,
      CAST(count(*) AS DOUBLE) / count(DISTINCT l_partkey) AS dt_ratio"""


def _tracked(m):
    legs = m.legs().select(
        "employee_id",
        "number_id",
        (F.col("finish_reason") != "N").alias("has_session"),
        (F.col("direction") == "O").alias("dynamic"),
    )
    campaigns = m.campaigns().join(m.sites(), "site_id", "left")
    return fl.tracked(legs, ["employee_id", "number_id"]).join(m.employees(), "employee_id", "left").join(
        campaigns, F.col("group_id") == F.col("campaign_id"), "left"
    )


@query(
    "ct_summary",
    f"""SELECT r_name AS site_name, {SUMMARY_SQL} FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1""",
)
def ct_summary(m):
    return fl.ct_summary(_tracked(m), "number_id", ["site_name"])


@query(
    "ct_ac_summary",
    f"""SELECT r_name AS site_name, n_name AS campaign_name, {SUMMARY_SQL}
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
)
def ct_ac_summary(m):
    return fl.ct_summary(_tracked(m), "number_id", ["site_name", "campaign_name"])


STATUSES = ["view", "click", "signup", "purchase", "error"]


@query(
    "employee_stat",
    f"""
    SELECT employee_id, {', '.join(f"CAST(coalesce(sum(s) FILTER (WHERE event_type = '{k}'), 0) AS BIGINT) AS {k}" for k in STATUSES)}
    FROM (SELECT user_id AS employee_id, event_type, greatest({secs(
        "greatest(ts, TIMESTAMP '2024-01-05')",
        "least(coalesce(lead(ts) OVER (" + ORDER + "), TIMESTAMP '2024-01-20'), TIMESTAMP '2024-01-20')")}, 0) AS s
      FROM events) GROUP BY 1
    """,
)
def employee_stat(m):
    rows = m.events().select("event_id", "visitor_id", "date_time", "kind")

    def at(text):
        return F.lit(text).cast("timestamp_ntz")

    stat = fl.employee_stat(wn.state_intervals(rows), STATUSES, at("2024-01-05"), at("2024-01-20"))
    return stat.withColumnRenamed("visitor_id", "employee_id")


@query(
    "person_details",
    f"""
    SELECT c_custkey AS contact_id, c_name AS contact_name, first_visit, last_visit,
      coalesce(visits, 0) AS visits, coalesce(communications, 0) AS communications,
      coalesce(deals, 0) AS deals, coalesce(revenue, 0) AS revenue, revenue / nullif(deals, 0) AS average_deal
    FROM customer
    LEFT JOIN (SELECT user_id, count(*) AS visits, min(ts) AS first_visit, max(ts) AS last_visit
      FROM events WHERE event_type = 'view' GROUP BY 1) v ON v.user_id = c_custkey
    LEFT JOIN (SELECT user_id, count(*) AS communications FROM events WHERE event_type <> 'view' GROUP BY 1) c
      ON c.user_id = c_custkey
    LEFT JOIN (SELECT o_custkey, count(*) AS deals, {dsum('o_totalprice')} AS revenue FROM orders GROUP BY 1) d
      ON o_custkey = c_custkey
    """,
)
def person_details(m):
    return fl.person_details(
        m.contacts().select("contact_id", "contact_name"), m.events(), F.col("kind") == "view", m.calls()
    )


@query(
    "person_timeline",
    """
    SELECT person_id, "at", source, ref_id, row_number() OVER (PARTITION BY person_id
      ORDER BY "at", source, ref_id) AS place FROM (
      SELECT o_custkey AS person_id, o_orderdate AS "at", 'call' AS source, o_orderkey AS ref_id FROM orders
      UNION ALL SELECT user_id, ts, CASE event_type WHEN 'view' THEN 'visit' ELSE 'event' END, event_id FROM events)
    """,
)
def person_timeline(m):
    def of(df):
        return named(df, person_id="visitor_id", at="date_time", ref_id="event_id")

    parts = {
        "call": named(m.calls(), person_id="contact_id", at="start_time", ref_id="call_id"),
        "visit": of(_of_kind(m, "view")),
        "event": of(m.events().filter("kind <> 'view'")),
    }
    return fl.person_timeline(parts).withColumnRenamed("communication_type", "source")


@query(
    "cost_ratio",
    """
    SELECT o_orderkey AS cost_id, CASE o_orderstatus WHEN 'F' THEN o_totalprice + o_totalprice * 0.25
      WHEN 'O' THEN o_totalprice - o_totalprice * 0.25 ELSE o_totalprice * 0.25 END AS adjusted_cost
    FROM orders
    """,
)
def cost_ratio(m):
    sign = F.when(F.col("status") == "F", "+").when(F.col("status") == "O", "-").otherwise("*")
    costs = m.calls().select(
        F.col("call_id").alias("cost_id"),
        F.col("revenue").alias("cost"),
        F.lit(0.25).alias("cost_ratio"),
        sign.alias("cost_operator"),
    )
    return fl.cost_adjusted(costs).select("cost_id", "adjusted_cost")


@query(
    "deals_in_processing",
    "SELECT count(*) FILTER (WHERE o_orderstatus IN ('O', 'P')) AS in_processing FROM orders",
)
def deals_in_processing(m):
    return fl.deals_in_processing(m.calls())


@query(
    "deal_cycle",
    """
    SELECT *, CAST(total_days AS DOUBLE) / deals AS average_days FROM (
      SELECT o_orderstatus AS status, count(*) AS deals, CAST(sum(d) AS BIGINT) AS total_days,
        min(d) AS min_days, max(d) AS max_days
      FROM (SELECT o_orderstatus, date_diff('day', o_orderdate, max(l_shipdate)) AS d
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderstatus, o_orderdate)
      GROUP BY 1)
    """,
)
def deal_cycle(m):
    return fl.deal_cycle(m.calls(), m.legs())


@query(
    "coverage",
    f"""
    SELECT {CAMPAIGN_SQL} AS campaign_id, count(DISTINCT user_id) AS visitors,
      count(DISTINCT CASE WHEN value > 30 THEN user_id END) AS covered,
      CAST(count(DISTINCT CASE WHEN value > 30 THEN user_id END) AS DOUBLE) / count(DISTINCT user_id) AS coverage
    FROM events GROUP BY 1
    """,
)
def coverage(m):
    visits = m.events().select(campaign(), "visitor_id", "amount")
    return fl.coverage(visits, F.col("amount") > 30, ["campaign_id"])


@query(
    "note_groups",
    """
    SELECT bucket, count(*) AS notes, count(*) FILTER (WHERE sys) AS system_notes,
      arg_min(note, ("at", note)) AS first_note, arg_max(note, ("at", note)) AS last_note
    FROM (SELECT date_trunc('week', "at")::TIMESTAMP AS bucket, "at", note, sys FROM (
      SELECT ts AS "at", 'sale ' || event_id AS note, false AS sys FROM events WHERE event_type = 'purchase'
      UNION ALL SELECT DISTINCT date_trunc('day', ts)::TIMESTAMP, 'weekend', true FROM events
        WHERE isodow(ts) >= 6)) GROUP BY 1
    """,
)
def note_groups(m):
    notes = _of_kind(m, "purchase").select(
        F.col("date_time").alias("at"), F.concat(F.lit("sale "), F.col("event_id").cast("string")).alias("note")
    )
    days = m.events().select(
        F.date_trunc("day", "date_time").cast("timestamp_ntz").alias("at")
    ).distinct()
    return fl.note_groups(notes, "week", days)
