"""Attribution queries: views are sessions, purchases and clicks are communications."""
from __future__ import annotations

from pyspark.sql import functions as F

from ringlens.operators import attribution as at
from ringlens.plans.registry import query
from ringlens.plans.windows import CAMPAIGN_SQL, campaign

DAYS = 7


def _kind(m, kind):
    rows = m.events().filter(F.col("kind") == kind)
    return rows.select("event_id", "visitor_id", "date_time", "amount", campaign())


def _sessions_and_sales(m):
    return dict(
        sessions=_kind(m, "view"),
        comms=_kind(m, "purchase"),
        key="visitor_id",
        ts="date_time",
        ident="event_id",
        channel="campaign_id",
        value="amount",
        days=DAYS,
    )


PAIRS_SQL = f"""
    SELECT c.event_id, c.value AS amount, s.event_id AS touch_id, s.campaign_id,
      row_number() OVER (PARTITION BY c.event_id ORDER BY s.ts, s.event_id) AS place,
      count(s.event_id) OVER (PARTITION BY c.event_id) AS touches
    FROM events c LEFT JOIN
      (SELECT event_id, ts, user_id, {CAMPAIGN_SQL} AS campaign_id FROM events
       WHERE event_type = 'view') s
      ON s.user_id = c.user_id AND s.ts <= c.ts AND s.ts >= c.ts - INTERVAL {DAYS} DAY
    WHERE c.event_type = 'purchase'"""


@query(
    "attribution_window",
    f"""
    SELECT event_id, max(touches) AS touches,
      coalesce(max(CASE WHEN place = 1 THEN touch_id END), -1) AS first_touch_id,
      coalesce(max(CASE WHEN place = touches THEN touch_id END), -1) AS last_touch_id
    FROM ({PAIRS_SQL}) GROUP BY 1
    """,
)
def attribution_window(m):
    return at.attribute(**_sessions_and_sales(m)).select(
        "event_id",
        "touches",
        F.col("first_touch.id").alias("first_touch_id"),
        F.col("last_touch.id").alias("last_touch_id"),
    ).na.fill(-1)


@query(
    "attribution_paths",
    f"""
    SELECT event_id, touch_id, campaign_id, place, touches,
      CASE WHEN place = 1 AND touches = 1 THEN 'only' WHEN place = 1 THEN 'first'
        WHEN place = touches THEN 'last' ELSE 'middle' END AS role
    FROM ({PAIRS_SQL}) WHERE touch_id IS NOT NULL
    """,
)
def attribution_paths(m):
    paths = at.touch_paths(
        _kind(m, "view"), _kind(m, "purchase"), "visitor_id", "date_time", "event_id", DAYS, ["campaign_id"]
    )
    first, last = F.col("place") == 1, F.col("place") == F.col("touches")
    role = F.when(first & last, "only").when(first, "first").when(last, "last").otherwise("middle")
    return paths.select(
        "event_id", F.col("touch").alias("touch_id"), "campaign_id", "place", "touches", role.alias("role")
    )


CHAIN_SQL = f"""
    SELECT string_agg(coalesce(campaign_id::VARCHAR, ''), ' > ' ORDER BY place) AS chain, any_value(amount) AS amount
    FROM ({PAIRS_SQL}) WHERE touch_id IS NOT NULL AND touches <= 5 GROUP BY event_id"""


@query(
    "attribution_chains",
    f"""
    SELECT chain, count(*) AS conversions, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM ({CHAIN_SQL}) GROUP BY 1
    """,
)
def attribution_chains(m):
    comms = _kind(m, "purchase")
    paths = at.touch_paths(
        _kind(m, "view"), comms, "visitor_id", "date_time", "event_id", DAYS, ["campaign_id"]
    )
    return at.path_chains(paths, comms, "event_id", "campaign_id", "amount", most=5)


@query(
    "last_session_asof",
    f"""
    SELECT c.event_id, coalesce(s.event_id, -1) AS session_id, coalesce(s.campaign_id, -1) AS campaign_id
    FROM (SELECT * FROM events WHERE event_type = 'click') c ASOF LEFT JOIN
      (SELECT event_id, ts, user_id, {CAMPAIGN_SQL} AS campaign_id FROM events
       WHERE event_type = 'view') s
      ON s.user_id = c.user_id AND c.ts >= s.ts
    """,
)
def last_session_asof(m):
    sessions = _kind(m, "view").withColumnRenamed("event_id", "session_id")
    clicks = m.events().filter("kind = 'click'").select("event_id", "visitor_id", "date_time")
    return at.asof(
        clicks,
        sessions,
        "visitor_id",
        "date_time",
        "event_id",
        "date_time",
        "session_id",
        ["session_id", "campaign_id"],
    ).drop("visitor_id", "date_time").na.fill(-1)


# the weights of every touch and of the first and last ones besides, as in the models
WEIGHT_SQL = {
    "first": ["CASE WHEN place = 1 THEN 1.0 ELSE 0.0 END"],
    "last": ["CASE WHEN place = touches THEN 1.0 ELSE 0.0 END"],
    "linear": ["1.0::DOUBLE / touches"],
    "position": [
        "CASE WHEN touches > 2 THEN 0.2::DOUBLE / greatest(touches - 2, 1) ELSE 0.0 END",
        """CASE WHEN place <> 1 THEN 0.0 WHEN touches = 1 THEN 1.0 WHEN touches = 2 THEN 0.5
           ELSE 0.4::DOUBLE - 0.2::DOUBLE / greatest(touches - 2, 1) END""",
        """CASE WHEN place <> touches OR touches = 1 THEN 0.0 WHEN touches = 2 THEN 0.5
           ELSE 0.4::DOUBLE - 0.2::DOUBLE / greatest(touches - 2, 1) END""",
    ],
}


def _model_query(model):
    def build(m):
        out = at.multichannel(**_sessions_and_sales(m), model=model)
        return out.filter("credit <> 0").select(
            F.col("channel").alias("campaign_id"),
            F.round(F.col("credit").cast("double"), 4).alias("credit"),
        )

    return build


for _model, _weights in WEIGHT_SQL.items():
    _credit = " + ".join(f"CAST(amount * CAST(({w}) AS DOUBLE) AS DECIMAL(28,12))" for w in _weights)
    query(
        f"attribution_{_model}",
        f"""
        SELECT campaign_id, round(CAST(sum({_credit}) AS DOUBLE), 4) AS credit
        FROM ({PAIRS_SQL}) WHERE touches > 0 GROUP BY 1 HAVING credit <> 0
        """,
    )(_model_query(_model))
