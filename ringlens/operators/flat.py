"""Row-level reports and per-entity profiles."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlens.functions.numbers import money, money_sum, ratio
from ringlens.operators import ordered
from ringlens.operators.attribution import asof
from ringlens.operators.windows import seconds_between


def calls_report(calls: DataFrame, legs: DataFrame) -> DataFrame:
    """Call sessions with leg totals. Legs are summed per call before the join."""
    totals = legs.groupBy("call_id").agg(
        F.count("*").alias("legs"),
        money_sum("duration").alias("total_duration"),
        F.bool_or(F.col("finish_reason") == "R").alias("is_lost"),
    )
    return calls.join(totals, "call_id", "left")


def call_legs_report(legs: DataFrame, calls: DataFrame, employees: DataFrame) -> DataFrame:
    return legs.join(calls, "call_id", "left").join(employees, "employee_id", "left")


def financial_legs(legs: DataFrame) -> DataFrame:
    """Leg charges. Chosen rule: started minutes times the rate, less the bonus share."""
    minutes = F.ceil(F.col("duration") / 60).cast("int")
    gross = money("charge") * minutes
    bonus = money(F.col("charge") * F.col("bonus_rate"))
    return legs.withColumns(
        {
            "minutes": minutes,
            "bonus": bonus.cast("double"),
            "total_charge": (gross - bonus).cast("double"),
        }
    )


def chats_report(messages: DataFrame) -> DataFrame:
    """One row per chat: message counts by side and the first visitor text."""
    def of(role):
        return F.col("role") == role

    return messages.groupBy("chat_id").agg(
        F.count("*").alias("messages"),
        F.count_if(of("user")).alias("visitor_messages"),
        F.count_if(of("assistant")).alias("operator_messages"),
        F.min_by(F.length("text"), F.when(of("user"), F.struct("turn", "text"))).alias(
            "first_text_length"
        ),
    )


def chat_messages(messages: DataFrame) -> DataFrame:
    """Messages numbered within their chat in time order."""
    return ordered.running(messages, ["chat_id"], ["turn"], ordered.number("place"))


def visitor_sessions(hits: DataFrame) -> DataFrame:
    """Numbered hits (see ``windows.sessionize``) rolled up to sessions."""
    rank = F.struct("date_time", "event_id")
    return (
        hits.groupBy("visitor_id", "session_no")
        .agg(
            F.min("date_time").alias("start_time"),
            F.max("date_time").alias("end_time"),
            F.count("*").alias("hits"),
            F.min_by("kind", rank).alias("entrance"),
            F.max_by("kind", rank).alias("exit"),
        )
        .withColumn("duration", seconds_between("start_time", "end_time"))
    )


def communications(**parts: DataFrame) -> DataFrame:
    """All communications in one table; the keyword becomes ``communication_type``."""
    tagged = [df.withColumn("communication_type", F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def call_details(legs: DataFrame, employees: DataFrame) -> DataFrame:
    """Time line of each call: its legs numbered in order, with the participant."""
    order = ["leg_time", "leg_no", "employee_id", "number_id", "charge"]
    placed = ordered.running(legs, ["call_id"], order, ordered.number("place"))
    return placed.join(employees, "employee_id", "left")


def deals(deals_: DataFrame, contacts: DataFrame, links: DataFrame) -> DataFrame:
    """Deals with their contact and the number of linked communications."""
    counts = links.groupBy("contact_id").agg(F.count("*").alias("communications"))
    return deals_.join(contacts, "contact_id", "left").join(counts, "contact_id", "left")


def deal_links(deals_: DataFrame, **parts: DataFrame) -> DataFrame:
    """The communications of each deal, a row each: ``deal_id, communication_type, ref_id, at``.

    Each part has ``ref_id``, ``at`` and either the ``deal_id`` it was made for or the
    ``contact_id`` it was made by; the keyword is its type. A contact's communication belongs
    to the contact's last deal created at or before it (chosen rule), so every communication
    is one row at most and nothing is paired.
    """
    columns = ["deal_id", "communication_type", "ref_id", "at"]
    own = deals_.select(F.col("call_id").alias("deal_id"), "contact_id", F.col("start_time").alias("__since"))
    linked = []
    direct = {name: df for name, df in parts.items() if "deal_id" in df.columns}
    if direct:
        linked.append(communications(**direct).join(own.select("deal_id"), "deal_id", "left_semi").select(*columns))
    by_contact = {name: df for name, df in parts.items() if name not in direct}
    if by_contact:
        rows = communications(**by_contact).filter(F.col("contact_id").isNotNull())
        found = asof(rows, own, "contact_id", "at", "ref_id", "__since", "deal_id", ["deal_id"])
        linked.append(found.filter(F.col("deal_id").isNotNull()).select(*columns))
    return reduce(DataFrame.unionByName, linked)


def leads(deals_: DataFrame) -> DataFrame:
    """One row per lead (a contact) summarising its deals; the deals stay rows of their own."""
    rank = F.struct("start_time", "call_id")
    return deals_.groupBy("contact_id").agg(
        F.count("*").alias("deals"),
        F.count_if(F.col("status") == "F").alias("closed"),
        money_sum("revenue").alias("revenue"),
        F.min_by("call_id", rank).alias("first_deal_id"),
        F.max_by("call_id", rank).alias("last_deal_id"),
    )


def lead_deals(deals_: DataFrame) -> DataFrame:
    """The deals of each lead, a row each, keyed by the lead."""
    return deals_.select("contact_id", "call_id", "status", "start_time", "revenue")


def api_requests(log: DataFrame, method: str, weight: str, elapsed: str) -> DataFrame:
    """Request log rolled up by method, with the exact 90th percentile of the times."""
    rolled = log.groupBy(method).agg(
        F.count("*").alias("requests"),
        F.sum(weight).alias("weight"),
        money_sum(elapsed).alias("total_time"),
        F.max(elapsed).alias("max_time"),
    )
    p90 = ordered.exact_percentile(log, [method], elapsed, "p90_time", 0.9)
    p90 = p90.withColumnRenamed(method, "__method")
    return rolled.join(p90, F.col(method).eqNullSafe(F.col("__method")), "left").drop("__method")


def phrase_matches(rows: DataFrame, text: str, texts: list[str], separator: str) -> DataFrame:
    """Phrases of a transcript that contain any search text, ignoring case."""
    def hit(phrase):
        low = F.lower(phrase)
        return reduce(lambda a, b: a | b, [low.contains(t.lower()) for t in texts])

    if not texts:
        raise ValueError("no search text given")
    found = F.filter(F.split(F.col(text), separator), hit)
    kept = [c for c in rows.columns if c != text]
    return rows.select(*kept, F.explode_outer(found).alias("phrase")).filter("phrase IS NOT NULL")


# ---- statistics ----------------------------------------------------------------


def daily_states(facts: dict[str, DataFrame], key: str = "campaign_id", ts: str = "date_time") -> DataFrame:
    """``key, day, fact, n, v``: each fact counted and summed per day by itself, so none
    multiplies another. States of the same key, day and fact add up."""
    parts = []
    for name, df in facts.items():
        own = df.groupBy(key, F.to_date(ts).alias("day")).agg(F.count("*").alias("n"), F.sum(money("amount")).alias("v"))
        parts.append(own.withColumn("fact", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


def daily_lines(states: DataFrame, facts: list[str], key: str = "campaign_id") -> DataFrame:
    """The states side by side: a count and an amount per fact, by key and day."""
    columns = []
    for name in facts:
        own = F.col("fact") == name
        columns.append(F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0)).alias(f"{name}s"))
        amount = F.sum(F.when(own, F.col("v"))).cast("double")
        columns.append(F.coalesce(amount, F.lit(0.0)).alias(f"{name}_amount"))
    day = F.date_format("day", "yyyy-MM-dd").alias("day")
    return states.groupBy(key, day).agg(*columns)


def campaign_daily(
    facts: dict[str, DataFrame], key: str = "campaign_id", ts: str = "date_time"
) -> DataFrame:
    """Daily counts and amounts per campaign from several facts, without an outer join."""
    return daily_lines(daily_states(facts, key, ts), list(facts), key)


def tracked(calls: DataFrame, keys: list[str]) -> DataFrame:
    """Calls summed per ``keys`` (a number and what leads to dimensions), to be joined then."""
    return calls.groupBy(*keys).agg(
        F.count("*").alias("calls"),
        F.count_if(~F.col("has_session")).alias("non_session_calls"),
        F.bool_or(F.col("dynamic")).alias("has_dynamic"),
        F.bool_or(~F.col("dynamic")).alias("has_static"),
    )


def ct_summary(parts: DataFrame, numbers: str, keys: list[str]) -> DataFrame:
    """Call-tracking summary of ``tracked`` parts: numbers in use, calls, calls without a
    session, calls per number."""
    return (
        parts.groupBy(*keys)
        .agg(
            F.count_distinct(numbers).alias("active_numbers"),
            F.sum("calls").alias("calls"),
            F.sum("non_session_calls").alias("non_session_calls"),
            F.bool_or("has_dynamic").alias("has_dynamic"),
            F.bool_or("has_static").alias("has_static"),
        )
        .withColumn("dt_ratio", ratio(F.col("calls"), F.col("active_numbers")))
    )


def employee_stat(
    history: DataFrame, statuses: list[str], date_from: Column, date_till: Column
) -> DataFrame:
    """Seconds per employee and status inside a range; the last status lasts to its end.

    ``history`` holds state intervals (see ``windows.state_intervals``). An interval is
    clipped to the range before it is measured.
    """
    start = F.greatest(F.col("date_time"), date_from)
    end = F.least(F.coalesce(F.col("until"), date_till), date_till)
    spent = F.greatest(seconds_between(start, end), F.lit(0))
    return (
        history.withColumn("seconds", spent)
        .groupBy("visitor_id")
        .pivot("kind", statuses)
        .agg(F.coalesce(F.sum("seconds"), F.lit(0)))
        .na.fill(0, statuses)
    )


def person_details(
    persons: DataFrame, events: DataFrame, is_visit: Column, deals_: DataFrame
) -> DataFrame:
    """Profile per person. Every fact is aggregated per person, in one pass, before it is
    joined; events are visits or else communications."""
    visit_time = F.when(is_visit, F.col("date_time"))
    by_event = events.groupBy(F.col("visitor_id").alias("contact_id")).agg(
        F.count_if(is_visit).alias("visits"),
        F.min(visit_time).alias("first_visit"),
        F.max(visit_time).alias("last_visit"),
        F.count_if(~is_visit).alias("communications"),
    )
    by_deal = deals_.groupBy("contact_id").agg(
        F.count("*").alias("deals"), money_sum("revenue").alias("revenue")
    )
    out = persons
    for side in (by_event, by_deal):
        out = out.join(side, "contact_id", "left")
    counts = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("visits", "communications", "deals")}
    return out.withColumn("average_deal", ratio(F.col("revenue"), F.col("deals"))).withColumns(
        {**counts, "revenue": F.coalesce("revenue", F.lit(0.0))}
    )


def person_timeline(parts: dict[str, DataFrame]) -> DataFrame:
    """Everything a person did, numbered in time order.

    Each part has person_id, at, ref_id; the keyword names the source.
    """
    together = communications(**parts)
    return ordered.running(
        together,
        ["person_id"],
        ["at", "communication_type", "ref_id"],
        ordered.number("place"),
    )


# operator of a campaign's cost ratio -> adjusted cost (the set is chosen)
COST_OPERATORS = {
    "+": lambda cost, r: cost + cost * r,
    "-": lambda cost, r: cost - cost * r,
    "*": lambda cost, r: cost * r,
}


def cost_adjusted(costs: DataFrame) -> DataFrame:
    """Scale ``cost`` by ``cost_ratio`` as ``cost_operator`` says; unknown operators keep it."""
    cost, r = F.col("cost"), F.col("cost_ratio")
    chain = F.when(F.lit(False), cost)
    for sign, apply in COST_OPERATORS.items():
        chain = chain.when(F.col("cost_operator") == sign, apply(cost, r))
    return costs.withColumn("adjusted_cost", chain.otherwise(cost))


OPEN_STAGES = ("O", "P")  # chosen set of stages still in processing


def deals_in_processing(deals_: DataFrame) -> DataFrame:
    return deals_.agg(F.count_if(F.col("status").isin(*OPEN_STAGES)).alias("in_processing"))


def deal_cycle(deals_: DataFrame, legs: DataFrame) -> DataFrame:
    """Days from creation to closing (the last leg), averaged by stage."""
    closed = legs.groupBy("call_id").agg(F.max("leg_time").alias("closed_at"))
    days = F.datediff("closed_at", "start_time")
    return (
        deals_.join(closed, "call_id")
        .groupBy("status")
        .agg(
            F.count("*").alias("deals"),
            F.sum(days).alias("total_days"),
            F.min(days).alias("min_days"),
            F.max(days).alias("max_days"),
        )
        .withColumn("average_days", ratio(F.col("total_days"), F.col("deals")))
    )


def coverage(visits: DataFrame, shown: Column, keys: list[str]) -> DataFrame:
    """Share of distinct visitors that were shown a number."""
    each = visits.groupBy(*keys, "visitor_id").agg(F.max(F.coalesce(shown, F.lit(False))).alias("__shown"))
    known = F.col("visitor_id").isNotNull()
    return (
        each.groupBy(*keys)
        .agg(
            F.count_if(known).alias("visitors"),
            F.count_if(known & F.col("__shown")).alias("covered"),
        )
        .withColumn("coverage", ratio(F.col("covered"), F.col("visitors")))
    )


def note_groups(
    notes: DataFrame, unit: str, weekends: DataFrame | None = None, weekend_text: str = "weekend"
) -> DataFrame:
    """Chart notes counted per bucket; weekend days of the axis may join as system notes.

    The notes stay rows (``bucket`` is added to them by ``note_rows``); the group holds the
    count and its first and last note.
    """
    rows = note_rows(notes, unit, weekends, weekend_text)
    rank = F.struct("at", "note")
    return rows.groupBy("bucket").agg(
        F.count("*").alias("notes"),
        F.count_if("is_system").alias("system_notes"),
        F.min_by("note", rank).alias("first_note"),
        F.max_by("note", rank).alias("last_note"),
    )


def note_rows(notes, unit, weekends=None, weekend_text="weekend"):
    from ringlens.operators.report import bucket

    rows = notes.select("at", "note", F.lit(False).alias("is_system"))
    if weekends is not None:
        days = weekends.filter(F.weekday("at") >= 5).select(
            "at", F.lit(weekend_text).alias("note"), F.lit(True).alias("is_system")
        )
        rows = rows.unionByName(days)
    return rows.withColumn("bucket", bucket("at", unit))
