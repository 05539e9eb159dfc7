"""Visitor sessions with their hits, communications and segments.

Two streams lie on one time line per visitor: hits open sessions and extend them,
communications are carried to the session that is open when they come. Rows stay rows; they
are nested only for the sessions of the page that is asked for.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringlens.operators import filters as flt
from ringlens.operators.ordered import Line, Running, following, previous
from ringlens.operators.windows import ID, KEY, TS, seconds_between

#: Hits of a session that its nested list has; the counts are of all.
NESTED = 1000


def session_rows(hits: DataFrame, comms: DataFrame, gap_seconds: int) -> DataFrame:
    """Hits and communications with the session each belongs to.

    Adds ``is_hit``, ``session_no`` and ``session_start`` (both NULL for a communication while
    no session is open) and ``hit_duration``, the seconds to the next hit of the session. A
    session ends ``gap_seconds`` after its last hit; communications don't extend it. At one
    time a hit comes before a communication. Both inputs have the visitor, time and id columns;
    what else one of them lacks is NULL there.
    """
    rows = hits.withColumn("is_hit", F.lit(True)).unionByName(
        comms.withColumn("is_hit", F.lit(False)), allowMissingColumns=True
    ).withColumn("__side", F.when(F.col("is_hit"), 0).otherwise(1))
    line = Line.of(rows, [KEY], [TS, "__side", ID])
    hit_time = F.when(F.col("is_hit"), F.col(TS))
    seen = line.add(line.rows, previous("__prev", hit_time), following("__next", hit_time))
    pause = seconds_between("__prev", TS)
    opens = F.col("is_hit") & (F.col("__prev").isNull() | (pause > gap_seconds))
    seen = seen.withColumn("__opens", F.when(opens, 1).otherwise(0).cast("long"))
    numbered = line.add(
        seen, Running("__no", "sum", F.col("__opens")),
        Running("__start", "last", F.when(F.col("__opens") == 1, F.col(TS))),
    )
    inside = F.col("is_hit") | (pause <= gap_seconds)
    spent = seconds_between(TS, "__next")
    out = numbered.withColumns(
        {
            "session_no": F.when(inside, F.col("__no")),
            "session_start": F.when(inside, F.col("__start")),
            "hit_duration": F.when(F.col("is_hit") & (spent <= gap_seconds), spent),
        }
    )
    return line.bare(out).drop("__side", "__prev", "__next", "__opens", "__no", "__start")


def session_summary(rows: DataFrame) -> DataFrame:
    """A row per session: times, counts, first and last hit; aggregates combine map-side."""
    hit = F.col("is_hit")
    rank = F.when(hit, F.struct(TS, ID))
    return (
        rows.filter(F.col("session_no").isNotNull())
        .groupBy(KEY, "session_no")
        .agg(
            F.min(TS).alias("start_time"),
            F.max(F.when(hit, F.col(TS))).alias("end_time"),
            F.count_if(hit).alias("hits_count"),
            F.count_if(~hit).alias("communications_count"),
            F.min_by(ID, rank).alias("entrance_id"),
            F.max_by(ID, rank).alias("exit_id"),
        )
        .withColumn("duration", seconds_between("start_time", "end_time"))
    )


def nested_page(
    hits: DataFrame,
    comms: DataFrame,
    segments: DataFrame,
    gap_seconds: int,
    sort: list[tuple[str, str]],
    limit: int = 50,
    offset: int = 0,
    hit_fields: tuple[str, ...] = (ID, TS, "hit_duration"),
    comm_fields: tuple[str, ...] = (ID, TS),
    nested: int = NESTED,
) -> DataFrame:
    """One page of sessions with ``hits``, ``communications`` and ``segments`` as arrays.

    The page is found among all sessions. Then the rows of the page's visitors alone are laid
    on their lines again, and what belongs to the page is nested: at most ``limit`` arrays, of
    ``nested`` first entries each (the counts tell how many there are). ``segments`` has the
    visitor and the segment's name, a row each.
    """
    page = flt.page(session_summary(session_rows(hits, comms, gap_seconds)), sort, [KEY, "session_no"], limit, offset)
    page = page.withColumn("__key", F.struct(F.col(KEY), F.col("session_no")))
    visitors = page.select(F.struct(KEY).alias("__v")).distinct()

    def of_page(df: DataFrame) -> DataFrame:
        return df.withColumn("__v", F.struct(KEY)).join(visitors, "__v", "left_semi").drop("__v")

    rows = session_rows(of_page(hits), of_page(comms), gap_seconds)
    rows = rows.withColumn("__key", F.struct(F.col(KEY), F.col("session_no"))).join(
        page.select("__key"), "__key", "left_semi"
    )
    order = Window.partitionBy("__key", "is_hit").orderBy(TS, ID)
    rows = rows.withColumn("__place", F.row_number().over(order)).filter(F.col("__place") <= nested)

    def listed(flag: Column, fields: tuple[str, ...], name: str) -> Column:
        entry = F.struct("__place", F.struct(*fields).alias("row"))
        return F.transform(F.sort_array(F.collect_list(F.when(flag, entry))), lambda e: e["row"]).alias(name)

    lists = rows.groupBy("__key").agg(
        listed(F.col("is_hit"), hit_fields, "hits"), listed(~F.col("is_hit"), comm_fields, "communications")
    )
    of_visitor = (
        of_page(segments).groupBy(F.struct(KEY).alias("__v"))
        .agg(F.sort_array(F.collect_set("segment_name")).alias("segments"))
    )
    none = F.array().cast("array<string>")
    return (
        page.join(lists, "__key")
        .withColumn("__v", F.struct(KEY))
        .join(of_visitor, "__v", "left")
        .withColumn("segments", F.coalesce("segments", none))
        .drop("__key", "__v")
    )
