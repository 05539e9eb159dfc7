"""Attribution of communications to earlier sessions of the same visitor.

Nothing here pairs a session with a communication. Both are laid on one time line per
visitor and read off running values, so the work grows with the rows, not with the pairs,
and ``running`` cuts a long line into pieces, which keeps one busy visitor from filling a task.
Only ``touch_paths``, whose result is the pairs, joins the two, in bands of like row counts.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlens.functions.numbers import money_sum
from ringlens.operators.ordered import Running, running
from ringlens.session import settled


def _line(rows: DataFrame, key: str, at: Column, side: int, ident: str, **extra: Column) -> DataFrame:
    return rows.select(
        F.col(key).alias("__key"),
        at.alias("__at"),
        F.lit(side).alias("__side"),
        F.col(ident).alias("__id"),
        *[c.alias(n) for n, c in extra.items()],
    )


def _run(line: DataFrame, *specs: Running) -> DataFrame:
    return running(line, ["__key"], ["__at", "__side", "__id"], *specs)


def _both_ends(rows: DataFrame, key: str, first: Column, last: Column, ident: str, **extra: Column) -> DataFrame:
    """Each row at both ends of its span, side -1 and 1, from one read of the rows."""
    ends = [F.struct(at.alias("at"), F.lit(side).alias("side")) for at, side in ((first, -1), (last, 1))]
    spans = rows.select(
        F.col(key).alias("__key"), F.col(ident).alias("__id"), *[c.alias(n) for n, c in extra.items()],
        F.explode(F.array(*ends)).alias("__end"),
    )
    return spans.select("__key", F.col("__end.at").alias("__at"), F.col("__end.side").alias("__side"), "__id", *extra)


def _known(rows: DataFrame, key: str) -> DataFrame:
    """History that a fact can meet: a NULL key meets nothing, but its facts stay."""
    return rows.filter(F.col(key).isNotNull())


def asof(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    fact_ts: str,
    fact_id: str,
    history_ts: str,
    history_id: str,
    payload: list[str],
) -> DataFrame:
    """Each fact with the last history row at or before it (NULL payload when none)."""
    fact_row = F.struct(*facts.columns)
    past = F.struct(*payload)
    line = _line(_known(history, key), key, F.col(history_ts), 0, history_id, past=past).unionByName(
        _line(facts, key, F.col(fact_ts), 1, fact_id, fact=fact_row), allowMissingColumns=True
    )
    out = _run(line, Running("hit", "last", F.col("past")))
    return out.filter("__side = 1").select("fact.*", *[F.col(f"hit.{p}") for p in payload])


def attribute(
    sessions: DataFrame,
    comms: DataFrame,
    key: str,
    ts: str,
    ident: str,
    channel: str,
    value: str,
    days: int,
) -> DataFrame:
    """Per communication: sessions in the ``days`` before it and the first and last of them.

    Both ends of the window are included. Communications without a session keep
    ``touches = 0``.
    """
    window = F.expr(f"INTERVAL {days} DAY")
    touch = F.struct(F.col(ident).alias("id"), F.col(channel).alias("channel"))
    at = F.col(ts)
    line = settled(
        _both_ends(comms, key, at - window, at, ident, amount=F.col(value)).unionByName(
            _line(_known(sessions, key), key, at, 0, ident, touch=touch), allowMissingColumns=True
        ),
        "line",
    )
    seen = F.when(F.col("__side") == 0, 1).otherwise(0).cast("long")
    probes = _run(
        line,
        Running("n", "sum", seen),
        Running("after", "next", F.col("touch")),
        Running("before", "last", F.col("touch")),
    ).filter("__side <> 0")
    joined = probes.groupBy(F.col("__key").alias(key), F.col("__id").alias(ident)).agg(
        F.sum(F.col("n") * F.col("__side")).alias("touches"),
        F.max("amount").alias(value),
        F.max(F.when(F.col("__side") == -1, F.col("after"))).alias("first_touch"),
        F.max(F.when(F.col("__side") == 1, F.col("before"))).alias("last_touch"),
        F.max(F.when(F.col("__side") == 1, F.col("__at"))).alias(ts),
    )
    kept = F.col("touches") > 0
    return joined.withColumns(
        {
            "first_touch": F.when(kept, F.col("first_touch")),
            "last_touch": F.when(kept, F.col("last_touch")),
        }
    )


BAND = 1024  # sessions of a visitor that lie in one band


def touch_paths(
    sessions: DataFrame,
    comms: DataFrame,
    key: str,
    ts: str,
    ident: str,
    days: int,
    carry: list[str],
) -> DataFrame:
    """The touches themselves: a row for each communication and each session in the ``days``
    before it, ``key, ident, touch, place, touches`` and the ``carry`` columns of the session.

    A visitor's sessions are numbered in time order, and each communication reads off the line
    which numbers its window covers. Numbers are cut into bands, a communication goes to the
    bands that it covers, and both meet on (visitor, band). So a band has at most ``BAND``
    sessions however busy the visitor is, a place is a difference of numbers, and no window
    is taken over the pairs. Both ends of the window are included. Communications without a
    session have no row; a NULL visitor meets nobody.
    """
    at = F.col(ts)
    window = F.expr(f"INTERVAL {days} DAY")
    line = settled(
        _both_ends(_known(comms, key), key, at - window, at, ident).unionByName(
            _line(_known(sessions, key), key, at, 0, ident, **{f"__c_{c}": F.col(c) for c in carry}),
            allowMissingColumns=True,
        ),
        "line",
    )
    seen = F.when(F.col("__side") == 0, 1).otherwise(0).cast("long")
    numbered = settled(_run(line, Running("__no", "sum", seen)), "numbered")
    band = F.floor((F.col("__no") - 1) / BAND)
    own = numbered.filter("__side = 0").select(
        "__key", "__no", band.alias("__band"), F.col("__id").alias("touch"),
        *[F.col(f"__c_{c}").alias(c) for c in carry],
    )
    spans = (
        numbered.filter("__side <> 0")
        .groupBy("__key", F.col("__id").alias(ident))
        .agg(
            F.max(F.when(F.col("__side") == -1, F.col("__no"))).alias("__before"),
            F.max(F.when(F.col("__side") == 1, F.col("__no"))).alias("__until"),
        )
        .filter("__until > __before")
        .withColumn(
            "__band", F.explode(F.sequence(F.floor(F.col("__before") / BAND), F.floor((F.col("__until") - 1) / BAND)))
        )
    )
    met = spans.join(own, ["__key", "__band"]).filter("__no > __before AND __no <= __until")
    return met.select(
        F.col("__key").alias(key), ident, "touch", (F.col("__no") - F.col("__before")).alias("place"),
        (F.col("__until") - F.col("__before")).alias("touches"), *carry,
    )


def path_chains(
    paths: DataFrame, comms: DataFrame, ident: str, channel: str, value: str, most: int
) -> DataFrame:
    """Conversions and revenue by chain of channels, of the paths of at most ``most`` touches:
    ``chain, conversions, revenue``. ``most`` bounds the array of a communication."""
    name = F.coalesce(F.col(channel).cast("string"), F.lit(""))
    step = F.struct("place", name.alias("name"))
    chains = (
        paths.filter(F.col("touches") <= most)
        .groupBy(ident)
        .agg(F.sort_array(F.collect_list(step)).alias("steps"))
        .select(ident, F.array_join("steps.name", " > ").alias("chain"))
    )
    return (
        chains.join(comms.select(ident, value), ident)
        .groupBy("chain")
        .agg(F.count("*").alias("conversions"), money_sum(value).alias("revenue"))
    )


def _exact(c: Column) -> Column:
    return c.cast("decimal(28,12)")


# model -> (weight of every touch, extra weight of the first, extra weight of the last) by
# the number of touches, 1 in total; None where a part has no weight. The models are chosen
# rules.
MODELS = {
    "first": lambda n: (None, F.lit(1.0), None),
    "last": lambda n: (None, None, F.lit(1.0)),
    "linear": lambda n: (1.0 / n, None, None),
    "position": lambda n: (
        F.when(n > 2, 0.2 / F.greatest(n - 2, F.lit(1))).otherwise(0.0),
        F.when(n == 1, 1.0).when(n == 2, 0.5).otherwise(0.4 - 0.2 / F.greatest(n - 2, F.lit(1))),
        F.when(n == 1, 0.0).when(n == 2, 0.5).otherwise(0.4 - 0.2 / F.greatest(n - 2, F.lit(1))),
    ),
}


def multichannel(
    sessions: DataFrame,
    comms: DataFrame,
    key: str,
    ts: str,
    ident: str,
    channel: str,
    value: str,
    days: int,
    model: str,
) -> DataFrame:
    """Value credited to each channel under an attribution model.

    The equal share of a touch is a difference of two running sums of the credits of later
    communications, so middle touches need no pairing either.
    """
    hits = settled(
        attribute(sessions, comms, key, ts, ident, channel, value, days).filter("touches > 0"),
        "hits",
    )
    n, amount = F.col("touches"), F.col(value)
    every, first, last = MODELS[model](n)
    ends = [
        F.struct(
            F.col(f"{end}.channel").alias("channel"), _exact(amount * weight).alias("credit")
        )
        for end, weight in (("first_touch", first), ("last_touch", last))
        if weight is not None
    ]
    credits = []
    if ends:
        credits.append(hits.select(F.explode(F.array(*ends)).alias("part")).select("part.*"))
    if every is not None:
        window = F.expr(f"INTERVAL {days} DAY")
        share = _exact(amount * every)
        line = settled(
            _both_ends(
                _known(sessions, key), key, F.col(ts), F.col(ts) + window, ident, channel=F.col(channel)
            ).unionByName(
                _line(hits, key, F.col(ts), 0, ident, share=share), allowMissingColumns=True
            ),
            "line",
        )
        run = _run(line, Running("total", "sum", F.coalesce("share", _exact(F.lit(0)))))
        # a sign change keeps all decimals, a product would not
        total = F.col("total")
        signed = F.when(F.col("__side") < 0, -total).otherwise(total)
        middle = run.filter("__side <> 0").select("channel", _exact(signed).alias("credit"))
        credits.append(middle)
    return reduce(DataFrame.unionByName, credits).groupBy("channel").agg(F.sum("credit").alias("credit"))
