"""Running columns and attribution against brute force, with and without heavy keys."""
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ringlens.operators import attribution as at
from ringlens.operators import ordered
from ringlens.operators.joins import longest_prefix
from ringlens.operators.ordered import Running, running

START = datetime(2024, 1, 1)


def sample(n=400, seed=3):
    """One visitor holds most rows; times collide."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 1 if rng.random() < 0.7 else rng.randint(2, 6)
        ts = START + timedelta(hours=rng.randint(0, 24 * 9))
        rows.append((key, ts, i, rng.randint(0, 9) if rng.random() < 0.6 else None))
    return rows


@pytest.mark.parametrize("heavy", [10**9, 3])
def test_running(spark, monkeypatch, heavy):
    monkeypatch.setattr(ordered, "HEAVY_ROWS", heavy)
    rows = sample()
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, id int, v int")
    out = running(
        df, ["k"], ["ts", "id"],
        Running("total", "sum", F.col("v")),
        Running("before", "sum", F.col("v"), inclusive=False),
        Running("last", "last", F.col("v"), inclusive=False),
        Running("next", "next", F.col("v"), inclusive=False),
        Running("here", "next", F.col("v")),
    ).collect()
    assert len(out) == len(rows)
    for r in out:
        own = sorted((t, i, v) for k, t, i, v in rows if k == r.k)
        past = [v for t, i, v in own if (t, i) < (r.ts, r.id) and v is not None]
        future = [v for t, i, v in own if (t, i) > (r.ts, r.id) and v is not None]
        assert r.before == sum(past) and r.total == sum(past) + (r.v or 0)
        assert r.last == (past[-1] if past else None)
        assert r.next == (future[0] if future else None)
        assert r.here == (r.v if r.v is not None else r.next)


@pytest.mark.parametrize("heavy", [10**9, 3])
def test_multichannel(spark, monkeypatch, heavy):
    monkeypatch.setattr(ordered, "HEAVY_ROWS", heavy)
    rng = random.Random(5)
    sessions = [(k, t, i, i % 4, 0.0) for k, t, i, _ in sample(150, 1)]
    comms = [(k, t, 1000 + i, 0, float(rng.randint(1, 50))) for k, t, i, _ in sample(120, 2)]
    schema = "k int, ts timestamp_ntz, id int, channel int, value double"
    args = dict(
        sessions=spark.createDataFrame(sessions, schema),
        comms=spark.createDataFrame(comms, schema),
        key="k", ts="ts", ident="id", channel="channel", value="value", days=2,
    )
    touched = {}
    for k, t, i, _, value in comms:
        own = sorted(
            (s[1], s[2], s[3]) for s in sessions
            if s[0] == k and t - timedelta(days=2) <= s[1] <= t
        )
        touched[i] = (value, own)
    got = {r.id: r for r in at.attribute(**args).collect()}
    assert {i: r.touches for i, r in got.items()} == {i: len(own) for i, (_, own) in touched.items()}
    for i, (_, own) in touched.items():
        if own:
            assert (got[i].first_touch.id, got[i].last_touch.id) == (own[0][1], own[-1][1])
        else:
            assert got[i].first_touch is None
    total = sum(v for v, own in touched.values() if own)

    def weights(model, n):
        if model == "first":
            return [1] + [0] * (n - 1)
        if model == "last":
            return [0] * (n - 1) + [1]
        if model == "linear":
            return [1 / n] * n
        return [1] if n == 1 else [0.5, 0.5] if n == 2 else [0.4] + [0.2 / (n - 2)] * (n - 2) + [0.4]

    for model in at.MODELS:
        want = {}
        for value, own in touched.values():
            for (_, _, channel), w in zip(own, weights(model, len(own)) if own else []):
                want[channel] = want.get(channel, 0) + value * w
        credit = {r.channel: float(r.credit) for r in at.multichannel(**args, model=model).collect()}
        assert sum(credit.values()) == pytest.approx(total)
        for channel, value in want.items():
            assert credit.get(channel, 0) == pytest.approx(value, abs=1e-6)


def test_longest_prefix(spark):
    phones = spark.createDataFrame([("7495",), ("7496",), ("8",), ("12",)], "phone string")
    prefixes = spark.createDataFrame(
        [("7", "a"), ("749", "b"), ("7495", "c"), ("84", "d")], "prefix string, prefix_name string"
    )
    got = {r.phone: r.prefix_name for r in longest_prefix(phones, "phone", prefixes).collect()}
    assert got == {"7495": "c", "7496": "b", "8": None, "12": None}


@pytest.mark.parametrize("heavy", [10**9, 3])
def test_null_keys_and_times(spark, monkeypatch, heavy):
    """A NULL key is a group of its own; a NULL time comes first in its key."""
    monkeypatch.setattr(ordered, "HEAVY_ROWS", heavy)
    rng = random.Random(9)
    rows = [
        (None if rng.random() < 0.3 else 1, None if rng.random() < 0.2 else t, i, v)
        for _, t, i, v in sample(120, 8)
    ]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, id int, v int")
    out = running(
        df, ["k"], ["ts", "id"],
        Running("total", "sum", F.col("v")), Running("next", "next", F.col("v"), inclusive=False),
    ).collect()
    place = lambda t, i: (t is not None, t or START, i)
    assert len(out) == len(rows)
    for r in out:
        own = sorted((place(t, i), v) for k, t, i, v in rows if k == r.k)
        here = place(r.ts, r.id)
        assert r.total == sum(v or 0 for p, v in own if p <= here)
        assert r.next == next((v for p, v in own if p > here and v is not None), None)


@pytest.mark.parametrize("heavy", [10**9, 3])
def test_facts_without_a_key_stay(spark, monkeypatch, heavy):
    monkeypatch.setattr(ordered, "HEAVY_ROWS", heavy)
    schema = "k int, ts timestamp_ntz, id int, channel int, value double"
    sessions = spark.createDataFrame([(None, START, 1, 0, 0.0), (7, START, 2, 0, 0.0)], schema)
    comms = spark.createDataFrame([(None, START, 10 + i, 0, 1.0) for i in range(8)] + [(7, START, 30, 0, 1.0)], schema)
    got = {r.id: r.touches for r in at.attribute(sessions, comms, "k", "ts", "id", "channel", "value", 3).collect()}
    assert got == {**{10 + i: 0 for i in range(8)}, 30: 1}
    past = sessions.select("k", "ts", F.col("id").alias("session"))
    seen = at.asof(comms.select("k", "ts", "id"), past, "k", "ts", "id", "ts", "session", ["session"])
    assert {r.id: r.session for r in seen.collect()} == {**{10 + i: None for i in range(8)}, 30: 2}


@pytest.mark.parametrize(
    "places",
    [
        [i * 1e-3 for i in range(3000)],  # all within one instant of any calendar unit
        [float(i) for i in range(2999)] + [1e12],  # one outlier
        [float(i * i * i) for i in range(3000)],  # ever thinner
        [0.0] * 1000 + [float(i) for i in range(2000)],  # a third at one place
    ],
)
def test_pieces_follow_the_rows(spark, monkeypatch, places):
    """As many pieces as the rows need, also where rows tie in the first order column."""
    monkeypatch.setattr(ordered, "HEAVY_ROWS", 100)
    df = spark.createDataFrame([(1, p, i) for i, p in enumerate(places)], "k int, p double, id int")
    line = ordered.Line.of(df, ["k"], ["p", "id"])
    pieces = {r[ordered.PIECE]: r["count"] for r in line.rows.groupBy(ordered.PIECE).count().collect()}
    assert len(pieces) > 15 and max(pieces.values()) <= 250


def test_ordinary_keys_are_not_copied(spark, monkeypatch):
    """Without a heavy key only the counts of heavy keys are written; with one, its rows."""
    written = []
    settle = ordered.settled
    monkeypatch.setattr(ordered, "settled", lambda df, purpose: written.append((purpose, df.count())) or settle(df, purpose))
    df = spark.createDataFrame([(i % 7, i, "x" * 50) for i in range(700)] + [(9, i, "y") for i in range(300)], "k int, id int, text string")
    for heavy, want in ((10**6, [("heavy-keys", 0)]), (200, [("heavy-keys", 1), ("pieces", 300)])):
        monkeypatch.setattr(ordered, "HEAVY_ROWS", heavy)
        written.clear()
        out = running(df, ["k"], ["id"], ordered.number("place"))
        assert written == want
        assert {(r.k, r.id): r.place for r in out.collect()} == {
            (k, i): n for k in {*range(7), 9} for n, i in enumerate(sorted(x for x in ([i for i in range(700) if i % 7 == k] if k < 7 else range(300))), 1)
        }


@pytest.mark.parametrize("heavy, band", [(10**9, 1024), (3, 1024), (10**9, 2), (3, 2)])
def test_touch_paths(spark, monkeypatch, heavy, band):
    """The pairs of a plain interval join, whatever the bands and the heavy visitors."""
    monkeypatch.setattr(ordered, "HEAVY_ROWS", heavy)
    monkeypatch.setattr(at, "BAND", band)
    sessions = [(None if i % 19 == 0 else k, t, i, i % 4) for i, (k, t, _, _) in enumerate(sample(150, 1))]
    comms = [(None if i % 23 == 0 else k, t, 1000 + i) for i, (k, t, _, _) in enumerate(sample(120, 2))]
    out = at.touch_paths(
        spark.createDataFrame(sessions, "k int, ts timestamp_ntz, id int, channel int"),
        spark.createDataFrame(comms, "k int, ts timestamp_ntz, id int"), "k", "ts", "id", 2, ["channel"],
    )
    assert "NestedLoop" not in out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    want = set()
    for k, t, i in comms:
        own = sorted((s[1], s[2], s[3]) for s in sessions if k is not None and s[0] == k and t - timedelta(days=2) <= s[1] <= t)
        want |= {(k, i, sid, place, len(own), channel) for place, (_, sid, channel) in enumerate(own, 1)}
    assert {tuple(r) for r in out.collect()} == want and out.count() == len(want)


def test_bands_are_bounded(spark, monkeypatch):
    """A visitor with all sessions is cut into bands of ``BAND`` sessions."""
    monkeypatch.setattr(at, "BAND", 16)
    rows = [(1, START + timedelta(minutes=i), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, id int")
    late = spark.createDataFrame([(1, START + timedelta(minutes=600), 1)], "k int, ts timestamp_ntz, id int")
    out = at.touch_paths(df, late, "k", "ts", "id", 2, [])
    assert out.count() == 500 and {r.place for r in out.collect()} == set(range(1, 501))


def test_percentile_and_median_are_exact(spark):
    rng = random.Random(11)
    rows = [(rng.choice([1, 2, None]), float(rng.randint(0, 50)) if rng.random() < 0.9 else None) for _ in range(300)]
    df = spark.createDataFrame(rows, "k int, v double")
    p90 = {r.k: r.p for r in ordered.exact_percentile(df, ["k"], "v", "p", 0.9).collect()}
    mid = {r.k: r.m for r in ordered.exact_median(df, ["k"], "v", "m").collect()}
    for k in (1, 2, None):
        own = sorted(v for i, v in rows if i == k and v is not None)
        n = len(own)
        assert p90[k] == own[-(-n * 9 // 10) - 1]
        assert mid[k] == (own[(n + 1) // 2 - 1] + own[n // 2]) / 2
