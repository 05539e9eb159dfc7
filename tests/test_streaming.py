"""Streaming jobs over landing folders that grow between runs."""
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ringlens.session import shared_dir
from ringlens.streaming import live, stateful

START = datetime(2024, 1, 1)
SCHEMA = "ext_id string, ts timestamp_ntz"


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_counts_are_updated_across_runs(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, source, [(str(i), START + timedelta(minutes=i)) for i in range(0, 10)])

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        live.drain(live.visits_live(stream, span="10 minutes", step="10 minutes"), out, "update")
        rows = live.latest_update(live.drained(spark, out), ["from", "till"]).collect()
        return {r["from"].minute: r.visits for r in rows}

    assert run() == {0: 10}
    land(spark, source, [("x", START + timedelta(minutes=5)), ("y", START + timedelta(minutes=12))])
    assert run() == {0: 11, 10: 1}
    assert run() == {0: 11, 10: 1}


def test_stream_without_input(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    stream = spark.readStream.schema(SCHEMA).parquet(str(source))
    live.drain(live.visits_live(stream), out, "update")
    assert live.latest_update(live.drained(spark, out), ["from", "till"]).count() == 0


def test_repeated_ids_come_out_once(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, source, [("a", START), ("a", START + timedelta(minutes=1)), ("b", START)])
    for extra in ([], [("a", START + timedelta(minutes=2)), ("c", START)]):
        if extra:
            land(spark, source, extra)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        live.drain(live.ingest_stream(stream), out)
    assert sorted(r.ext_id for r in live.drained(spark, out).collect()) == ["a", "b", "c"]


def test_new_pages_are_processed_alone(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    page = "<h1>T</h1><table><tr><th>Метод</th><th><code>get.{0}</code></th></tr></table>"

    def run():
        live.drain(live.pages_results(live.page_stream(spark, str(source))), out)
        return {r.name: r.batch for r in live.drained(spark, out).collect()}

    (source / "a.html").write_text(page.format("a"))
    assert run() == {"get.a": 0}
    (source / "b.HTML").write_text(page.format("b"))
    (source / "c.txt").write_text(page.format("c"))
    assert run() == {"get.a": 0, "get.b": 1}


def test_shared_folder_is_taken_from_the_session(spark):
    def session(master, **conf):
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    named = session("yarn", **{"spark.checkpoint.dir": "hdfs:/work/"})
    assert shared_dir(named, "x").startswith("hdfs:/work/x-")
    unset = session("yarn", **{"spark.sql.warehouse.dir": "hdfs:/warehouse/"})
    assert shared_dir(unset, "x").startswith("hdfs:/warehouse/_work/x-")
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


@pytest.mark.parametrize("parts", [0, 1, 5])
def test_streams_read_files_and_folders(spark, tmp_path, parts):
    """A table is a file or a folder of part files; a neighbour with a like name is not it."""
    rows = spark.range(100).withColumnRenamed("id", "event_id")
    rows.write.parquet(str(tmp_path / "events_old.parquet"))
    if parts:
        rows.repartition(parts).write.parquet(str(tmp_path / "events.parquet"))
    else:
        rows.toPandas().to_parquet(tmp_path / "events.parquet")
    out = str(tmp_path / "out")
    live.drain(live.table_stream(spark, str(tmp_path), "events"), out)
    assert sorted(r.event_id for r in live.drained(spark, out).collect()) == list(range(100))


VISITS = "visitor_id int, date_time timestamp_ntz"


def visit_files(spark, source, batches):
    for rows in batches:
        spark.createDataFrame([(v, START + timedelta(minutes=m)) for v, m in rows], VISITS).coalesce(1).write.mode("append").parquet(source)


def sessions_of(batches, gap=30):
    """Sessions (visitor, first, last, visits) in minutes."""
    seen = {}
    for rows in batches:
        for v, m in rows:
            seen.setdefault(v, []).append(m)
    out = []
    for v, own in seen.items():
        own.sort()
        run = [own[0]]
        for m in own[1:]:
            if m - run[-1] > gap:
                out.append((v, run[0], run[-1], len(run)))
                run = []
            run.append(m)
        out.append((v, run[0], run[-1], len(run)))
    return out


def minutes(rows):
    to = lambda t: (t.replace(tzinfo=None) - START).total_seconds() / 60
    return sorted(
        ((r.visitor_id, to(r.start_time), to(r.last_time), r.visits) for r in rows.selectExpr(
            "visitor_id", "CAST(start_time AS timestamp_ntz) AS start_time", "CAST(last_time AS timestamp_ntz) AS last_time", "visits"
        ).collect()),
        key=str,
    )


def test_open_sessions_are_rows(spark, tmp_path):
    """Sessions grow, merge across batches, end with time, and equal the batch form."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    batches = [
        [(1, 0), (1, 10), (2, 5), (None, 1)],
        [(1, 35), (2, 50), (3, 40), (1, 20)],
        [(3, 200), (4, 190), (3, 195)],
    ]
    for n in range(1, 4):
        visit_files(spark, source, batches[n - 1 : n])
        stream = spark.readStream.schema(VISITS).option("maxFilesPerTrigger", 1).parquet(source)
        stateful.open_sessions(stream, out, 1800, late_seconds=3600)
        want = sessions_of(batches[:n])
        newest = max(m for rows in batches[:n] for _, m in rows)
        live_now = [s for s in want if newest - s[2] <= 30 + 60]
        assert minutes(stateful.open_now(spark, out)) == sorted(live_now, key=str)
        assert minutes(stateful.ended(spark, out)) == sorted([s for s in want if s not in live_now], key=str)
    # what the batch form calls live are the visits of the sessions that are open without the late hour
    rows = spark.read.parquet(source)
    live_visitors = {r.visitor_id for r in live.visits_last(rows, "date_time").collect()}
    assert live_visitors == {s[0] for s in want if newest - s[2] < 30}


def test_late_visits_open_nothing(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    visit_files(spark, source, [[(1, 0)], [(1, 500)], [(2, 100), (1, 510)]])
    stateful.open_sessions(spark.readStream.schema(VISITS).option("maxFilesPerTrigger", 1).parquet(source), out, 1800)
    assert minutes(stateful.open_now(spark, out)) == [(1, 500, 510, 2)]
    assert minutes(stateful.ended(spark, out)) == [(1, 0, 0, 1)]
    assert sorted(r.late for r in spark.read.parquet(f"{out}/late").collect()) == [0, 0, 1]


CALLS = "ext_id string, n int, good boolean"


def call_file(spark, source, rows):
    spark.createDataFrame(rows, CALLS).coalesce(1).write.mode("append").parquet(source)


def take(spark, source, out):
    stream = spark.readStream.schema(CALLS).option("maxFilesPerTrigger", 1).parquet(source)
    stateful.ledgered(stream, out, F.col("good"), ["n"])
    return sorted((r.ext_id, r.n) for r in stateful.loaded(spark, out).collect()), sorted(
        (r.ext_id, r.ok) for r in stateful.ledger(spark, out).select("ext_id", "ok").collect()
    )


def test_ledger_counts_attempts(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    first = [("a", 1, True), ("a", 2, True), ("b", 1, False), ("c", 1, False), ("c", 2, False), (None, 1, True), ("d", 1, None)]
    call_file(spark, source, first)
    state = take(spark, source, out)
    assert state == ([("a", 1)], [("a", True), ("b", False), ("c", False), ("c", False), ("d", False)])
    call_file(spark, source, [("b", 3, True), ("c", 3, False), ("c", 4, True)])
    loaded, ledger = take(spark, source, out)
    assert loaded == [("a", 1), ("b", 3)] and ledger.count(("c", False)) == 3
    # a late repeat of what was loaded or given up leaves both tables as they are
    call_file(spark, source, [r for r in first if r[0] in ("a", "b", "c")])
    assert take(spark, source, out) == (loaded, ledger)


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    """The same batch again, after its folders were written but before it was committed."""
    source, out = str(tmp_path / "in"), tmp_path / "out"
    call_file(spark, source, [("a", 1, True), ("b", 1, False)])
    take(spark, source, str(out))
    call_file(spark, source, [("b", 2, False), ("b", 3, False), ("b", 4, True), ("e", 1, True)])
    state = take(spark, source, str(out))
    (out / "progress" / "commits" / "1").unlink()
    for crc in (out / "progress" / "commits").glob(".1.crc"):
        crc.unlink()
    assert take(spark, source, str(out)) == state == ([("a", 1), ("e", 1)], [("a", True), ("b", False), ("b", False), ("b", False), ("e", True)])


def test_arrivals_of_many_files_are_one_batch(spark, tmp_path):
    inbox, out = str(tmp_path / "inbox"), str(tmp_path / "out")
    for n in (1, 2, 3):
        rows = spark.range(20).select(F.col("id").alias("ext_id"), F.lit(n).cast("long").alias("n")).repartition(4)
        stateful.ledgered(live.arrived(rows, inbox), out, F.col("n") == 2, ["n"])
    held = stateful.ledger(spark, out).groupBy("batch").count().collect()
    assert {tuple(r) for r in held} == {(0, 20), (1, 20)}
    assert stateful.loaded(spark, out).count() == 20
