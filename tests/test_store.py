"""Stored tables: what changes touch, what they leave, and repeats."""
import os
from datetime import date

import pytest

from ringlens import session
from ringlens.sources import store as st

SCHEMA = "ext_id int, modified int, amount int"


def files(path):
    found = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    return {f: os.stat(f).st_mtime_ns for f in found}


def held(spark, target):
    return {r.ext_id: (r.modified, r.amount) for r in st.stored(spark, target).collect()}


def test_upsert_touches_its_partitions_only(spark, tmp_path):
    target = st.by_bucket(str(tmp_path / "t"), ["ext_id"], 8)
    st.create(spark.createDataFrame([(i, 1, i) for i in range(200)], SCHEMA), target)
    before = files(target.path)
    change = spark.createDataFrame([(3, 2, 30), (3, 3, 31), (4, 0, 99), (1000, 5, 7)], SCHEMA)
    parts = st.upsert(change, target, ["ext_id"], ["modified"])
    want = {**{i: (1, i) for i in range(200)}, 3: (3, 31), 1000: (5, 7)}
    assert 0 < len(parts) <= 3 and held(spark, target) == want
    kept = {d for d in os.listdir(target.path) if d.startswith("bucket=") and int(d[7:]) not in parts}
    for folder in kept:
        assert files(os.path.join(target.path, folder)).items() <= before.items()
    assert st.upsert(change, target, ["ext_id"], ["modified"]) == parts and held(spark, target) == want
    assert st.upsert(change.limit(0), target, ["ext_id"], ["modified"]) == [] and held(spark, target) == want


def test_a_tie_goes_to_the_update(spark, tmp_path):
    target = st.by_bucket(str(tmp_path / "t"), ["ext_id"], 2)
    st.create(spark.createDataFrame([(1, 5, 0), (None, 5, 0)], SCHEMA), target)
    st.upsert(spark.createDataFrame([(1, 5, 9), (None, 4, 9)], SCHEMA), target, ["ext_id"], ["modified"])
    assert held(spark, target) == {1: (5, 9), None: (5, 0)}


def test_deleted_partitions_are_empty(spark, tmp_path):
    target = st.by_bucket(str(tmp_path / "t"), ["ext_id"], 4)
    st.create(spark.createDataFrame([(i, 1, i) for i in range(40)], SCHEMA), target)
    of = {r.ext_id: r.bucket for r in st.stored(spark, target).collect()}
    gone = [i for i, b in of.items() if b == of[0]] + [999]
    for _ in range(2):
        st.delete(spark.createDataFrame([(i,) for i in gone], "ext_id int"), target, ["ext_id"])
        assert set(held(spark, target)) == set(of) - set(gone)
    assert not os.path.exists(f"{target.path}/bucket={of[0]}")


def test_costs_by_month(spark, tmp_path):
    target = st.by_month(str(tmp_path / "c"), "day")
    days = "campaign_id int, day date, daily_cost double"
    st.create(spark.createDataFrame([(1, date(2024, 1, 31), 5.0), (1, date(2024, 3, 1), 6.0), (1, date(2024, 2, 2), 7.0)], days), target)
    before = files(f"{target.path}/month=202403")
    uploads = spark.createDataFrame(
        [(1, "2024-01-31 05:00:00", "2024-02-01 07:00:00", 10.0, 1), (1, "2024-02-02 00:00:00", "2024-02-02 00:00:00", 0.0, 2)],
        "campaign_id int, date_from string, date_till string, cost double, upload_id int",
    )
    for _ in range(2):
        assert st.upsert_costs(uploads, target, ["upload_id"]) == [202401, 202402]
        got = {(r.day.isoformat(), r.daily_cost) for r in st.stored(spark, target).collect()}
        assert got == {("2024-01-31", 5.0), ("2024-02-01", 5.0), ("2024-03-01", 6.0)}
    assert files(f"{target.path}/month=202403") == before


def test_work_folders_can_be_released(spark):
    path = session.shared_dir(spark, "spare")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    kept, session.WORK[:] = session.WORK[:-1], [path]
    assert session.release(spark) == 1 and not os.path.exists(local)
    session.WORK[:] = kept


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    local = SimpleNamespace(conf={"spark.sql.warehouse.dir": "file:/tmp/w"}, sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError):
        session.shared_dir(local, "x")


def test_settled_tables_are_packed_tightly(spark):
    words = " ".join(f"word{i * 7919 % 1000}" for i in range(2000))
    frame = spark.range(200).selectExpr("id", f"concat(id, ' {words}') AS text")
    back = session.settled(frame, "packed")
    assert sorted(r.id for r in back.collect()) == list(range(200))
    assert back.inputFiles() and all(f.endswith(".zstd.parquet") for f in back.inputFiles())
