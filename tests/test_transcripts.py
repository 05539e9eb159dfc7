"""The transcript index against a search of all transcripts, and stored daily statistics."""
import random
import re
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ringlens.operators import flat as fl
from ringlens.operators import transcripts as tr
from ringlens.sources import store as st


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(13)
    words = ["Lime", "plum", "Ärger", "日本語", "a.b", "hazel nut", "PEAR", "figs", "kiwi", "date"]
    out = [(i, " ".join(rng.choices(words, k=rng.randrange(25)))) for i in range(200)]
    return out + [(900, None), (901, ""), (902, "ab"), (903, "the zebra" + " x" * 30000 + " quagga.")]


@pytest.fixture(scope="module")
def index(spark, rows, tmp_path_factory):
    index = tr.TranscriptIndex(str(tmp_path_factory.mktemp("index")), "doc", "said", 16)
    tr.build(spark.createDataFrame(rows, "doc long, said string"), index)
    return index


@pytest.mark.parametrize("texts", [["plum pear"], ["LIME", "zebra"], ["quagga"], ["nowhere"], ["ärger"], ["本語"], ["x"], ["a.b fi", "nut k"], ["日本語 日"]])
def test_search_finds_what_a_scan_finds(spark, rows, index, texts):
    every = spark.createDataFrame(rows, "doc long, said string")
    want = sorted(map(tuple, fl.phrase_matches(every, "said", texts, "\\.").collect()))
    assert sorted(map(tuple, tr.search(spark, index, texts, "\\.").collect())) == want


def test_only_candidates_are_read(spark, index):
    found = tr.search(spark, index, ["quagga"], "\\.")
    text = found._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    filters = re.findall(r"PartitionFilters: \[(.*?)\]\n", text)
    assert any("bucket" in f for f in filters)
    assert tr.candidates(spark, index, ["quagga"]).count() == 1
    assert tr.candidates(spark, index, ["lime", "qu"]) is None
    with pytest.raises(ValueError):
        tr.search(spark, index, [], "\\.")


def test_postings_are_listed_by_blocks(spark, tmp_path, monkeypatch):
    """A gram has a row per block and not per transcript; an id with two texts is found by either."""
    monkeypatch.setattr(tr, "BLOCK", 40)
    rows = [(i, f"plum {i % 7} pear") for i in range(60)] + [(5, "a zebra"), (5, "a quagga"), (8, "zeb bra")]
    every = spark.createDataFrame(rows, "doc long, said string").coalesce(1)
    index = tr.TranscriptIndex(str(tmp_path / "index"), "doc", "said", 4)
    tr.build(every, index)
    stored = spark.read.parquet(index.folder("postings"))
    lists = stored.filter("gram = 'plu'").select(F.size("ids")).collect()
    assert sum(r[0] for r in lists) == 60 and 1 < len(lists) < 60
    for texts in (["zebra"], ["QUAGGA", "3 pe"]):
        want = sorted(map(tuple, fl.phrase_matches(every, "said", texts, "\\.").collect()))
        assert sorted(map(tuple, tr.search(spark, index, texts, "\\.").collect())) == want


def test_grams_are_substrings(spark):
    from ringlens.operators.conditions import grams

    texts = ["abcab", "", "ab", "日本語x", "aaaa"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", grams(F.col("t"), F.array(F.lit(0), F.lit(2), F.lit(3))).alias("g"))
    for r in frame.collect():
        want = {""} | {r.t[i : i + k] for k in (2, 3) for i in range(len(r.t) - k + 1)}
        assert set(r.g) == want and len(r.g) == len(want)


def test_increments_add_up(spark, tmp_path):
    """Three increments, one late and one repeated, equal one run over all facts."""
    rng = random.Random(14)
    start = datetime(2024, 1, 20)
    facts = [(rng.randrange(4), start + timedelta(hours=rng.randrange(900)), float(rng.randrange(100)), rng.choice(["visit", "goal"])) for _ in range(300)]

    def split(rows):
        frame = spark.createDataFrame(rows, "campaign_id int, date_time timestamp_ntz, amount double, kind string")
        return {k: frame.filter(F.col("kind") == k).drop("kind") for k in ("visit", "goal")}

    target = st.by_month(str(tmp_path / "daily"), "day")
    st.create(fl.daily_states(split(facts[:100])).withColumn("increment", F.lit(0)), target)
    for n, part in ((1, facts[100:250]), (2, facts[250:]), (1, facts[100:250])):
        st.add_daily(split(part), target, n)
    # a correction: the amount of one row goes down by five, without a new row
    want = {tuple(r) for r in fl.campaign_daily(split(facts)).collect()}
    assert {tuple(r) for r in st.daily(spark, target, ["visit", "goal"]).collect()} == want
    months = {r.month for r in st.stored(spark, target).select("month").distinct().collect()}
    only = [f for f in facts if f[1].month == 2][:3]
    assert st.add_daily(split(only), target, 3) == [202402] and len(months) == 2
    total = sum(Decimal(r.v) for r in st.stored(spark, target).collect())
    assert total == sum(Decimal(f[2]) for f in facts) + sum(Decimal(f[2]) for f in only)
