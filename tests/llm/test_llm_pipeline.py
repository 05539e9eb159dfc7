"""The pipeline: columns, decisions of every stage, and its result."""
import pytest

import corpus_pipeline as cp

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in cp.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages_and_columns(kept):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    for df in kept[:-1]:
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_filters_only_drop_whole_rows(kept):
    for before, after in zip(kept[:3], kept[1:4]):
        assert after.exceptAll(before).count() == 0


def test_near_duplicates_keep_one_of_each_group(spark, kept):
    from ringlens.llm.simhash import near_groups

    groups = near_groups(kept[1]).groupBy("component").agg({"id": "min"}).collect()
    assert sorted(r[1] for r in groups) == sorted(r.doc_id for r in kept[2].collect())


def test_decontamination_leaves_nothing_contaminated(spark, kept):
    from ringlens.llm.decontam import contamination, is_contaminated

    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    bad = {r.key.id for r in contamination(kept[2], bench).filter(is_contaminated()).collect()}
    assert bad and {r.doc_id for r in kept[3].collect()} == {r.doc_id for r in kept[2].collect()} - bad


def test_the_mix_has_the_words_taken(kept):
    from ringlens.llm.mix import mix_sources, taken_words

    want = {r.id: r.taken for r in taken_words(mix_sources(kept[3])).collect() if r.taken}
    got = {}
    for r in kept[4].collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.encode().split())
        assert r.n_chars == len(r.text)
    assert got == want


def test_sharding_keeps_every_row(kept):
    assert kept[5].select(kept[4].columns).exceptAll(kept[4]).count() == 0
    assert kept[5].count() == kept[4].count()
    sizes = [r["count"] for r in kept[5].groupBy("shard").count().collect()]
    assert len(sizes) == 16 and max(sizes) - min(sizes) <= 1


def test_every_stage_takes_an_empty_table(spark, kept):
    for _, stage in cp.STAGES:
        assert stage(spark, kept[0].limit(0), SF).count() == 0


def test_every_stage_takes_nulls_repeats_and_odd_columns(spark):
    rows = [(1, None, "en", None, None), (None, "a b c", None, "s", 5), (None, "a b c", None, "s", 5), (2, "", "en", "s", 0),
            (2, "", "en", "s", 0), (3, "word " * 30000, "en", "t", 150000), (4, "one two three four five", "en", "t", 23)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("shard", "key", "kept", "tag", "score", "doc", "rank"):
        docs = docs.withColumn(name, docs.doc_id.cast("string"))
    counts = {}
    for name, stage in cp.STAGES:
        counts[name] = stage(spark, docs, SF).count()
    assert counts["toxicity"] == 7 and counts["decontamination"] == 7 and counts["sharding"] == 7
    assert counts["near_duplicates"] <= 4
