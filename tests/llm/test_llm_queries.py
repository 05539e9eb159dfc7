"""Registered queries of the package against SQL twins or brute force, whole tables."""
import hashlib
import re
import zlib
from collections import Counter

import pytest
import xxhash

from compare import compare, connect
from ringlens.llm import queries as q

SF = "/root/testdata/sf0.001"
NATIVE = [n for n in q.QUERIES if re.match(r"op(1|2|5|10)_", n)]
PER_DOCUMENT = sorted(n for n in q.QUERIES if not re.match(r"op(11|13)_", n))


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(q.SQL))
def test_twin(spark, name):
    assert compare(q.QUERIES[name](spark, SF), connect(SF), q.SQL[name].strip()) is None


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_every_document_is_answered(spark, docs, name):
    rows = q.QUERIES[name](spark, SF).collect()
    assert Counter(r.doc_id for r in rows) == Counter(docs.keys())


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_hold_no_python(spark, name):
    df = q.QUERIES[name](spark, SF)
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", text)


def simhash(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_by_brute_force(spark, docs):
    codes = {i: simhash(t) for i, t in docs.items()}
    root = {i: i for i in docs}
    changed = True
    while changed:
        changed = False
        for a in docs:
            for b in docs:
                if (codes[a] ^ codes[b]).bit_count() <= 2 and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in q.op8_simhash_near_dedup(spark, SF).collect()}
    assert got == {i: (f"{codes[i]:016x}", root[i]) for i in docs}


def test_shards_are_exact_and_gapless(spark, docs):
    rows = q.op10_shard_rows(spark, SF).collect()
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    for r in rows:
        raw = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)


def test_mix_is_repeatable_and_near_its_targets(spark, docs):
    one = q.op2_mix_sources(spark, SF).collect()
    again = q.op2_mix_sources(spark, SF).collect()
    assert sorted(one) == sorted(again)
    assert all(0 <= r.taken <= 2 * r.size for r in one)
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source").collect()}
    taken, target = Counter(), {}
    for r in one:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    block = sum(target.values()) / min(65536, sum(target.values())) + 1
    assert all(abs(taken[s] - t) <= max(12 * block, 0.01 * t) for s, t in target.items())


def test_token_counts_equal_the_tokenizer(spark, docs):
    from tokenizers import Tokenizer, models, normalizers

    v = q.read_vocabulary(q.VOCABULARY)
    tok = Tokenizer(models.Unigram(list(v.pieces), unk_id=0, byte_fallback=True))
    tok.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    want = {i: len(tok.encode(t, add_special_tokens=False).ids) for i, t in docs.items()}
    assert {r.doc_id: r.n_tokens for r in q.op4_token_count(spark, SF).collect()} == want


@pytest.mark.parametrize("name, label, least", [("op6_toxicity", "toxic", 0.9), ("op7_quality", "quality", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.1"
    rows = q.QUERIES[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out")
    good, n = rows.selectExpr(f"sum(int(predicted = {label}))", "count(*)").first()
    assert n > 500 and good / n >= least + 0.05
    assert rows.filter("score < 0 OR score > 1").count() == 0


def test_held_out_rows_are_those_of_the_rule(spark):
    for r in q.op7_quality(spark, SF).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == (r.score >= 0.3)


def test_removed_words_leave_the_rest_as_it_was(spark, docs):
    for r in q.op9_substring_dedup(spark, SF).collect():
        words = docs[r.doc_id].encode().split()
        assert r.n_words == len(words)
        if not r.n_removed:
            assert r.kept_sha256 == hashlib.sha256(b" ".join(words)).hexdigest()


def test_minhash_by_brute_force(spark, docs):
    sets = {}
    for i, t in docs.items():
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset(w)
    root = {i: i for i in docs}
    links = [
        (a, b) for a in docs for b in docs
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    assert any(sets[a] != sets[b] for a, b in links)
    for _ in docs:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in q.op12_minhash_near_dedup(spark, SF).collect()}
    assert got == {i: (len(sets[i]), root[i], i == root[i]) for i in docs}
