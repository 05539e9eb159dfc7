"""Divergence audit, MinHash near-duplicates and ranked search against plain versions, and on
awkward tables: nulls, empty and long texts, ties, repeated rows, empty tables, odd columns."""
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ringlens.llm import common, divergence, minhash, search

WORDS = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
COLUMNS = "doc_id long, text string, lang string, source string, term string, n string, rank string, code string, node string, id string, tag string"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def odd_rows():
    rnd = random.Random(8)
    say = lambda n: " ".join(rnd.choice(WORDS) for _ in range(n))
    long, base = say(30000), say(120).split()
    near = [" ".join([*base[:i], "x", *base[i + 1 :]]) for i in range(0, 120, 7)]
    texts = [None, "", " \t", "a", "A", "a b", "Ärger ÄRGER Straße", long, "x " + long, *near, *near[:3], None, say(40), say(40), say(9)]
    ids = [7, 3, 12, 9, 1, 4, 5, 6, 8, *range(20, 20 + len(near)), 21, None, None, None, 2, 2, 10]
    langs = ["en", None, "", "de"]
    rows = [(i, t, langs[p % 4], None if p % 5 == 0 else f"s{p % 3}") for p, (i, t) in enumerate(zip(ids, texts))]
    rows += [rows[-1]] * 3
    return [(*r, *"abcdefg") for r in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


# --- divergence audit


def plain_audit(rows, min_docs, top):
    letters = "[^\x00-\x40\x5b-\x60\x7b-\x7f]+"
    docs = [(la or "", s or "", re.findall(letters, lower(t))) for _, t, la, s, *_ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [(s, w) for la, s, w in docs if la == lang]
        seen = Counter(t for _, w in own for t in set(w))
        terms = {t for t, n in seen.items() if n >= min_docs}
        count, every = defaultdict(Counter), Counter()
        for s, w in own:
            kept = [t for t in w if t in terms]
            count[s].update(kept)
            every.update(kept)
        v = len(terms)
        share = lambda c, t: 1 + 1000000000 * (c[t] + 2) // (sum(c.values()) + 2 * v)
        gap = lambda p, q: (p - q) ** 2 // (p + q)
        for s in count:
            pairs = [(sum(gap(share(count[s], t), share(count[o], t)) for t in terms), o) for o in count if o != s]
            more = [(gap(share(count[s], t), share(every, t)), t) for t in terms if count[s][t] and share(count[s], t) > share(every, t)]
            for part, found, limit in (("pair", pairs, None), ("term", more, top)):
                found = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("min_docs, limits", [(1, {}), (3, {}), (2, {"HELD_TERMS": 5, "HELD_PAIRS": 3}), (10**6, {})])
def test_divergence(spark, odd, monkeypatch, min_docs, limits):
    for name, value in limits.items():
        monkeypatch.setattr(divergence, name, value)
    got = sorted(map(tuple, divergence.source_divergence(odd, min_docs).collect()))
    assert got == plain_audit(odd_rows(), min_docs, 10)


def test_divergence_of_many_sources(spark):
    rnd = random.Random(9)
    rows = [(i, " ".join(rnd.choices(WORDS, k=30)), "en", f"s{rnd.randrange(25)}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert sorted(map(tuple, divergence.source_divergence(docs, 2, 4).collect())) == plain_audit(rows, 2, 4)


def test_the_tree_shares_paths():
    """Rows with a common prefix finish its nodes once, with all that passed through."""
    import pandas as pd

    path = lambda *counts: [np.array([r for r, _ in counts]), np.array([c for _, c in counts])]
    rows = [path((1, 5), (2, 5), (3, 1)), path((1, 5), (2, 5), (4, 1)), path((1, 6), (2, 5))]
    share = lambda n: n * 1000 + 3
    zero = 3
    frame = pd.DataFrame(
        [("en", r, n, share(n), np.full(len(n), zero), t) for (r, n), t in zip(rows, (2, 3, 4))],
        columns=["lang", "rank", "n", "share", "zero", "times"],
    )
    got = Counter()
    for part in divergence._tree(iter([frame.iloc[:2], frame.iloc[2:]])):
        for r in part.itertuples():
            got[r.a, r.b] += r.value
    want = Counter()
    gap = lambda p, q: (p - q) ** 2 // (p + q)
    for (r, n), t in zip(rows, (2, 3, 4)):
        for j in range(len(r)):
            for i in range(j):
                p, q = share(int(n[i])), share(int(n[j]))
                want[int(r[i]), int(r[j])] += t * (gap(p, q) - gap(p, zero) - gap(zero, q) + gap(zero, zero))
    assert got == want
    finished = []
    original = divergence._node_pairs
    path = {"rank": np.array([1, 2, 3]), "share": np.array([9, 9, 9]), "zero": np.array([1, 1, 1]), "times": np.array([5, 5, 2])}
    for a, b, _ in original(path, 2):
        finished += list(zip(a.tolist(), b.tolist()))
    assert finished == [(1, 3), (2, 3)]


def test_shares_outgrow_a_long(spark):
    frame = spark.range(1).select(
        divergence._share(F.lit(10**15), F.lit(3 * 10**15), F.lit(10)).alias("p"),
        divergence._share(F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long")).alias("none"),
    ).first()
    assert frame.p == 1 + 10**9 * (10**15 + 2) // (3 * 10**15 + 20) and frame.none == 2 * 10**9 + 1


def test_divergence_of_nothing(empty):
    assert divergence.source_divergence(empty).count() == 0


# --- MinHash


def plain_groups(rows, percent, width):
    sets = []
    for _, t, *_ in rows:
        w = lower(t).encode().split()
        k = min(width, len(w))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r[0])
    return sets, [(r[0], len(sets[i]), min((x for x in groups[find(i)] if x is not None), default=None)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("percent, width, limits", [(80, 2, {}), (80, 2, {"STAR": 2, "BLOCK": 64, "BLOCK_NODES": 2, "BLOCK_SHINGLES": 500}), (90, 3, {}), (100, 2, {})])
def test_minhash_groups(odd, monkeypatch, percent, width, limits):
    for name, value in limits.items():
        monkeypatch.setattr(minhash, name, value)
    rows = minhash.minhash_groups(odd, percent=percent, width=width).collect()
    _, want = plain_groups(odd_rows(), percent, width)
    assert Counter((r.id, r.n, r.component_id) for r in rows) == Counter(want)
    assert len({r.tag for r in rows}) == len(rows)


def test_minhash_keeps_one_of_each_group(odd, empty):
    kept = minhash.minhash_dedup(odd)
    assert kept.columns == odd.columns
    groups = minhash.minhash_groups(odd).collect()
    assert kept.count() == len({r.group for r in groups})
    smallest = {}
    for r in groups:
        smallest.setdefault(r.group, set()).add(r.id)
    named = [min(x for x in ids if x is not None) for ids in smallest.values() if ids != {None}]
    assert Counter(r.doc_id for r in kept.collect() if r.doc_id is not None) == Counter(named)
    assert minhash.minhash_groups(empty).count() == 0 and minhash.minhash_dedup(empty).count() == 0


def test_stars_lose_no_link(spark, monkeypatch):
    """Texts that share a bucket, of which only some are similar to the centre."""
    rnd = random.Random(10)
    base = [rnd.choice(WORDS) for _ in range(200)]
    rows = []
    for family in range(6):  # families differ by a sixth, members by little
        head = [*base]
        for at in rnd.sample(range(200), 34):
            head[at] = f"f{family}x{at}"
        for member in range(12):
            text = [*head]
            for at in rnd.sample(range(200), rnd.choice([2, 5, 9, 12])):
                text[at] = f"m{member}x{at}"
            rows.append((family * 100 + member, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.component_id for r in minhash.minhash_groups(docs).collect()}
    _, want = plain_groups(rows, 80, 2)
    assert got == {i: c for i, _, c in want}
    # a bucket of everything: the star and the blocks alone must find all
    monkeypatch.setattr(minhash, "BLOCK_NODES", 7)
    signed = minhash.signed_documents(docs, "text", "doc_id").drop("buckets").withColumn("buckets", F.array(F.lit(0).cast("long")))
    signed = minhash.settled(signed, "one-bucket")
    nodes = signed.select(F.col("tag").alias("node"), "n", "buckets")
    roots = {r.node: r.root for r in minhash.linked_nodes(signed, nodes).collect()}
    tags = {r.id: roots.get(r.tag, r.tag) for r in signed.collect()}
    assert len({(tags[i], c) for i, _, c in want}) == len({c for _, _, c in want}) == len(set(tags.values()))


def test_picked_rows_are_those_of_the_nodes(spark):
    rows = spark.range(0, 150_000, 1, 3).select(F.monotonically_increasing_id().alias("tag"), F.col("id").cast("string").alias("packed"))
    tags = [r.tag for r in rows.select("tag").collect()]
    want = {*tags[:2], *tags[49_990:50_010], tags[32_767], tags[32_768], tags[32_769], *tags[7::11], tags[-1]}
    nodes = spark.createDataFrame([(t,) for t in sorted(want)], "node long")
    got = [r.tag for r in minhash.picked(rows, nodes).collect()]
    assert len(got) == len(want) and set(got) == want
    assert minhash.picked(rows, nodes.limit(0)).count() == 0


def test_texts_are_not_dealt_out_to_meet_a_long_list_of_nodes(spark, monkeypatch):
    rnd, plans, settle = random.Random(5), {}, minhash.settled

    def settled(df, purpose):
        plans[purpose] = df._jdf.queryExecution().executedPlan().toString()
        return settle(df, purpose)

    monkeypatch.setattr(minhash, "settled", settled)
    rows = []
    for pair in range(3000):
        words = [f"p{pair}w{rnd.randrange(9)}x{i}" for i in range(30)]
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(words[:-1]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        got = {r.id: r.component_id for r in minhash.minhash_groups(docs).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got == {i: i - i % 2 for i, _ in rows}
    assert "BroadcastHashJoin" in plans["met-texts"] and "SortMergeJoin" not in plans["met-texts"]


def test_signatures_agree_as_often_as_sets_are_similar():
    rnd = np.random.default_rng(11)
    for common, own in ((80, 10), (6, 2), (500, 500), (30, 70)):
        sets = []
        for _ in range(60):
            h = minhash.mix(rnd.integers(0, 1 << 63, common + 2 * own, dtype=np.uint64))
            sets += [np.unique(h[: common + own]), np.unique(np.r_[h[:common], h[common + own :]])]
        found = minhash.signatures(np.cumsum([len(x) for x in sets]), np.concatenate(sets))
        assert abs((found[::2] == found[1::2]).mean() - common / (common + 2 * own)) < 0.05
        for one, row in zip(sets, found):  # every bin holds a member, its own smallest where it has one
            assert set(row) <= set(one)
            smallest = {}
            for x in one[::-1]:
                smallest[int(x) >> 56] = x
            assert all(row[b] == x for b, x in smallest.items())


def test_small_sets_link_with_equal_sets_only():
    for percent in (50, 67, 75, 80, 90, 99):
        least = minhash.smallest_linked(percent)
        able = [n for n in range(1, 300) if 100 * n >= percent * (n + 1)]
        assert least == able[0]


def test_words_are_read_in_blocks(monkeypatch):
    rnd = random.Random(12)
    texts = [" ".join(rnd.choices(WORDS, k=n)).encode() + b"\x0b\x0c\r\n" + "ÄÖ straße".encode() for n in (500, 0, 3, 90)]
    texts += [b"", b" \n", b"one", b"One", "é".encode() * 3000, b"one two"]
    doc, words = minhash.words_of(texts)
    assert np.bincount(doc, minlength=len(texts)).tolist() == [len(t.split()) for t in texts]
    ids = dict(zip((w for t in texts for w in t.lower().split()), words.tolist()))
    assert [ids[w] for t in texts for w in t.lower().split()] == words.tolist() and len(set(ids.values())) == len(ids)
    whole = [x.tolist() for x in minhash.shingle_sets(texts)]
    monkeypatch.setattr(minhash, "BLOCK", 10)
    assert (minhash.words_of(texts)[1] == words).all()
    assert [x.tolist() for x in minhash.shingle_sets(texts)] == whole
    alone = [minhash.shingle_sets([t])[1].tolist() for t in texts]
    assert [x for own in alone for x in own] == whole[1]
    assert minhash.shingle_sets([])[1].tolist() == []


# --- ranked search


def plain_search(rows, items, k):
    term = "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"
    docs = [(r[0], re.findall(term, lower(r[1]))) for r in rows]
    docs = [(i, w, Counter(w)) for i, w in docs if w]
    n_docs, n_terms = len(docs), sum(len(w) for _, w, _ in docs)
    df = Counter(t for _, _, c in docs for t in c)
    out = []
    for item, text in items:
        query, scores = re.findall(term, lower(text)), []
        for i, w, c in docs:
            m = 75 + 25 * len(w) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in query if t in c
            )
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


ITEMS = [(1, "waa wab WAC wad waa"), (2, None), (3, "..."), (4, "nowhere"), (5, "Straße ärger x"), (None, "wba wbb"), (1, "wca"),
         (6, " ".join(WORDS))]


@pytest.mark.parametrize("k, limits", [(20, {}), (3, {"POSTINGS": 40}), (2, {"POSTINGS": 1}), (1, {})])
def test_search(spark, odd, monkeypatch, k, limits):
    for name, value in limits.items():
        monkeypatch.setattr(search, name, value)
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, rank string")
    for size in (8 << 20, 10):
        got = Counter(map(tuple, search.search(odd, items, k, item_bytes=size).collect()))
        assert got == plain_search(odd_rows(), ITEMS, k)


def test_accumulators_are_limited():
    """Once the common term alone can't reach the best, documents with only it are left out."""
    n = 1000
    codes = [[0, 1]] * 3 + [[1]] * (n - 3)
    made = []

    class Watched(search.Shard):
        def best(self, terms, k, floor):
            place, score = super().best(terms, k, floor)
            made.append(len(place))
            return place, score

    import pandas as pd

    shard = Watched(pd.Series(range(n)), [10] * n, codes, [[1] * len(c) for c in codes], n, 10 * n)
    place, score = shard.best([(0, 5000), (1, 7)], 3, 0)
    assert place.tolist() == [0, 1, 2] and (score == score[0]).all()
    whole_score = 5000 * shard.gain[0] + 7 * shard.gain[3]
    assert score[0] == whole_score
    place, _ = shard.best([(0, 5000), (1, 7)], 4, 0)
    assert place.tolist() == [0, 1, 2, 3]
    assert len(shard.best([(1, 7)], 3, int(whole_score))[0]) == 0


def test_search_of_nothing(spark, odd, empty):
    items = spark.createDataFrame([(i, t) for i, t in ITEMS], "item_id long, text string")
    for found in (search.search(empty, items), search.search(odd, items.limit(0))):
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_blocks_of_terms():
    raw = "Ab-c É1 2x".encode()
    table = common.plain_bytes(b"0123456789")
    assert [w for b in common.term_blocks(raw, table, 2) for w in b] == [b"ab", b"c", "É1".encode(), b"2x"]
    assert [w for b in common.term_blocks(raw, common.plain_bytes()) for w in b] == [b"ab", b"c", "É".encode(), b"x"]
