"""Each operator against a plain version of itself, and on awkward tables: null and empty
texts, null ids, repeated rows, ties, long texts, empty tables, clashing column names."""
import hashlib
import math
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ringlens.llm import decontam, exact, labelled, lm, mix, quality, shard, simhash, substring, tokens, toxicity

WORDS = [f"w{i}" for i in range(40)]
COLUMNS = "doc_id long, text string, source string, key string, tag string, run string, rank string, size string"


def odd_rows():
    rnd = random.Random(5)
    long = " ".join(rnd.choice(WORDS) for _ in range(20000))
    passage = " ".join(rnd.choice(WORDS) for _ in range(60))
    texts = [
        None, "", "  \t\n", "a b", "a  b", "ab ", "ÄB", long, "x " + long, passage, passage + " tail", "head " + passage,
        "der " * 50, "der " * 50, None, "a b",
    ]
    ids = [7, 3, 12, 9, 1, 4, 5, 6, 8, 10, 11, None, 13, 14, None, 9]
    return [(i, t, None if t == "ÄB" else f"s{(i or 0) % 3}", "k", "t", "r", "x", "y") for i, t in zip(ids, texts)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


# --- exact duplicates


def test_exact_groups(odd):
    groups = {}
    for i, t, *_ in odd_rows():
        groups.setdefault("".join((t or "").split()), []).append((-len(t or ""), i is None, i))
    want = Counter()
    for text, members in groups.items():
        keep = sorted(members, key=lambda m: (m[0], m[1], m[2] or 0))[0][2]
        for _, _, i in members:
            want[(i, keep, len(members), hashlib.sha256(text.encode()).hexdigest())] += 1
    rows = exact.exact_groups(odd).collect()
    assert Counter((r.id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == want
    assert sum(r.kept for r in rows) == len(groups)


def test_exact_groups_of_any_id(spark):
    least = -(1 << 63)
    rows = spark.createDataFrame([(least, "a"), (5, "a"), (None, "a"), (7, "b")], "doc_id long, text string")
    assert {(r.id, r.keep_id, r.kept) for r in exact.exact_groups(rows).collect()} == {
        (least, least, True), (5, least, False), (None, least, False), (7, 7, True)}
    named = spark.createDataFrame([("x9", "a"), ("x10", "a "), ("", "c")], "doc_id string, text string")
    assert {(r.id, r.keep_id) for r in exact.exact_groups(named).collect()} == {("x9", "x10"), ("x10", "x10"), ("", "")}


def test_exact_dedup_of_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "x"), (2, "x"), (2, "other"), (None, "z"), (None, "z"), (3, None), (4, " ")], "doc_id long, text string")
    kept = sorted(map(tuple, exact.exact_dedup(docs).collect()), key=str)
    assert kept == sorted([(1, "x"), (2, "other"), (None, "z"), (4, " ")], key=str)


def test_exact_dedup_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 1), (2, "a  b", 2), (3, "c", 3)], "doc_id long, text string, n int")
    assert sorted(map(tuple, exact.exact_dedup(docs).collect())) == [(2, "a  b", 2), (3, "c", 3)]


# --- mixing


def filled(sizes, weights, percent):
    """Targets by repeated sharing."""
    total, left = percent * sum(sizes.values()) / 100, dict(sizes)
    target = {}
    while left:
        w = sum(weights[s] for s in left)
        over = [s for s in left if total * weights[s] / w > 2 * sizes[s]]
        if not over:
            return target | {s: total * weights[s] / w for s in left}
        for s in over:
            target[s] = 2.0 * sizes[s]
        total -= sum(target[s] for s in over)
        left = {s: n for s, n in left.items() if s not in over}
    return target


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 1000, 5, 70], [0, 0, 9], [5], [3, 900, 1, 1, 1, 1, 800], [0, 0]])
def test_targets_are_filled_up_to_twice_the_size(spark, sizes):
    names = [f"s{i}" for i in range(len(sizes))]
    got = {r.source: r.target for r in mix.source_targets(spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long"), (3, 1, 2), 150).collect()}
    want = filled(dict(zip(names, sizes)), {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}, 150)
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], abs_tol=1e-9) for s in want)


def test_mix_pieces(spark, odd):
    found = mix.mix_sources(odd)
    pieces = found.pieces.collect()
    rows = {r.tag: r for r in mix.taken_words(found).collect()}
    assert sorted(r.size for r in rows.values()) == sorted(len((t or "").encode().split()) for _, t, *_ in odd_rows())
    covered = Counter()
    for p in pieces:
        for w in range(p.first_word, p.first_word + p.n_words):
            covered[p.tag, p.epoch, w] += 1
    assert set(covered.values()) == {1}
    per_source = Counter()
    for tag, *_ in covered:
        per_source[rows[tag].source] += 1
    for x in found.sources.collect():
        assert per_source[x.source] == x.end <= 2 * x.source_size
    assert len({(p.sid, p["rank"]): p.slot for p in pieces}) == len({p.slot for p in pieces})
    for r in rows.values():
        own = [p for p in pieces if p.tag == r.tag]
        assert (r.first_slot, r.n_slots) == (min((p.slot for p in own), default=None), len(own))


def test_shares_come_from_the_slots(spark, monkeypatch):
    """A good sequence gives every source its target and every stretch of slots the shares; a
    bad one gives other shares."""
    docs = spark.createDataFrame([(i, "w " * (1 + i % 50), f"s{i % 4}") for i in range(800)], "doc_id long, text string, source string")

    def mixed():
        found = mix.mix_sources(docs)
        pieces = found.pieces.select("slot", "sid", "n_words").collect()
        return {x.sid: x.target for x in found.sources.collect()}, pieces

    target, pieces = mixed()
    total, slots = sum(target.values()), max(p.slot for p in pieces) + 1
    for cut in (0.1, 0.25, 0.5, 0.9, 1.0):
        own = Counter()
        for p in pieces:
            if p.slot < cut * slots:
                own[p.sid] += p.n_words
        assert all(abs(own[x] - cut * t) <= 12 * (total / slots + 1) for x, t in target.items()), (cut, own, target)
    monkeypatch.setattr(mix, "GOLDEN", 1 << 30)  # four points only
    _, bad = mixed()
    own = Counter()
    for p in bad:
        own[p.sid] += p.n_words
    assert any(abs(own[x] - t) > 0.2 * t for x, t in target.items())


def test_the_mix_comes_in_the_order_of_slots(spark):
    docs = spark.createDataFrame([(i, f"d{i} " * 20, f"s{i % 3}") for i in range(300)], "doc_id long, text string, source string")
    found = mix.mix_sources(docs)
    slot = {}
    for p in found.pieces.collect():
        slot[p.id, p.epoch] = min(slot.get((p.id, p.epoch), (1 << 60, 0)), (p.slot, p.position))
    rows = mix.mixed_documents(docs, n_chars=None, stretch=1 << 20).collect()  # one stretch: the mix itself
    assert [r.doc_id for r in rows] == [i for (i, _), _ in sorted(slot.items(), key=lambda x: x[1])]


def test_schedule_has_low_discrepancy(spark):
    sources = spark.createDataFrame([(1, 500), (2, 300), (3, 200)], "sid int, quota long")
    rows = sorted(mix.schedule(spark, sources, 1000).collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(1000))
    seen = Counter()
    for i, r in enumerate(rows, 1):
        assert r["rank"] == seen[r.sid]
        seen[r.sid] += 1
        assert all(abs(seen[s] - i * q / 1000) < 8 for s, q in ((1, 500), (2, 300), (3, 200)))


def test_mixed_documents(odd):
    rows = mix.mixed_documents(odd, n_chars=None)
    assert rows.columns == odd.columns
    taken = sum(r.taken for r in mix.taken_words(mix.mix_sources(odd)).collect())
    assert sum(len(r.text.encode().split()) for r in rows.collect()) == taken


# --- LM scoring


def test_lm_against_plain_sums(spark):
    texts = ["the cat sat on the mat the cat sat on the mat " * 30, "", "one", "the dog lay on the mat"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)] + [(None, None)], "doc_id long, text string")
    flat, table = lm.train(docs)
    p = lm.split(flat)
    n, total = lm.score_texts(flat, table, texts)
    for text, words, score in zip(texts, n, total):
        ids = [int(table[h]) for _, hs in lm.hashed_words([text]) for h in hs]
        want = 0.0
        for i, own in enumerate(ids):
            h = p["hidden"].astype(float)
            for k, side in enumerate(lm.SIDES):
                h = h + p["inputs"][k][ids[i + side] if 0 <= i + side < len(ids) else lm.TOKENS]
            h = np.tanh(h)
            probability = []
            z = np.exp(h @ p["classes"] + p["class_bias"])
            z /= z.sum()
            for c in range(lm.CLASSES):
                y = np.exp(h @ p["members"][c] + p["member_bias"][c])
                probability += list(z[c] * y / y.sum())
            assert math.isclose(sum(probability), 1, rel_tol=1e-4)
            want += math.log(probability[own])
        assert words == len(ids) and math.isclose(score, want, rel_tol=1e-3, abs_tol=1e-3)
    start = lm.start_parameters(np.ones(lm.TOKENS))
    assert total[0] > lm.score_texts(start, table, texts)[1][0]


def test_lm_learns_from_every_word(spark):
    """In texts of four words, every side of every word has something to learn from."""
    texts = ["red green blue grey", "one two three four"] * 40
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    start = lm.split(lm.start_parameters(np.ones(lm.TOKENS)))
    for rounds in (1, lm.ROUNDS, 3):
        flat, table = lm.train(docs, rounds=rounds)
        learnt = lm.split(flat)
        for text in texts[:2]:
            ids = [int(table[h]) for _, hs in lm.hashed_words([text]) for h in hs]
            for k, side in enumerate(lm.SIDES):
                for place in range(len(ids)):
                    if 0 <= place + side < len(ids):
                        at = ids[place + side]
                        assert np.abs(learnt["inputs"][k][at] - start["inputs"][k][at]).max() > 1e-3, (rounds, side, place)


@pytest.mark.parametrize("known", [None, 0])
def test_lm_gives_rare_words_their_own_share(spark, monkeypatch, known):
    """A shared token's probability is split by word counts, whether these are known or joined."""
    if known is not None:
        monkeypatch.setattr(lm, "KNOWN", known)
    head = " ".join(f"w{i}" for i in range(lm.FREQUENT))
    tail, junk = " ".join(f"t{i}" for i in range(4000)), " ".join(f"u{i}" for i in range(2000))
    texts = [head] * 3 + [tail] * 2 + [junk, "w1 t1 u1 w2", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    flat, table = lm.train(docs)
    p, hashes = lm.split(flat), [np.concatenate([h for _, h in lm.hashed_words([t or ""])] or [np.empty(0, np.int64)]) for t in texts]
    words = Counter(int(h) for hs in hashes for h in hs)
    assert len(words) == lm.FREQUENT + 6000
    tokens = Counter()
    for h, n in words.items():
        tokens[int(table[np.int64(h)])] += n
    got = {r.id: r for r in lm.lm_scores(docs).collect()}
    for i, hs in enumerate(hashes):
        ids = np.array([int(table[h]) for h in hs], np.int64)
        want = lm.log_probabilities(p, lm.contexts(np.zeros(len(ids), np.int64), ids), ids).sum()
        want += sum(math.log(words[int(h)] / tokens[t]) for h, t in zip(hs, ids))
        assert got[i].n_words == len(hs)
        assert math.isclose(got[i].log_prob, want, rel_tol=1e-3, abs_tol=1e-6), (i, got[i].log_prob, want)


def test_lm_on_odd_tables(odd, empty):
    rows = lm.lm_scores(odd, rounds=1).collect()
    assert sorted(r.n_words for r in rows) == sorted(len((t or "").encode().split()) for _, t, *_ in odd_rows())
    assert all((r.log_prob == 0) == (r.n_words == 0) for r in rows)
    assert lm.lm_scores(empty).count() == 0


# --- token counts


def test_ties_go_to_the_longest_last_piece(spark, odd, empty):
    v = tokens.Vocabulary((("a", -1.0), ("b", -1.0), ("ab", -2.0), ("bb", -2.0), ("▁", -1.0), ("abb", -3.0), ("▁a", -2.0)))
    from tokenizers import Tokenizer, models, normalizers

    model = Tokenizer(models.Unigram([("<unk>", -9.0), *v.pieces], unk_id=0))
    model.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    counter = tokens.Counter(tokens.Vocabulary((("<unk>", -9.0), *v.pieces)))
    rnd = random.Random(1)
    for _ in range(300):
        text = "".join(rnd.choice("ab ") for _ in range(rnd.randrange(12)))
        assert counter.count(text) == len(model.encode(text).ids), text
    assert tokens.token_counts(odd, v).count() == odd.count()
    assert tokens.token_counts(empty, v).count() == 0


# --- decontamination


def contaminated(text, items, window=13):
    import re

    def words(t):
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", t)

    own, hit, found = words(text), set(), set()
    for name, item in items:
        w = words(item)
        n = min(window, len(w))
        for s in range(len(w) - n + 1) if n else ():
            for at in range(len(own) - n + 1):
                if own[at : at + n] == w[s : s + n]:
                    hit |= set(range(at, at + n))
                    found.add(str(name))
    return len(own), len(hit), sorted(found)


def test_a_shared_passage_pairs_nothing(spark):
    """Documents and items that share a passage meet in one set of items."""
    passage = " ".join(f"p{i}" for i in range(30))
    docs = spark.createDataFrame([(i, f"d{i} {passage}") for i in range(2000)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, f"{passage} b{i}") for i in range(2000)], "item_id long, text string")
    found = decontam.find_hits(docs, bench)
    assert found.combos.count() == 1
    assert found.combos.select(F.size("items")).first()[0] == 2000
    assert found.documents.agg(F.min("n_hit"), F.max("n_hit"), F.count("*")).first() == (30, 30, 2000)


def test_contamination(spark, empty):
    rnd = random.Random(2)
    say = lambda n: " ".join(rnd.choice(WORDS) for _ in range(n))
    items = [(1, say(30)), (2, say(13)), (3, say(4)), (4, "Lone"), (5, None), (6, "..."), (11, say(40)), (None, say(20))]
    texts = [say(rnd.randrange(40)) + " " + (items[rnd.choice([0, 1, 2, 6, 7])][1]) + "! " + say(5) for _ in range(30)]
    texts += [None, "", "LONE", items[0][1].upper(), items[0][1][:60], say(3000), "w1 " * 500, items[0][1] + " " + items[0][1], "Straße lone-É"]
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)] + [(None, "lone", "k")], "doc_id long, text string, key string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.key.id: (r.n_words, r.n_hit, r["items"] or []) for r in decontam.contamination(docs, bench).collect()}
    plain = [("" if n is None else n, t) for n, t in items]
    assert got == {i: contaminated(t, plain) for i, t in [*enumerate(texts), (None, "lone")]}
    clean = decontam.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, (n, h, _) in got.items() if not (h and 20 * h >= n)}
    assert decontam.contamination(empty, bench).count() == 0
    assert decontam.contamination(docs, bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


# --- classifiers


def test_toxicity_on_odd_tables(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.toxicity_scores(odd, none).count() == odd.count()
    assert toxicity.toxicity_scores(empty, none).count() == 0
    kept = toxicity.drop_toxic(odd, none)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    labels = spark.createDataFrame([(9, 1), (1, 0), (6, None), (None, 1)], "doc_id long, toxic int")
    assert all(0 <= r.score <= 1 for r in toxicity.toxicity_scores(odd, labels).collect())


def test_toxicity_finds_the_word_that_tells():
    rnd = random.Random(3)
    say = lambda n: " ".join(rnd.choice(WORDS) for _ in range(n)).encode()
    toxic = [say(40) + b" nastyword " + say(rnd.randrange(60)) for _ in range(60)]
    mixed = [say(rnd.randrange(100)) for _ in range(500)] + [say(30) + b" nastyword" for _ in range(60)]
    model = toxicity.fit(toxic, mixed, 0.1)
    scores = model.score([say(50), b"", say(20) + b" NASTYWORD " + say(20), say(30000) + b" nastyword"])
    assert scores[0] < 0.3 and scores[1] < 0.3 and scores[2] > 0.5 and scores[3] > 0.5


def test_words_count_to_their_end():
    """What follows the eighth byte makes other features, in compounds and without blanks."""
    def of(text):
        doc, feature = toxicity.word_features([text.encode()])
        assert (doc == 0).all()
        return set(feature.tolist())

    a, b = of("unbelievablyfoo"), of("unbelievZZZbar")
    assert a != b and len(a - b) > 2 and len(b - a) > 2
    assert of("schimpfwort") & of("hauptschimpfwort") - of("haupt")
    long = "".join(chr(0x4E00 + i) for i in range(300))
    assert of("毒害") & of(long[:150] + "毒害" + long[150:])
    for cut in (10, 100, 290):
        assert of(long) != of(long[:cut] + "字" + long[cut + 1 :])
    texts = [b"", b"one two", b"unbelievable", "é".encode() * 40, b"..."]
    doc, feature = toxicity.word_features(texts)
    for i, t in enumerate(texts):
        assert sorted(feature[doc == i].tolist()) == sorted(toxicity.word_features([t])[1].tolist())


def test_the_risk_is_the_one_stated(monkeypatch):
    """The fitted weights make the non-negative risk lower than any small change of one does."""
    rnd = random.Random(7)
    say = lambda n: " ".join(rnd.choice(WORDS) for _ in range(n)).encode()
    toxic = [say(30) + b" vile awful" for _ in range(40)]
    mixed = [say(40) for _ in range(300)] + [say(20) + b" vile" for _ in range(20)]
    prior = 0.1
    model = toxicity.fit(toxic, mixed, prior, steps=2000, rate=0.02, decay=0.0)

    def risk(weights):
        def margin(texts):
            doc, col = toxicity.present(texts, model.wanted)
            return np.bincount(doc, weights[col], len(texts)) + weights[-1]

        loss = lambda g: np.logaddexp(0, -g).mean()
        p, u = margin(toxic), margin(mixed)
        return prior * loss(p) + max(0.0, loss(-u) - prior * loss(-p))

    best = risk(model.weights)
    start = np.zeros_like(model.weights)
    start[-1] = math.log(prior / (1 - prior))
    assert best < risk(start)
    for i in range(len(model.weights)):
        for change in (-0.5, 0.5):
            other = model.weights.copy()
            other[i] += change
            if i == len(other) - 1 or other[i] >= 0:
                assert risk(other) >= best - 0.02


def test_quality_on_odd_tables(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.quality_scores(odd, none).collect()} == {0.5}
    assert quality.quality_scores(empty, none).count() == 0
    labels = spark.createDataFrame([(9, 1), (1, 0), (6, 1), (8, 0), (3, None)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality.quality_scores(odd, labels).collect())


def test_samples_are_bounded_and_whole(spark):
    docs = spark.createDataFrame([(i, "x" * i) for i in range(1, 60)], "doc_id long, text string")
    got = labelled.sample_texts(docs, {"all": docs.select(F.col("doc_id").alias("id"))}, 40, 500, "text", "doc_id")["all"]
    assert 0 < sum(map(len, got)) <= 500 and all(t == b"x" * len(t) for t in got)


# --- near duplicates


def linked(codes):
    root = {c: c for c in codes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(codes, 2):
        if (a ^ b).bit_count() <= 2:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {c: find(c) for c in codes}


@pytest.mark.parametrize("dense", [4096, 3])
def test_links_by_brute_force(spark, monkeypatch, dense):
    monkeypatch.setattr(simhash, "DENSE", dense)
    rnd = random.Random(4)
    codes = {rnd.getrandbits(64) for _ in range(150)} | {0, 1, 3, 15}
    for base in list(codes)[:25]:
        c = base
        for _ in range(30):
            c ^= 1 << rnd.randrange(64)
            if rnd.random() < 0.7:
                c ^= 1 << rnd.randrange(64)
            codes.add(c)
    codes |= {(7 << 40) | x for x in range(200)}
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    gray = simhash.gray_rank(np.array(sorted(codes), np.uint64)).view(np.int64).tolist()
    frame = spark.createDataFrame(
        [(c - (1 << 64) if c >> 63 else c, g) for c, g in zip(sorted(codes), gray)], "code long, gray long"
    )
    stars = simhash.components(simhash.linked_codes(frame)).collect()
    got = {c: c for c in signed} | {r.code: r.root for r in stars}
    want = linked(list(codes))
    groups = lambda m: {frozenset(k for k in m if m[k] == v) for v in set(m.values())}
    unsigned = {k % (1 << 64): v % (1 << 64) for k, v in got.items()}
    assert groups(unsigned) == groups(want)


def test_every_node_is_searched_as_a_tree(monkeypatch):
    """Groups of two codes and of thousands go through the same descent, many at a time."""
    rnd = random.Random(15)
    groups, calls = [], []
    for size in [1, 2, 2, 3, 8, 9, 64, 65, 600, *[2] * 200]:
        base = rnd.getrandbits(64)
        own = {base}
        while len(own) < size:
            own.add(rnd.choice(sorted(own)[-9:]) ^ (1 << rnd.randrange(64)) ^ (rnd.randrange(2) << rnd.randrange(64)))
        groups.append(np.array(sorted(own, key=lambda c: int(simhash.gray_rank(np.array([c], np.uint64))[0])), np.uint64))
    search = simhash._search
    monkeypatch.setattr(simhash, "_search", lambda codes, sizes: calls.append(len(sizes)) or search(codes, sizes))
    monkeypatch.setattr(simhash, "BATCH", 100)
    number = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    stars = simhash._links(number, np.concatenate(groups))
    assert sum(calls) == sum(len(g) > 1 for g in groups) and max(calls) > 200 and len(calls) <= 4
    got = {}
    for a, b in zip(stars["a"], stars["b"]):
        got[a % (1 << 64)] = b % (1 << 64)
    for g in groups:
        root = linked([int(c) for c in g])
        parts = lambda m: {frozenset(k for k in m if m[k] == v) for v in set(m.values())}
        assert parts({int(c): got.get(int(c), int(c)) for c in g}) == parts(root)


def test_gray_rank_is_the_place_in_the_sequence():
    places = np.arange(5000, dtype=np.uint64)
    assert (simhash.gray_rank(places ^ (places >> np.uint64(1))) == places).all()


def test_chains_become_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    assert {r.code: r.root for r in simhash.components(links).collect()} == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_near_dedup_keeps_one_of_a_hot_row(spark):
    """Rows that agree in a null id and the text are told apart by their tags."""
    rows = [(None, "a b c d", i % 2) for i in range(3000)] + [(4, "a b c d", 5), (4, "a b c d", 5), (3, "other words here now", 1), (None, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int").repartition(8)
    kept = sorted(map(tuple, simhash.near_dedup(docs).collect()), key=str)
    assert kept == sorted([(4, "a b c d", 5), (3, "other words here now", 1), (None, "", 0)], key=str)


def test_near_dedup_on_odd_tables(odd, empty):
    rows = simhash.near_groups(odd).collect()
    assert len(rows) == len(odd_rows())
    kept = simhash.near_dedup(odd)
    assert kept.columns == odd.columns and kept.count() == len({r.component for r in rows})
    assert simhash.near_dedup(empty).count() == 0


# --- repeated windows


def without_repeats(rows):
    first = {}
    order = lambda i: (i is None, i)
    split = [(i, (t or "").split()) for i, t in rows]
    for i, w in split:
        for s in range(len(w) - 12):
            k = tuple(w[s : s + 13])
            first[k] = min(first.get(k, i), i, key=order)
    out = []
    for i, w in split:
        gone = {p for s in range(len(w) - 12) if order(first[tuple(w[s : s + 13])]) < order(i) for p in range(s, s + 13)}
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


@pytest.mark.parametrize("limits", [{}, {"HOT_ROWS": 2, "HOT_SHARE": 1e-9}, {"HELD": 500}, {"CHUNK": 300, "SEGMENT": 50, "FLUSH": 2000, "BUCKET": 3000}])
def test_repeats_by_brute_force(spark, odd, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(substring, name, value)
    rnd = random.Random(6)
    passages = [" ".join(rnd.choice(WORDS) for _ in range(rnd.randrange(10, 80))) for _ in range(5)]
    rows = [(i, t) for i, t, *_ in odd_rows() if i != 9]
    rows += [(100 + i, " ".join([*rnd.choices(WORDS, k=rnd.randrange(30)), rnd.choice(passages), *rnd.choices(WORDS, k=5), rnd.choice(passages)])) for i in range(40)]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, rank string").repartition(4)
    got = sorted(map(tuple, substring.remove_repeats(docs).collect()), key=str)
    assert got == sorted(without_repeats(rows), key=str)


def test_buckets_that_do_not_occur_cost_nothing():
    """Packing takes as long for ten million buckets as for ten."""
    import time

    import pandas as pd

    rnd = random.Random(16)
    batch = pd.DataFrame({"rank": range(40), "text_hash": range(40), "text": [" ".join(rnd.choices(WORDS, k=200)) for _ in range(40)]})
    none = np.empty(0, np.uint64)
    for buckets in (10, 10_000_000):
        start = time.perf_counter()
        out = pd.concat(substring._pack(none, buckets)(iter([batch])))
        assert out["bucket"].is_unique and out["bucket"].max() < buckets and time.perf_counter() - start < 5


def test_repeats_of_nothing(empty):
    assert substring.remove_repeats(empty).count() == 0


# --- sharding


def test_matrix_has_its_sums(spark):
    counts = spark.createDataFrame([(p, n) for p, n in enumerate([0, 1, 500, 20, 333, *[7] * 40, 1000])], "part int, n long")
    total = counts.agg(F.sum("n")).first()[0]
    sizes = [total // 16 + (k < total % 16) for k in range(16)]
    rows = {r.part: r.row for r in shard.communication_matrix(counts, sizes, 1).collect()}
    assert {r.part: r.n for r in counts.collect()} == {p: sum(r) for p, r in rows.items()}
    assert [sum(c) for c in zip(*rows.values())] == sizes
    assert all(x >= 0 for r in rows.values() for x in r)


def test_draws_are_hypergeometric(spark):
    rows = spark.range(20000).select(
        shard.hypergeometric(F.lit(10), F.lit(30), F.lit(100), F.col("id")).alias("x")
    ).groupBy("x").count().collect()
    seen = {r.x: r["count"] / 20000 for r in rows}
    for x in range(11):
        want = math.comb(30, x) * math.comb(70, 10 - x) / math.comb(100, 10)
        assert abs(seen.get(x, 0) - want) < 0.015
    assert shard  # extremes
    edge = spark.range(50).select(
        shard.hypergeometric(F.lit(5), F.lit(5), F.lit(5), F.col("id")).alias("a"),
        shard.hypergeometric(F.lit(5), F.lit(0), F.lit(9), F.col("id")).alias("b"),
        shard.hypergeometric(F.lit(0), F.lit(0), F.lit(0), F.col("id")).alias("c"),
    ).distinct().collect()
    assert [tuple(r) for r in edge] == [(5, 0, 0)]


def test_sharding_on_odd_tables(odd, empty):
    rows = shard.sharded_documents(odd)
    assert rows.count() == odd.count()
    assert rows.columns == [c for c in odd.columns if c != "size"] + ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert shard.shard_rows(empty).count() == 0
    assert sorted(r.slot for r in shard.shard_rows(odd, shards=1).collect()) == list(range(odd.count()))
