"""The condition index against plain tests of every condition on every visit."""
import random
import re

import pytest
from pyspark.sql import functions as F

from ringlens.operators import conditions as cn

CONDITIONS = "campaign_id int, parameter string, operator string, value string"
PATTERNS = [
    "^/en/[0-9]+$", "a|b", "blog[.]x", "(ab|cd)ef+g?", "x*yz", "colou?r", "^$", "[^a]b", r"\d+\.html", "a{2,3}b", "(?i)BLOG",
    r"en/\w+/(page|p)\d*", "((a)b(c))d", "foo.+bar", r"\Qa.b\E", "end$", ".", r"a\.b", "[.]org", "ab+?c", "日本+語", r"\x61b",
]
TEXTS = [
    "/en/12", "/en/x", "blog.x", "blog", "abefg", "cdefff", "xxyz", "yz", "color", "colour", "", "cb", "7.html", "aab", "b",
    "en/a/page3", "abcd", "foobar", "foo-bar", "a.b", "axb", "the end", "x.org", "abbc", "日本本語", "BLOG", "ab", "aé", "/en/日本語",
]


def holds(operator, value, text):
    if text is None:
        return False
    if operator == "~":
        quoted = re.sub(r"\\Q(.*?)\\E", lambda m: re.escape(m[1]), value)
        return re.search(quoted, text) is not None
    return text == value if operator == "=" else value in text


def sample(n_visits, n_campaigns, seed=3):
    rng = random.Random(seed)
    visits = [(i, rng.choice([*TEXTS, None]), rng.choice([*TEXTS, None, "hot", "hot", "hot"]), i % 3) for i in range(n_visits)]
    conditions = []
    for c in range(n_campaigns):
        for _ in range(rng.randint(1, 3)):
            operator = rng.choice(["=", "sub", "~"])
            value = rng.choice(PATTERNS) if operator == "~" else rng.choice([*TEXTS, "b", "og", ".", "en/"])
            conditions.append((c, rng.choice(["host", "path"]), operator, value))
    return visits, conditions


def test_literals_are_certain(spark):
    """Every text that matches a pattern contains the pattern's literal."""
    rows = spark.createDataFrame([(p,) for p in PATTERNS], "p string").select("p", cn.literal_of(F.col("p")).alias("need")).collect()
    found = {r.p: r.need for r in rows}
    for p, need in found.items():
        assert all(need in t for t in TEXTS if holds("~", p, t)), (p, need)
    assert found["^/en/[0-9]+$"] == "/en/" and found["blog[.]x"] == "blog" and found["foo.+bar"] == "foo"
    assert found["a|b"] == found["(?i)BLOG"] == found["((a)b(c))d"][:0] == found[r"\x61b"] == found[r"\Qa.b\E"] == ""
    assert found["colou?r"] == "colo" and found["x*yz"] == "yz" and found["日本+語"] == "日本"


def test_campaigns_of_a_table(spark):
    visits, conditions = sample(150, 120)
    conditions += [(500, "host", "=", None), (501, "host", "unknown", "x"), (502, "nothing", "sub", "a"), (503, "host", "sub", ""),
                   (504, "path", "=", "hot"), (504, "path", "=", "hot"), (504, "path", "sub", "ho")]
    names = ["host", "path"]
    table = spark.createDataFrame(conditions, CONDITIONS)
    rows = spark.createDataFrame(visits, "id int, host string, path string, site_id int")
    got = sorted(map(tuple, cn.assign_campaigns(rows, "id", table).collect()))
    want = []
    for i, host, path, _ in visits:
        own = {"host": host, "path": path}
        for c in sorted({c for c, *_ in conditions}):
            asked = [x for x in conditions if x[0] == c]
            if all(x[3] is not None and x[2] in ("=", "sub", "~") and x[1] in names and holds(x[2], x[3], own[x[1]]) for x in asked):
                want.append((i, c))
    assert got == want

    weights = [(s, p, s + (2 if p == "host" else 1)) for s in range(2) for p in names]
    scored = cn.score_campaigns(rows, "id", table, spark.createDataFrame(weights, "site_id int, parameter string, weight int"))
    weight = {(s, p): w for s, p, w in weights}
    for r in scored.collect():
        _, host, path, site = visits[r.id]
        own, score = {"host": host, "path": path}, {}
        for c, p, o, v in conditions:
            if v is not None and p in own and o in ("=", "sub", "~") and holds(o, v, own[p]):
                score[c] = score.get(c, 0) + weight.get((site, p), 0)
        best = max(score.values(), default=0)
        assert r.score == best and r.campaign_id == (min(c for c, x in score.items() if x == best) if best else None)
    assert scored.count() == len(visits)


@pytest.mark.parametrize("n", [10, 10_000])
def test_the_plan_does_not_grow(spark, n):
    """Ten thousand campaigns have the plan of ten."""
    visits, _ = sample(50, 1)
    rows = spark.createDataFrame(visits, "id int, host string, path string, site_id int")
    table = spark.range(n).selectExpr(
        "CAST(id AS INT) AS campaign_id", "'path' AS parameter", "element_at(array('=', 'sub', '~'), CAST(id % 3 + 1 AS INT)) AS operator",
        "CASE WHEN id % 3 = 2 THEN concat('^h.t', id % 7, '?$') ELSE 'hot' END AS value",
    )
    out = cn.assign_campaigns(rows, "id", table)
    text = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert "NestedLoop" not in text and "Cartesian" not in text and len(text) < 20_000
    hot = sum(v[2] == "hot" for v in visits)
    assert out.count() == n * hot
