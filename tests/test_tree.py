"""Trees by pointer doubling."""
import math

import pytest

from ringlens.operators import lists

SCHEMA = "id int, parent_id int, name string"


def paths(spark, rows):
    return {r.id: (r.path, r.depth) for r in lists.tree(spark.createDataFrame(rows, SCHEMA), "/").collect()}


def test_paths_and_circles(spark):
    rows = [(1, None, "a"), (2, 1, "b"), (3, 2, "c"), (4, 99, "d"), (5, 4, "e"), (6, 7, "f"), (7, 6, "g"), (8, 6, "h"), (9, 9, "i")]
    assert paths(spark, rows) == {
        1: ("a", 0), 2: ("a/b", 1), 3: ("a/b/c", 2), 4: ("d", 0), 5: ("d/e", 1), 6: (None, None), 7: (None, None),
        8: (None, None), 9: (None, None),
    }
    assert paths(spark, [(1, 2, "a"), (2, 1, "b")]) == {1: (None, None), 2: (None, None)}
    assert paths(spark, []) == {}


@pytest.mark.parametrize("depth", [1, 2, 3, 4, 33])
def test_every_depth(spark, depth):
    rows = [(i, i - 1 if i else None, str(i)) for i in range(depth)] + [(100 + i, i, "x") for i in range(depth)]
    got = paths(spark, rows)
    for i in range(depth):
        path = "/".join(map(str, range(i + 1)))
        assert got[i] == (path, i) and got[100 + i] == (path + "/x", i + 1)


def test_rounds_are_the_logarithm_of_the_depth(spark, monkeypatch):
    rounds = []
    settle = lists.settled
    monkeypatch.setattr(lists, "settled", lambda df, purpose: rounds.append(purpose) or settle(df, purpose))
    n = 10_000
    nodes = spark.range(n).selectExpr("CAST(id AS INT) AS id", "CAST(nullif(id, 0) - 1 AS INT) AS parent_id", "'' AS name")
    got = lists.tree(nodes, "").agg({"depth": "sum", "id": "count"}).first()
    assert tuple(got) in {(n * (n - 1) // 2, n), (n, n * (n - 1) // 2)}
    assert rounds.count("tree") <= math.ceil(math.log2(n)) + 1 <= 15
