"""Hard negatives over R-trees against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from sliceward.llm import rtree_negatives as R

SCHEMA = "vec_id long, embedding array<float>, label int, id string, x string, score string"


@pytest.fixture
def small(monkeypatch):
    """Many parts, trees, blocks and levels also for few rows."""
    for name, value in (("PART_BYTES", 8_000), ("ANCHOR_BYTES", 4_000), ("TREE_ROWS", 150), ("LEAF", 8), ("FAN_OUT", 3), ("ANCHORS_AT_ONCE", 5)):
        monkeypatch.setattr(R, name, value)


def plain(rows, every=100, relabel=lambda i, label: label, positives=5, negatives=10):
    kept: dict = {}
    for i, vector, label, *_ in rows:
        if i is None or label is None or vector is None or any(c is None or not math.isfinite(c) for c in vector):
            continue
        row = (relabel(i, label), [math.floor(256 * float(np.float32(c))) for c in vector])
        kept[i] = min(row, kept.get(i, row))
    found = []
    for a, (label, x) in kept.items():
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, other) for i, (other, y) in kept.items() if i != a)
        for s, i, _ in [r for r in scored if r[2] == label][:positives]:
            hard = [(-n, j) for n, j, other in scored if other != label and -30 * s <= -100 * n <= -90 * s]
            found += [(a, i, r, j, -s, n) for r, (n, j) in enumerate(hard[:negatives], 1)]
    return sorted(found)


def collected(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def vectors(n, dims, seed, labels=4, copies=0):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0.1 if j < 3 else 0, 0.2) for j in range(dims)], rng.randrange(labels), "a", "b", "c") for i in range(n)]
    return rows + [(n + i, rows[7][1], rng.randrange(labels), "a", "b", "c") for i in range(copies)]


def test_equals_brute_force_with_ties_and_many_trees(spark, small):
    """A third of the rows are copies of one vector, most with one label."""
    rows = vectors(500, 9, 1, copies=250)
    rows = [r if r[0] % 3 else (*r[:2], 1, *r[3:]) for r in rows]
    found = collected(R.mine(spark.createDataFrame(rows, SCHEMA).repartition(5), every=25))
    assert found == plain(rows, every=25) and len(found) > 300


def test_odd_rows(spark, small):
    nan, inf = float("nan"), float("inf")
    rows = vectors(60, 4, 2) + [
        (None, [0.5] * 4, 1, *"abc"), (100, None, 1, *"abc"), (101, [0.1, None, 0.2, 0.1], 1, *"abc"), (102, [nan] * 4, 1, *"abc"),
        (103, [inf, 0.0, 0.0, 0.0], 1, *"abc"), (104, [0.5] * 4, None, *"abc"), (0, [2.0] * 4, 9, None, None, None), (5, [0.5] * 4, 0, *"abc"),
        (5, [0.5] * 4, 0, *"abc"), (-10, [0.5] * 4, 2, *"abc"), (106, [0.7, 0.7], 1, *"abc"), (107, [], 3, *"abc"), (108, [1.0, 0.0, 0.0, 0.0, 5.0], 2, *"abc"),
    ]
    padded = [(i, v and [*v, *[0.0] * (5 - len(v))], label) for i, v, label, *_ in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    assert collected(R.mine(df, every=10)) == plain(padded, every=10)
    assert collected(R.mine(df.filter("false"))) == []
    assert collected(R.mine(df.filter("label = 1"), every=10)) == []
    empty = df.withColumn("embedding", R.F.array().cast("array<float>"))
    assert collected(R.mine(empty, every=10)) == plain([(i, [], label) for i, _, label, *_ in rows], every=10)


def test_large_components_are_exact_or_an_error(spark, small):
    rng = random.Random(4)
    rows = [(i, [rng.randrange(1, 1 << 12) * 1024.0 for _ in range(3)], i % 2, *"abc") for i in range(60)]
    assert collected(R.mine(spark.createDataFrame(rows, SCHEMA), every=10)) == plain(rows, every=10)
    with pytest.raises(Exception, match="long"):
        R.mine(spark.createDataFrame([(i, [1e16], i % 2, *"abc") for i in range(3)], SCHEMA)).collect()


def test_boxes_are_pruned_and_never_needed_ones():
    """Clustered vectors: few leaves are looked at, and the result is that of all of them."""
    rng = np.random.default_rng(3)
    centres = rng.integers(-200, 200, (32, 6))
    x = (centres[rng.integers(0, 32, 4000)] + rng.integers(-3, 4, (4000, 6))).astype(np.int64)
    ids = rng.permutation(4000).astype(np.int64)
    tree = R.Tree(R.tree_row(ids, x, 0), 6)
    anchors = x[:20]
    low, high = np.full((20, 1), R.LEAST), np.full((20, 1), -R.LEAST)
    visited: list = []
    got = R.best_in_tree(tree, anchors, np.full(20, -1), low, high, 5, visited)
    scores = anchors @ x.T
    for a in range(20):
        best = sorted(zip(-scores[a], ids, strict=True))[:5]
        assert sorted((-s, i) for s, i in zip(got[1][a, 0], got[0][a, 0], strict=True)) == best
    leaves = sum(n for box, n in visited if box < tree.levels[0])
    assert leaves < 0.4 * 20 * tree.levels[0]


def test_query_equals_its_sql(spark):
    import duckdb

    path = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/embeddings.parquet'")
    assert collected(R.op12_rtree_negatives(spark, path)) == sorted(con.sql(R.OP12_SQL).fetchall())
