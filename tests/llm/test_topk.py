"""Exact top-k: SQL twin and brute force."""

import math

import numpy as np
import pytest
from conftest import SMALL
from oracle import compare, connect
from pyspark.sql import functions as F

from millrace.llm import topk
from millrace.llm.queries import ORACLES, QUERIES

SHAPE = "vec_id long, embedding array<double>, score int, shard int"


def test_matches_sql(spark):
    name = "op1_top_k"
    assert compare(spark, connect(SMALL), SMALL, QUERIES[name], ORACLES[name])[0] == "exact"


def plain(rows, k, every=3):
    kept = {}
    for key, v in rows:
        if key is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            kept[key, tuple(int(np.floor(64 * x)) for x in v)] = None
    out = {}
    for q, a in kept:
        if q % every == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in kept
                           if c != q and len(a) == len(b))
            out[q] = [(i + 1, c, -s) for i, (s, c) in enumerate(found[:k])]
    return sorted((q, *r) for q, found in out.items() for r in found)


def ours(spark, rows, k, every=3):
    df = spark.createDataFrame([(key, v, 1, 2) for key, v in rows], SHAPE)
    df = df.withColumn("whole", topk.whole_numbers(F.col("embedding")))
    return sorted(tuple(r) for r in
                  topk.top_k(df, "vec_id", "whole", F.col("vec_id") % every == 0, k).collect())


@pytest.mark.parametrize("kind", ["spread", "ties", "clusters"])
def test_against_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(topk, "SHARDS", 3)
    monkeypatch.setattr(topk, "LEAF_ROWS", 5)
    monkeypatch.setattr(topk, "BLOCK", 16)
    chance = np.random.default_rng(7)
    made = {"spread": chance.normal(size=(260, 6)),
            "ties": np.repeat(chance.integers(-2, 3, size=(13, 2)), 20, axis=0) / 64.0,
            "clusters": chance.normal(size=(5, 8))[chance.integers(0, 5, 260)] * 9
                        + chance.normal(size=(260, 8)) * 0.1}[kind]
    rows = [(i, v.tolist()) for i, v in enumerate(made)]
    assert ours(spark, rows, 7) == plain(rows, 7)


def test_large_whole_numbers_stay_exact():
    a = np.full((1, 64), 2.0**25 + 1)
    assert topk.scores(a, a)[0, 0] == 64 * (2**25 + 1) ** 2


def test_large_components_take_part(spark):
    big = [2.0**20, 2.0**22 + 0.5, -(2.0**21), 2.0**25 + 0.25, 3.0, -7.5, 0.25, 2.0**23]
    rows = [(i, [x, 1.0, -x / 3]) for i, x in enumerate(big)]
    whole = {i: [math.floor(64 * x) for x in v] for i, v in rows}
    want = []
    for q in (0, 3, 6):
        found = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q)
        want += [(q, rank, i, -score) for rank, (score, i) in enumerate(found, 1)]
    assert ours(spark, rows, 20) == want


def test_scores_beyond_doubles_and_longs():
    a, b = np.array([[2.0**40, 2.0**40, 3.0]]), np.array([[2.0**30, -(2.0**30), 5.0]])
    assert topk.scores(a, b)[0, 0] == 15
    with pytest.raises(OverflowError):
        topk.scores(a, a)


def test_a_bound_is_never_below_a_score():
    chance = np.random.default_rng(1)
    points, queries = chance.integers(-99, 99, (500, 9)) * 1.0, chance.integers(-99, 99, (40, 9)) * 1.0
    tree = topk.BallTree(points)
    lengths = np.sqrt((queries ** 2).sum(axis=1))
    for node, members in enumerate(tree.members):
        if members is not None:
            assert (tree.bound(queries, lengths, node)[:, None] >= queries @ points[members].T).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]),
            (5, [1.0, 1.0]), (5, [1.0, 1.0]), (6, [0.5, 0.5]), (None, [9.0, 9.0]), (7, []),
            (9, []), (10, [1.0, 2.0, 3.0]), (12, [1.0]), (5, [-1.0, 1.0])]
    assert ours(spark, rows, 3) == plain(rows, 3)
    assert ours(spark, [], 3) == []


def test_clashing_names(spark):
    rows = spark.createDataFrame([(i, [i, 1], i, i, i) for i in range(6)],
                                 "vec_id long, v array<long>, query_id long, rank long, score long")
    got = topk.top_k(rows, "vec_id", "v", F.col("vec_id") < 2, 2).collect()
    assert sorted((r[0], r[1], r[2], r[3]) for r in got) == [
        (0, 1, 1, 1), (0, 2, 2, 1), (1, 1, 5, 6), (1, 2, 4, 5)]
