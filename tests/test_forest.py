"""The forest: grown on all rows, alike however the rows lie, and as a plain version grows it."""

import random
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import forest, learning


def lines(spark, rows: int):
    """Lines whose return flag is noise; keys come twice."""
    rng = random.Random(5)
    made = [(i // 2, 1, i % 7, float(rng.randint(1, 50)), round(rng.uniform(900, 105000), 2),
             rng.randint(0, 10) / 100, rng.randint(0, 8) / 100,
             datetime(1995, 1, 1) + timedelta(days=rng.randint(0, 2500)), rng.choice("ANR"))
            for i in range(rows)]
    return spark.createDataFrame(made, """l_orderkey long, l_linenumber int, l_partkey long,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_shipdate timestamp_ntz, l_returnflag string""")


def test_all_rows_of_the_training_side_are_fitted(spark, tmp_path):
    """Noise can only be told where it was fitted: about 1,000 of 4,800 rows gave 0.475."""
    from millrace.plans import QUERIES
    from millrace.plans.features import _KEYS

    table = lines(spark, 6000)
    table.write.parquet(str(tmp_path / "lineitem.parquet"))
    rows = QUERIES["forest_accuracy"](spark, str(tmp_path)).collect()
    found = {r["metric"]: r["value"] for r in rows if r["label"] == "return flag"}
    assert found["train_accuracy"] > 0.9
    assert found["fitted_accuracy"] == found["train_accuracy"]
    assert all(r["value"] == 1 for r in rows if r["metric"] == "reloaded_agrees")
    train, test = learning.train_test_split(table.withColumnRenamed("l_returnflag", "target"), _KEYS)
    share = Counter(r["target"] for r in train.collect())
    assert found["train_majority"] == max(share.values()) / sum(share.values())


def test_points_come_from_all_rows(spark):
    """Rare values at the end of the table count like any other."""
    rng = random.Random(7)
    wide = [rng.choice([rng.random(), 0.5]) for _ in range(3000)] + [float("inf")]
    rows = [(v, float(i >= 2998), -0.0 if i % 2 else 0.0, 4.0) for i, v in enumerate(wide)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)
    values, upto, want = sorted(Counter(wide).items()), 0, []
    for value, n in values[:-1]:
        upto += n
        if upto * 32 // len(wide) > (upto - n) * 32 // len(wide):
            want.append(value)
    assert len(want) < 32 < len(values)
    assert forest.candidate_points(df, list("abcd")) == [want, [0.0], [], []]
    with pytest.raises(Exception, match="no null or NaN: b"):
        forest.candidate_points(df.withColumn("b", F.lit(None).cast("double")), ["a", "b"])


def test_draws_are_poisson():
    keys = forest.cell_keys(np.array([[i % 251, i // 251] for i in range(40000)], np.uint8))
    for mean in (1, 3, 40, 1000, 5000):
        drawn = forest.poisson(np.full(40000, mean), keys)
        assert abs(drawn.mean() - mean) < 5 * (mean / 40000) ** 0.5
        assert abs(drawn.var() / mean - 1) < 0.05
    ones = Counter(forest.poisson(np.full(40000, 1), keys).tolist())
    assert abs(ones[0] / 40000 - 0.3679) < 0.01 and abs(ones[2] / 40000 - 0.1839) < 0.01
    assert not forest.poisson(np.zeros(5, np.int64), keys[:5]).any()


def plain(cells, tree, node, depth, seed):
    """Leaf counts of each cell, grown one node at a time."""
    total = np.sum([n for _, n in cells], axis=0)
    best, place = sum(total * total) / sum(total) * (1 + 1e-12), None
    if total.max() < total.sum() and node < 2 ** depth:
        looks = forest._chosen(seed, np.array([tree]), np.array([node]), len(cells[0][0]))[0]
        for f in np.flatnonzero(looks):
            for cut in sorted({b[f] for b, _ in cells})[:-1]:
                left = np.sum([n for b, n in cells if b[f] <= cut], axis=0)
                right = total - left
                score = sum(left * left) / sum(left) + sum(right * right) / sum(right)
                if score > best:
                    best, place = score, (f, cut)
    if place is None:
        return {b: tuple(total / total.sum()) for b, _ in cells}
    sides = [[c for c in cells if (c[0][place[0]] > place[1]) == right] for right in (False, True)]
    return plain(sides[0], tree, 2 * node, depth, seed) | plain(sides[1], tree, 2 * node + 1, depth, seed)


@pytest.mark.parametrize("depth", [0, 3, 30])
def test_trees_grow_as_a_plain_version_grows_them(depth):
    rng = random.Random(11)
    cells = list({tuple(rng.randrange(m) for m in (9, 4, 6)): None for _ in range(150)})
    counts = [[rng.randint(0, 3), rng.randint(0, 3), 1] for _ in cells]
    bins, rows = np.array(cells * 2, np.uint8), np.array(counts + counts[::-1])
    at = np.repeat([0, 1], len(cells))
    feature, cut, left, votes = forest.grow(bins, rows, at, np.array([4, 9]), np.array([1, 1]), depth, 42)
    leaves = forest.walk(feature, cut, left, bins, at)
    found = votes[left[leaves]] / forest.VOTE
    for i, (tree, own) in enumerate(((4, counts), (9, counts[::-1]))):
        want = plain([(c, np.array(n, float)) for c, n in zip(cells, own)], tree, 1, depth, 42)
        assert np.allclose(found[at == i], [want[c] for c in cells], atol=1e-6)
    assert len(votes) == (feature < 0).sum()


def test_forest_does_not_depend_on_groups_or_partitions(spark, tmp_path):
    """Nodes split over all tasks, and nodes grown in one task, make one forest; so does another
    layout. Stored and read again it says the same."""
    rng = random.Random(13)
    rows = [(float(rng.randint(0, 60)), rng.random(), float(rng.randint(0, 4)), rng.choice("abc"))
            for _ in range(1500)] + [(61.0, 2.0, 9.0, "c")] * 400 + [(3.0, 0.5, 1.0, None)]
    df = spark.createDataFrame(rows, "x double, y double, z double, l string")
    columns, found = ["x", "y", "z"], []
    points = forest.candidate_points(df, columns)
    classes = learning.train_forest(df, columns, "l", trees=9, points=points).stages[:2]
    for parts, cells in ((3, 1 << 16), (11, 150), (2, 20)):
        labelled = classes[0].transform(df.repartition(parts))
        grown = forest.grow_forest(labelled, columns, "_label", points, 9, 30, 42, group_cells=cells)
        if parts == 11:
            assert len(grown.shape["tops"][0]) > 9
        model = learning.PipelineModel([*classes, grown])
        learning.save_model(model, str(tmp_path / "model"))
        for m in (model, learning.PipelineModel.load(str(tmp_path / "model"))):
            found.append(sorted(map(str, m.transform(df).select(*columns, "l", "prediction").collect())))
    assert len(found[0]) == len(rows)
    assert all(f == found[0] for f in found)
    assert model.transform(df.where("false")).isEmpty()
    assert np.isnan(learning.accuracy(model, df.where("false")))
    assert learning.accuracy(model, df) == sum(
        "abc".find(r["l"] or "-") == r["prediction"] for r in model.transform(df).collect()) / len(rows)
