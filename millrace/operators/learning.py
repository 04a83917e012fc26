"""Classifier training and evaluation, metric comparison and dataset identity."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import route
from millrace.operators import forest
from millrace.session import materialize


def train_test_split(df: DataFrame, keys: list[str], test: float = 0.2,
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the keys, so a row stays on its side however the data is partitioned."""
    text = F.concat_ws("|", F.lit(str(seed)), *keys)
    mark = route(text, 1_000_000) < int(test * 1_000_000)
    return df.where(~mark), df.where(mark)


def train_forest(df: DataFrame, features: list[str], label: str, trees: int = 100,
                 depth: int = 30, seed: int = 42,
                 points: list[list[float]] | None = None) -> PipelineModel:
    """A random forest on all rows; 30 is the depth at which the library's ends. `points` are the
    values that trees may split at, if they are known already."""
    points = forest.candidate_points(df, features) if points is None else points
    classes = StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc",
                            handleInvalid="keep").fit(df)
    grown = forest.grow_forest(classes.transform(df), features, "_label", points, trees, depth, seed)
    return PipelineModel([classes, VectorAssembler(inputCols=features, outputCol="_features"), grown])


def accuracy(model: PipelineModel, df: DataFrame) -> float:
    """Share of rows whose label is predicted."""
    label, features = model.stages[0].getInputCol(), model.stages[1].getInputCols()
    found = predicted_rows({"_said": model}, df, features, [label])
    right = F.sum(F.when(F.col("_said") == F.col(label), F.col("rows")).otherwise(0))
    share = found.agg(right / F.sum("rows")).first()[0]
    return float("nan") if share is None else share


def split_points(models: list[PipelineModel], n: int) -> list[list[float]]:
    """Values at which the trees of the models may split each of `n` numeric features."""
    points = [set() for _ in range(n)]
    for model in models:
        for own, more in zip(points, model.stages[-1].points):
            own.update(more)
    return [sorted(p) for p in points]


def predicted_rows(models: dict[str, PipelineModel], df: DataFrame, features: list[str],
                   by: list[str]) -> DataFrame:
    """Rows of `df` counted by `by` and by the label that each model predicts, in a column of the
    model's name.

    Trees compare a feature only with their split points, 31 at most, so all rows between the same
    points get the same label. Rows are counted per such cell first, and one row of the cell is
    predicted: the forests walk as many rows as there are cells, however many rows the table has.
    """
    points = split_points(list(models.values()), len(features))
    cut = [f"_cut{i}" for i in range(len(features))]
    counted = materialize(forest.with_bins(df, features, points, cut).groupBy(*cut, *by).agg(
        F.count(F.lit(1)).alias("rows"), *[F.min(f).alias(f) for f in features]), "counted")
    cells = materialize(counted.groupBy(*cut).agg(*[F.min(f).alias(f) for f in features]), "cells")
    found = counted.select(*cut, *by, "rows")
    for name, model in models.items():
        labels = F.array(*[F.lit(v) for v in model.stages[0].labels])
        found = found.join(model.transform(cells).select(
            *cut, F.get(labels, F.col("prediction").cast("int")).alias(name)), cut)
    return found.groupBy(*by, *models).agg(F.sum("rows").alias("rows"))


def evaluate(model: PipelineModel, train: DataFrame, test: DataFrame) -> DataFrame:
    """Accuracy on both sides as metric rows."""
    rows = [("train_accuracy", accuracy(model, train)), ("test_accuracy", accuracy(model, test))]
    return train.sparkSession.createDataFrame(rows, "metric string, value double")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def metrics_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Metrics of two versions side by side."""
    left = old.select("metric", F.col("value").alias("old"))
    right = new.select("metric", F.col("value").alias("new"))
    return left.join(right, "metric", "full").withColumn("change", F.col("new") - F.col("old"))


def _text(col: str) -> Column:
    """The value as text behind its length, so that neither null nor a separator within a value can
    be taken for something else."""
    said = F.col(f"`{col}`").cast("string")
    return F.coalesce(F.concat(F.length(said).cast("string"), F.lit(":"), said), F.lit("-"))


def _row_digest(cols: list[str]) -> Column:
    """60 bits of the digest of a row, as a number that can be summed."""
    digest = F.md5(F.concat(*[_text(c) for c in cols]).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(20,0)")


def fingerprint(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Identity of a dataset version that does not depend on row order: the row count, the sum of
    60-bit row digests, and a digest of column names and types. Duplicated rows count."""
    cols = cols or df.columns
    shape = ",".join(f"{c}:{df.schema[c].dataType.simpleString()}" for c in cols)
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.md5(F.lit(shape).cast("binary")).alias("schema_digest"),
                  F.coalesce(F.sum(_row_digest(cols)), F.lit(0)).cast("string").alias("digest"))


def digest_tree(df: DataFrame, key: str, cols: list[str] | None = None, *, width: int = 4096,
                fanout: int = 16, levels: int = 4) -> DataFrame:
    """A dataset version as a tree of digests over ranges of a whole-number key: level, node, rows
    and digest. A leaf (level 0) covers `width` keys, a node above it `fanout` nodes below.

    Rows are summed per leaf on the map side, nodes above from the leaves. A null key has the node
    null on every level. Stored beside a version, the tree tells later which ranges have changed
    without the version itself.
    """
    cols = cols or df.columns
    leaves = df.groupBy(F.floor(F.col(key) / width).alias("node")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(_row_digest(cols)).alias("digest"))
    steps = F.array(*[F.struct(F.lit(i).alias("level"), F.lit(fanout ** i).alias("size"))
                      for i in range(levels)])
    return leaves.withColumn("_step", F.explode(steps)).groupBy(
        F.col("_step.level").alias("level"), F.floor(F.col("node") / F.col("_step.size")).alias("node")
    ).agg(F.sum("rows").alias("rows"), F.sum("digest").cast("string").alias("digest"))


def changed_ranges(old: DataFrame, new: DataFrame) -> DataFrame:
    """Nodes of two digest trees of one shape that differ: level and node."""
    left, right = (t.select("level", F.col("node").alias("_node"), F.struct("rows", "digest").alias("_d"))
                   for t in (old, new))
    left, right = left.alias("l"), right.alias("r")
    same_place = (F.col("l.level") == F.col("r.level")) & F.col("l._node").eqNullSafe(F.col("r._node"))
    return left.join(right, same_place, "full").where(
        ~F.col("l._d").eqNullSafe(F.col("r._d"))).select(
        F.coalesce("l.level", "r.level").alias("level"), F.coalesce("l._node", "r._node").alias("node"))


def changed_keys(old: DataFrame, new: DataFrame, key: str, cols: list[str] | None = None, *,
                 width: int = 4096) -> DataFrame:
    """Keys whose rows differ between two versions: key and `change` (added, removed or changed).

    Only rows of leaves that differ are compared, as sums of row digests per key and side, so copies
    of a row count and a hot key is combined on the map side.
    """
    cols = cols or new.columns
    trees = [digest_tree(d, key, cols, width=width, levels=1) for d in (old, new)]
    leaves = changed_ranges(*trees).select(F.col("node").alias("_leaf"))
    sides = old.select(F.col(key).alias("_key"), _row_digest(cols).alias("_o"),
                       F.lit(None).cast("decimal(20,0)").alias("_n")).unionByName(
        new.select(F.col(key).alias("_key"), F.lit(None).cast("decimal(20,0)").alias("_o"),
                   _row_digest(cols).alias("_n")))
    inside = sides.join(leaves, F.floor(F.col("_key") / width).eqNullSafe(F.col("_leaf")), "left_semi")
    summed = inside.groupBy("_key").agg(
        F.count("_o").alias("_before"), F.count("_n").alias("_after"),
        F.sum("_o").alias("_o"), F.sum("_n").alias("_n"))
    change = F.when(F.col("_before") == 0, "added").when(F.col("_after") == 0, "removed").otherwise(
        "changed")
    return summed.where((F.col("_before") != F.col("_after")) | ~F.col("_o").eqNullSafe(F.col("_n"))
                        ).select(F.col("_key").alias(key), change.alias("change"))
