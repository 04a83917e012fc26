"""A random forest whose training rows, nodes and votes stay spread over the tasks.

Features are cut at up to 31 values each, so rows between the same cut points (a cell) are alike to
every tree. Rows are counted per cell and class once; the trees are grown on these counts, which end
growing with the table when the cells are filled. Each tree draws a Poisson count for every row, as
the library does: the draws of n rows of a cell and class are one Poisson draw of mean n, taken from a
hash of cell, class and tree, so the forest does not depend on how the table is partitioned.

A node with many cells is split from histograms added up over all tasks. Smaller nodes are dealt
with their cells to groups, and a group is grown in one task, a level at a time. Nodes are written as
one row of packed arrays per group; the driver keeps only the splits above the groups. To predict,
cells are dealt to groups along the same splits, and their votes come back to be summed.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Model
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import (DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader,
                             MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.ordered import over_series
from millrace.session import materialize, scratch

BINS = 32              # of a feature, the library's default
GROUP_CELLS = 1 << 17  # cells that are grown in one task at once
TABLE = 1024           # means up to which a Poisson draw is read off a table
VOTE = 1 << 24         # a whole vote; votes are integers, so their sum does not depend on its order

_CHUNK = "chunk int, size int, bins binary, rows binary"
_PIECE = "group int, root binary, bins binary, rows binary"
_NODES = "group int, feature binary, cut binary, left binary, votes binary"


# -- cells ------------------------------------------------------------------------------------

def candidate_points(df: DataFrame, features: list[str], bins: int = BINS) -> list[list[float]]:
    """Values of each feature after which a tree may split: all but the largest if there are at most
    `bins` values, otherwise those at which the running share of the rows passes a multiple of
    1/`bins`. All rows count, and ranks are exact."""
    rows = df.select(F.inline(F.array(*[F.struct(
        F.lit(i).alias("feature"), _number(f).alias("value")) for i, f in enumerate(features)])))
    counted = materialize(rows.groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("rows")), "values")
    whole = counted.groupBy("feature").agg(F.sum("rows").alias("all"), F.max("value").alias("top"),
                                           F.count(F.lit(1)).alias("values"))
    ranked = over_series(counted, ["feature"], ["value"],
                         lambda s: s.running(upto=F.col("rows"))).join(F.broadcast(whole), "feature")
    part = [F.floor(n * bins / F.col("all")) for n in (F.col("upto"), F.col("upto") - F.col("rows"))]
    kept = ranked.where((F.col("value") < F.col("top"))
                        & ((F.col("values") <= bins) | (part[0] > part[1])))
    points = [[] for _ in features]
    for r in kept.select("feature", "value").collect():
        points[r["feature"]].append(r["value"])
    return [sorted(p) for p in points]


def _number(col: str):
    value = F.col(col).cast("double")
    return F.when(value.isNull() | F.isnan(value), F.raise_error(
        F.lit(f"a forest takes no null or NaN: {col}")).cast("double")).otherwise(value)


def with_bins(df: DataFrame, features: list[str], points: list[list[float]],
              names: list[str]) -> DataFrame:
    """Number the stretches between the points of each feature; a point ends its stretch."""
    cut = [i for i, p in enumerate(points) if p]
    inf = float("inf")
    # Buckets hold their lower end, hence the signs.
    turned = df.withColumns({f"_x{i}": 0.0 - _number(features[i]) for i in cut})
    found = Bucketizer(
        splitsArray=[[-inf, *sorted(0.0 - v for v in points[i]), inf] for i in cut],
        inputCols=[f"_x{i}" for i in cut], outputCols=[f"_b{i}" for i in cut],
        handleInvalid="keep").transform(turned) if cut else turned
    return found.withColumns({
        name: F.lit(len(points[i])) - F.col(f"_b{i}").cast("int") if points[i] else F.lit(0)
        for i, name in enumerate(names)}).drop(*[f"_{k}{i}" for i in cut for k in "xb"])


def _pack(cells: DataFrame, bins: list[str], counts: list[str], cells_at_most: int) -> DataFrame:
    """Distinct cells as rows of packed arrays, written once."""
    spark = cells.sparkSession
    spread = 2 * spark.sparkContext.defaultParallelism
    parts = max(1, min(spread, cells_at_most // 1000), cells_at_most // (GROUP_CELLS // 2))

    def pack(batches):
        tables = [b for b in batches if b.num_rows]
        if tables:
            t = pa.Table.from_batches(tables)
            b = np.stack([t[c].to_numpy() for c in bins], 1).astype(np.uint8)
            n = np.stack([t[c].to_numpy() for c in counts] or [np.zeros(0)], 1).astype(np.int64)
            yield _batch(_CHUNK, [(TaskContext.get().partitionId(), len(b), b, n)])

    return materialize(cells.repartition(parts, *bins).mapInArrow(pack, _CHUNK), "cells")


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split() for c in schema.split(", ")]
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([
        pa.array([r[i].tobytes() if kind == "binary" else int(r[i]) for r in rows], kinds[kind])
        for i, (_, kind) in enumerate(names)], [name for name, _ in names])


def _arrays(value, kind, width: int = 0) -> np.ndarray:
    """A packed array, of rows of `width` if given."""
    flat = np.frombuffer(value, kind)
    return flat.reshape(-1, width) if width else flat


def _chunks(batches, n_features: int, n_counts: int = 0):
    for batch in batches:
        for r in batch.to_pylist():
            yield (r["chunk"], _arrays(r["bins"], np.uint8, n_features),
                   _arrays(r["rows"], np.int64, n_counts))


# -- draws ------------------------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64 bits of 64 bits."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _of(*numbers: int) -> np.ndarray:
    """An array of one element that tells the numbers apart."""
    key = np.zeros(1, np.uint64)
    for n in numbers:
        key = _mix(key ^ np.uint64(n))
    return key


def _uniform(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(11)) * 2.0 ** -53


def cell_keys(bins: np.ndarray) -> np.ndarray:
    key = np.zeros(len(bins), np.uint64)
    for f in range(bins.shape[1]):
        key = _mix(key ^ bins[:, f].astype(np.uint64))
    return key


@lru_cache(1)
def _poisson_table() -> tuple[np.ndarray, np.ndarray]:
    """Distribution functions of the means 1 to TABLE, each raised by its mean, behind one another."""
    parts, start, at = [], np.zeros(TABLE + 1, np.int64), 0
    for n in range(1, TABLE + 1):
        k = np.arange(int(n + 10 * math.sqrt(n) + 12))
        log = k * math.log(n) - n - np.concatenate([[0.0], np.cumsum(np.log(k[1:]))])
        upto = np.minimum(np.cumsum(np.exp(log)), 1.0)
        upto[-1] = 1.0
        parts.append(n + upto)
        start[n], at = at, at + len(k)
    return np.concatenate(parts), start


def poisson(mean: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Poisson draws of whole means, one for each key; beyond TABLE a normal draw, corrected for
    skewness and rounded."""
    flat, start = _poisson_table()
    drawn = np.zeros(len(mean), np.int64)
    few = np.flatnonzero((mean > 0) & (mean <= TABLE))
    n = mean[few]
    drawn[few] = np.searchsorted(flat, n + _uniform(key[few]), side="right") - start[n]
    many = np.flatnonzero(mean > TABLE)
    if len(many):
        n, u = mean[many].astype(float), 1.0 - _uniform(key[many])
        z = np.sqrt(-2 * np.log(u)) * np.cos(2 * math.pi * _uniform(_mix(key[many])))
        drawn[many] = np.maximum(np.rint(n + np.sqrt(n) * z + (z * z - 1) / 6), 0)
    return drawn


def _drawn(rows: np.ndarray, keys: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often a tree takes the rows of each cell and class."""
    return np.stack([poisson(rows[:, k], _mix(keys ^ _of(seed, tree, k)))
                     for k in range(rows.shape[1])], 1)


def _chosen(seed: int, tree: np.ndarray, ids: np.ndarray, n_features: int) -> np.ndarray:
    """The features that a node looks at, drawn by its tree and place: a square root of them."""
    node = _mix(_mix(tree.astype(np.uint64) ^ _of(seed)) ^ ids.astype(np.uint64))
    mark = np.stack([_mix(node ^ _of(f + 1)) for f in range(n_features)], 1)
    ranks = mark.argsort(axis=1).argsort(axis=1)
    return ranks < math.ceil(math.sqrt(n_features))


# -- growing ----------------------------------------------------------------------------------

class _Best:
    """The best split found so far of each node, by the Gini impurity."""

    def __init__(self, total: np.ndarray):
        self.total, whole = total, total.sum(1)
        self.score = (total * total).sum(1) / np.maximum(whole, 1.0) * (1 + 1e-12)
        self.feature = np.full(len(total), -1, np.int8)
        self.cut = np.zeros(len(total), np.uint8)

    def look(self, f: int, key: np.ndarray, sums: list[np.ndarray]) -> None:
        """Look at feature `f`; `key` is 256 * node + bin, in order, `sums` are counts per class."""
        upto = [np.cumsum(s) for s in sums]
        end = np.flatnonzero(key[1:] != key[:-1])
        node, following = key[end] >> 8, key[end + 1] >> 8
        last = node != following
        inner = end[~last]
        if not len(inner):
            return
        node, left, right = node[~last], 0.0, 0.0
        n_left, n_right = 0.0, 0.0
        for k, s in enumerate(upto):
            before = np.zeros(len(self.total))
            before[following[last]] = s[end[last]]
            a = s[inner] - before[node]
            b = self.total[node, k] - a
            left, right, n_left, n_right = left + a * a, right + b * b, n_left + a, n_right + b
        score = left / n_left + right / n_right
        first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        top = np.maximum.reduceat(score, first)
        hit = np.flatnonzero(score == np.repeat(top, np.diff(np.append(first, len(node)))))
        hit = hit[np.concatenate([[True], node[hit][1:] != node[hit][:-1]])]
        who = node[first]
        better = top > self.score[who]
        who = who[better]
        self.score[who], self.feature[who] = top[better], f
        self.cut[who] = key[inner[hit[better]]] & 255


def _open(total: np.ndarray, ids: np.ndarray, depth: int) -> np.ndarray:
    return (total.max(1) < total.sum(1)) & (ids < 1 << depth)


def grow(bins: np.ndarray, rows: np.ndarray, at: np.ndarray, tree: np.ndarray, ids: np.ndarray,
         depth: int, seed: int) -> tuple[np.ndarray, ...]:
    """Grow the nodes `ids` of `tree` to their leaves, all at once and level by level; `at` has the
    node of each cell. Arrays of the nodes, the given ones first: feature (-1: leaf), cut (greater
    goes right), left child (the right one follows; for a leaf its row of votes); and the votes."""
    n_features, sums = bins.shape[1], [rows[:, k].astype(float) for k in range(rows.shape[1])]
    made, votes, offset, leaves = [], [], 0, 0
    while len(ids):
        nodes = len(ids)
        best = _Best(np.stack([np.bincount(at, s, nodes) for s in sums], 1))
        looks = _chosen(seed, tree, ids, n_features) & _open(best.total, ids, depth)[:, None]
        for f in range(n_features):
            some = np.flatnonzero(looks[at, f])
            key = (at[some].astype(np.int64) << 8) | bins[some, f]
            order = np.argsort(key)
            some = some[order]
            best.look(f, key[order], [s[some] for s in sums])
        split = best.feature >= 0
        rank = np.cumsum(split) - 1
        leaf = np.cumsum(~split) - 1 + leaves
        made.append((best.feature, best.cut,
                     np.where(split, offset + nodes + 2 * rank, leaf).astype(np.int32)))
        ends = best.total[~split]
        votes.append(np.rint(ends / np.maximum(ends.sum(1, keepdims=True), 1) * VOTE).astype(np.int32))
        leaves, offset = leaves + len(ends), offset + nodes
        keep = np.flatnonzero(split[at])
        bins, at, sums = bins[keep], at[keep], [s[keep] for s in sums]
        right = bins[np.arange(len(at)), best.feature[at]] > best.cut[at]
        at = 2 * rank[at] + right
        tree, ids = np.repeat(tree[split], 2), np.repeat(2 * ids[split], 2)
        ids[1::2] += 1
    return *(np.concatenate(x) for x in zip(*made)), np.concatenate(votes)


def walk(feature: np.ndarray, cut: np.ndarray, left: np.ndarray, bins: np.ndarray,
         at: np.ndarray) -> np.ndarray:
    """The leaves that cells come to from the nodes `at`."""
    at, going = at.copy(), np.arange(len(at))
    while len(going):
        f = feature[at[going]]
        going, f = going[f >= 0], f[f >= 0]
        node = at[going]
        at[going] = left[node] + (bins[going, f] > cut[node])
    return at


class _Tops:
    """The splits above the groups: nodes of all trees, the first ones their roots."""

    def __init__(self, trees: int, cells: int):
        self.tree, self.ids = list(range(trees)), [1] * trees
        self.size, self.ended = [cells] * trees, {}  # cells of a node; counts of a leaf with many
        self.feature, self.cut, self.left = [-1] * trees, [0] * trees, [0] * trees

    def arrays(self) -> tuple[np.ndarray, ...]:
        return (np.array(self.feature, np.int8), np.array(self.cut, np.uint8),
                np.array(self.left, np.int32))

    def split(self, node: int, feature: int, cut: int, sizes: tuple[int, int]) -> None:
        self.feature[node], self.cut[node], self.left[node] = feature, cut, len(self.ids)
        for side, size in enumerate(sizes):
            self.tree.append(self.tree[node])
            self.ids.append(2 * self.ids[node] + side)
            self.size.append(size)
            self.feature.append(-1)
            self.cut.append(0)
            self.left.append(0)


def _split_tops(tops: _Tops, packed: DataFrame, n_features: int, bins: int, classes: int, depth: int,
                seed: int, group_cells: int) -> None:
    """Split nodes with more than `group_cells` cells, a level of all trees at a time."""
    trees = max(tops.tree) + 1
    while wide := [i for i, size in enumerate(tops.size)
                   if size > group_cells and tops.feature[i] < 0 and i not in tops.ended]:
        arrays = tops.arrays()
        place = np.full(len(tops.ids), -1, np.int64)  # among the wide nodes of its tree
        of_tree = {t: [i for i in wide if tops.tree[i] == t] for t in {tops.tree[i] for i in wide}}
        for nodes in of_tree.values():
            place[nodes] = np.arange(len(nodes))
        ids = np.array(tops.ids, np.int64)
        shape = (n_features, bins, classes + 1)

        def histograms(batches):
            """Counts per node, feature, bin and class, and of cells, added up over a task."""
            sums = {}
            for _, b, rows in _chunks(batches, n_features, classes):
                keys = cell_keys(b)
                for t, nodes in of_tree.items():
                    n = _drawn(rows, keys, seed, t)
                    at = place[walk(*arrays, b, np.full(len(b), t))]
                    some = np.flatnonzero((at >= 0) & (n.sum(1) > 0))
                    n, at, own = n[some], at[some], b[some]
                    total = sums.setdefault(t, np.zeros((len(nodes), *shape)))
                    for f in range(n_features):
                        where = at * bins + own[:, f]
                        for k in range(classes + 1):
                            total[:, f, :, k] += np.bincount(
                                where, n[:, k] if k < classes else None, len(nodes) * bins
                            ).reshape(-1, bins)
            for t, total in sums.items():
                yield _batch("tree int, sums binary", [(t, total)])

        def choose(table):
            tree = table["tree"][0].as_py()
            nodes = of_tree[tree]
            total = sum(_arrays(x.as_py(), float) for x in table["sums"]).reshape(-1, *shape)
            best = _Best(total[:, 0, :, :classes].sum(1))
            looks = _chosen(seed, np.full(len(nodes), tree), ids[nodes], n_features) & _open(
                best.total, ids[nodes], depth)[:, None]
            for f in range(n_features):
                key = np.flatnonzero(((total[:, f, :, classes] > 0) & looks[:, f, None]).ravel())
                flat = total[:, f].reshape(-1, classes + 1)[key]
                best.look(f, (key // bins << 8) | key % bins, [flat[:, k] for k in range(classes)])
            upto = total[np.arange(len(nodes)), np.maximum(best.feature, 0), :, classes].cumsum(1)
            left = upto[np.arange(len(nodes)), best.cut].astype(np.int64)
            right = upto[:, -1].astype(np.int64) - left
            return pa.table({
                "node": pa.array(nodes, pa.int32()), "feature": pa.array(best.feature, pa.int32()),
                "cut": pa.array(best.cut, pa.int32()), "left": pa.array(left), "right": pa.array(right),
                "total": pa.array([list(map(int, x)) for x in best.total], pa.list_(pa.int64()))})

        found = packed.mapInArrow(histograms, "tree int, sums binary").repartition(
            min(trees, 4 * packed.sparkSession.sparkContext.defaultParallelism), "tree").groupBy(
            "tree").applyInArrow(choose, "node int, feature int, cut int, left long, right long, "
                                         "total array<long>").collect()
        for r in sorted(found, key=lambda r: r["node"]):
            if r["feature"] < 0:
                tops.ended[r["node"]] = list(r["total"])
            else:
                tops.split(r["node"], r["feature"], r["cut"], (r["left"], r["right"]))


def grow_forest(df: DataFrame, features: list[str], label: str, points: list[list[float]],
                trees: int, depth: int, seed: int, group_cells: int = GROUP_CELLS) -> ForestModel:
    """A forest on all rows of `df`, whose `label` is a class number."""
    spark, n_features, bins = df.sparkSession, len(features), 1 + max(map(len, points))
    if bins > 256:
        raise ValueError("a feature has at most 255 points")
    names = [f"_bin{i}" for i in range(n_features)]
    counted = materialize(with_bins(df, features, points, names).groupBy(
        *names, F.col(label).cast("int").alias("_class")).agg(F.count(F.lit(1)).alias("_n")), "counts")
    cells_at_most, classes, rows = counted.agg(
        F.count(F.lit(1)), F.max("_class") + 1, F.sum("_n")).first()
    if not cells_at_most:
        raise ValueError("a forest needs rows")
    kind = np.int32 if rows < 1 << 30 else np.int64
    counts = [f"_n{k}" for k in range(classes)]
    packed = _pack(counted.groupBy(*names).agg(*[
        F.sum(F.when(F.col("_class") == k, F.col("_n")).otherwise(0)).alias(c)
        for k, c in enumerate(counts)]), names, counts, cells_at_most)
    cells = packed.agg(F.sum("size")).first()[0]

    tops = _Tops(trees, cells)
    _split_tops(tops, packed, n_features, bins, classes, depth, seed, group_cells)
    roots = [i for i, f in enumerate(tops.feature) if f < 0]
    size = np.array([1 if i in tops.ended else tops.size[i] for i in roots])
    parallel = 4 * spark.sparkContext.defaultParallelism
    share = max(1, min(group_cells, int(size.sum()) // parallel))
    group = (np.cumsum(size) - size) // share
    group = np.unique(group, return_inverse=True)[1]
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    place = np.arange(len(roots)) - first[group]
    to_group, to_place = np.full((2, len(tops.ids)), -1, np.int64)
    to_group[roots], to_place[roots] = group, place
    members = [[(tops.tree[i], tops.ids[i]) for i in part]
               for part in np.split(np.array(roots), first[1:])]
    arrays, ended = tops.arrays(), np.isin(np.arange(len(tops.ids)), list(tops.ended))

    def deal(batches):
        for _, b, rows in _chunks(batches, n_features, classes):
            keys = cell_keys(b)
            for t in range(trees):
                n = _drawn(rows, keys, seed, t)
                node = walk(*arrays, b, np.full(len(b), t))
                some = np.flatnonzero((n.sum(1) > 0) & ~ended[node])
                yield from _dealt(_PIECE, to_group[node[some]], [
                    to_place[node[some]].astype(np.int32), b[some], n[some].astype(kind)])

    def grown(table):
        number = table["group"][0].as_py()
        tree, ids = np.array(members[number], np.int64).T
        found = grow(_joined(table["bins"], np.uint8, n_features),
                     _joined(table["rows"], kind, classes),
                     _joined(table["root"], np.int32).astype(np.int64), tree, ids, depth, seed)
        return pa.Table.from_batches([_batch(_NODES, [(number, *found)])])

    # A leaf above the groups is a node of one cell.
    dealt = packed.mapInArrow(deal, _PIECE)
    if tops.ended:
        whole = [(int(to_group[i]), bytearray(np.array([to_place[i]], np.int32).tobytes()),
                  bytearray(n_features), bytearray(np.array(n, kind).tobytes()))
                 for i, n in tops.ended.items()]
        dealt = dealt.unionByName(spark.createDataFrame(whole, _PIECE))
    parts = min(len(members), 32 * spark.sparkContext.defaultParallelism)
    nodes = dealt.repartition(parts, "group").groupBy("group").applyInArrow(grown, _NODES)
    path = scratch(spark, "forest")
    nodes.write.parquet(path)
    return ForestModel({
        "points": points, "classes": classes, "trees": trees, "groups": len(members),
        "tops": [a.tolist() for a in (*arrays, to_group, to_place)]}, path)


def _dealt(schema: str, group: np.ndarray, columns: list[np.ndarray], *keys: int):
    """One batch of a row per group."""
    order = np.argsort(group, kind="stable")
    group = group[order]
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else []
    parts = zip(*[np.split(c[order], first[1:]) for c in columns]) if len(first) else ()
    rows = [(group[i], *keys, *part) for i, part in zip(first, parts)]
    if rows:
        yield _batch(schema, rows)


def _joined(column, kind, width: int = 0) -> np.ndarray:
    return np.concatenate([_arrays(x.as_py(), kind, width) for x in column])


# -- the model --------------------------------------------------------------------------------

class ForestModel(Model, MLWritable, MLReadable):
    """Adds the class that most votes are for, by number; nodes are read from `path`."""

    def __init__(self, shape: dict, path: str):
        super().__init__()
        self.shape, self.path = shape, path

    @property
    def points(self) -> list[list[float]]:
        return self.shape["points"]

    def _transform(self, df: DataFrame) -> DataFrame:
        n = len(self.points)
        values, names = [f"_value{i}" for i in range(n)], [f"_bin{i}" for i in range(n)]
        rows = with_bins(df.withColumns({v: vector_to_array("_features")[i] for i, v in enumerate(
            values)}), values, self.points, names).drop(*values)
        found = self.cell_classes(rows.select(*names).distinct())
        return rows.join(found, names).drop(*names)

    def cell_classes(self, cells: DataFrame) -> DataFrame:
        """The cells, distinct rows of bin numbers, with `prediction`."""
        spark, names = cells.sparkSession, cells.columns
        n_features, classes, trees = len(names), self.shape["classes"], self.shape["trees"]
        cells = materialize(cells, "distinct")
        packed = _pack(cells, names, [], cells.count())
        *tops, to_group, to_place = (np.array(a, kind) for a, kind in zip(
            self.shape["tops"], (np.int8, np.uint8, np.int32, np.int64, np.int64)))
        parallel = 32 * spark.sparkContext.defaultParallelism
        # Few groups and many cells: each group is read by several tasks.
        copies = max(1, (packed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] * trees
                         // (4 * GROUP_CELLS)) // self.shape["groups"])
        piece = "group int, copy int, chunk int, root binary, bins binary, cell binary"
        voted = "chunk int, cell binary, votes binary"

        def deal(batches):
            for chunk, b, _ in _chunks(batches, n_features):
                for t in range(trees):
                    node = walk(*tops, b, np.full(len(b), t))
                    yield from _dealt(piece, to_group[node], [
                        to_place[node].astype(np.int32), b, np.arange(len(b), dtype=np.int32)],
                        chunk % copies, chunk)

        def vote(pieces, nodes):
            if not pieces.num_rows:
                return pa.Table.from_batches([_batch(voted, [])])
            row = nodes.to_pylist()[0]
            left = _arrays(row["left"], np.int32)
            at = walk(_arrays(row["feature"], np.int8), _arrays(row["cut"], np.uint8), left,
                      _joined(pieces["bins"], np.uint8, n_features),
                      _joined(pieces["root"], np.int32).astype(np.int64))
            votes = _arrays(row["votes"], np.int32, classes)[left[at]]
            ends = np.cumsum([len(x.as_py()) // 4 for x in pieces["cell"]])[:-1]
            return pa.Table.from_batches([_batch(voted, [
                (c.as_py(), _arrays(x.as_py(), np.int32), v) for c, x, v in zip(
                    pieces["chunk"], pieces["cell"], np.split(votes, ends))])])

        def count(votes, chunk):
            row = chunk.to_pylist()[0]
            total = np.zeros((row["size"], classes), np.int64)
            for x, v in zip(votes["cell"], votes["votes"]):
                total[_arrays(x.as_py(), np.int32)] += _arrays(v.as_py(), np.int32, classes)
            b = _arrays(row["bins"], np.uint8, n_features)
            return pa.table({**{c: pa.array(b[:, i].astype(np.int32)) for i, c in enumerate(names)},
                             "prediction": pa.array(total.argmax(1).astype(float))})

        nodes = spark.read.schema(_NODES).parquet(self.path).withColumn(
            "copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        keys, parts = ["group", "copy"], min(parallel, self.shape["groups"] * copies)
        votes = packed.mapInArrow(deal, piece).repartition(parts, *keys).groupBy(*keys).cogroup(
            nodes.repartition(parts, *keys).groupBy(*keys)).applyInArrow(vote, voted)
        parts = max(1, min(parallel, packed.count()))
        found = votes.repartition(parts, "chunk").groupBy("chunk").cogroup(
            packed.repartition(parts, "chunk").groupBy("chunk")).applyInArrow(
            count, ", ".join(f"{c} int" for c in names) + ", prediction double")
        return materialize(found, "classes")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = SparkSession.active()
        DefaultParamsWriter.saveMetadata(self.model, path, spark, {"shape": self.model.shape})
        spark.read.schema(_NODES).parquet(self.model.path).write.parquet(f"{path}/nodes")


class _Reader(MLReader):
    def load(self, path: str) -> ForestModel:
        told = DefaultParamsReader.loadMetadata(path, SparkSession.active())
        model = ForestModel(told["shape"], f"{path}/nodes")
        model._resetUid(told["uid"])
        return model
