"""Exact top-k search by inner product with ball trees.

Vectors are dealt to shards by a hash of their key. A shard builds a ball tree over its vectors and
works through blocks of queries: nodes are taken from a heap by their best upper bound over the
block, |q| r + <q, centre>, and a query leaves a node out when the bound is below the k-th score it
has already. That score is shared: each query first visits one shard, its home, and carries the k-th
score found there to all others. What is left of the shards' answers is ranked per query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialize, query, table

SHARD_ROWS = 16384   # vectors a shard aims at
SHARDS = 32          # shards at least, so that small tables are spread as well
LEAF_ROWS = 128
BLOCK = 256          # queries worked at once
LARGEST = 1 << 63    # whole numbers from here on do not fit into a long
LOW = -(1 << 63)


class BallTree:
    """Balls over the rows of `points`; rows that are alike stay in one leaf."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        self.children: list[tuple[int, int] | None] = []
        self.members: list[np.ndarray | None] = []
        if len(points):
            self._grow()

    def _node(self, own: np.ndarray) -> int:
        centre = self.points[own].mean(axis=0, dtype=np.float64)
        gaps = self.points[own] - centre
        self.centres.append(centre)
        self.radii.append(float(np.sqrt((gaps * gaps).sum(axis=1).max(initial=0.0))))
        self.children.append(None)
        self.members.append(None)
        return len(self.centres) - 1

    def _grow(self) -> None:
        everything = np.arange(len(self.points))
        open_ = [(self._node(everything), everything)]
        while open_:
            node, own = open_.pop()
            if len(own) <= LEAF_ROWS or self.radii[node] == 0:
                self.members[node] = own
                continue
            far = self.points[own]
            one = far[np.argmax(((far - self.centres[node]) ** 2).sum(axis=1))]
            other = far[np.argmax(((far - one) ** 2).sum(axis=1))]
            along = far @ (other - one)
            order = np.argsort(along, kind="stable")
            parts = own[order[:len(own) // 2]], own[order[len(own) // 2:]]
            self.children[node] = tuple(self._node(p) for p in parts)
            open_ += list(zip(self.children[node], parts))

    def bound(self, queries: np.ndarray, lengths: np.ndarray, node: int) -> np.ndarray:
        """No inner product of the node is above this, rounding included."""
        centre = self.centres[node]
        reach = lengths * (self.radii[node] + 1e-9 * (1 + np.sqrt(centre @ centre)))
        return queries @ centre + reach * (1 + 1e-9) + 1e-9


class Best:
    """The best k (score, id) of each query of a block; ties go to the smaller id."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.kth = k, floor.copy()
        self.row = np.zeros(0, np.int64)
        self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        row, score, ids = (np.concatenate(p) for p in ((self.row, row), (self.score, score),
                                                       (self.id, ids)))
        order = np.lexsort((ids, -score, row))
        row, score, ids = row[order], score[order], ids[order]
        heads = np.flatnonzero(np.diff(row, prepend=-1))
        place = np.arange(len(row)) - np.repeat(heads, np.diff(heads, append=len(row)))
        keep = place < self.k
        self.row, self.score, self.id = row[keep], score[keep], ids[keep]
        last = place == self.k - 1
        self.kth[row[last]] = np.maximum(self.kth[row[last]], score[last])


def scores(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exactly: in doubles where they hold every sum, then in longs,
    then in Python's integers, which is an error if a score does not fit into a long."""
    top = np.abs(queries).max(initial=0.0) * np.abs(points).max(initial=0.0) * queries.shape[1]
    if top < 2.0**53:
        return (queries @ points.T).astype(np.int64)
    queries, points = queries.astype(np.int64), points.astype(np.int64)
    if top < 2.0**62:
        return queries @ points.T
    found = queries.astype(object) @ points.T.astype(object)
    if found.size and not LOW <= found.min() <= found.max() < -LOW:
        raise OverflowError("an inner product of whole numbers does not fit into 64 bits")
    return found.astype(np.int64)


def search_block(tree: BallTree, ids: np.ndarray, queries: np.ndarray, own: np.ndarray,
                 floor: np.ndarray, k: int) -> Best:
    best = Best(len(queries), k, floor)
    if not tree.centres:
        return best
    lengths = np.sqrt((queries * queries).sum(axis=1))
    top = tree.bound(queries, lengths, 0)
    heap = [(-top.max(initial=-np.inf), 0, top)]
    while heap:
        _, node, bound = heapq.heappop(heap)
        active = np.flatnonzero(bound >= best.kth)
        if not len(active):
            continue
        if tree.children[node] is not None:
            for child in tree.children[node]:
                bounds = np.full(len(queries), -np.inf)
                bounds[active] = tree.bound(queries[active], lengths[active], child)
                if (bounds >= best.kth).any():
                    heapq.heappush(heap, (-bounds.max(), child, bounds))
            continue
        members = tree.members[node]
        found = scores(queries[active], tree.points[members])
        good = (found >= best.kth[active][:, None]) & (ids[members] != own[active][:, None])
        row, column = np.nonzero(good)
        best.add(active[row], found[row, column], ids[members][column])
    return best


def whole_numbers(vector: Column) -> Column:
    """floor(64 x) of every component; null if the vector or a component is null or not finite. A
    finite component whose floor(64 x) does not fit into a long is an error."""
    def all_below(limit: float) -> Column:
        return F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) * 64 < limit, F.lit(False)))

    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * 64))
    finite = F.forall(vector, lambda x: F.coalesce(
        F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    too_large = F.raise_error(F.lit("floor(64 x) of a component does not fit into a long"))
    return F.when(all_below(float(LARGEST)), scaled).when(finite, too_large.cast("array<long>"))


def _searcher(k: int):
    shape = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, tree, ids = None, [], None, None

        def rows(part: pa.RecordBatch, n: int) -> np.ndarray:
            return np.asarray(part.column("vector").flatten(), np.float64).reshape(len(part), n)

        def build(n: int) -> None:
            nonlocal tree, ids, held
            points = np.concatenate([rows(p, n) for p in held] or [np.zeros((0, n))])
            ids = np.concatenate([np.asarray(p.column("id"), np.int64) for p in held]
                                 or [np.zeros(0, np.int64)])
            order = np.argsort(ids, kind="stable")
            tree, ids, held = BallTree(points[order]), ids[order], []

        for batch in batches:
            # Candidates of a shard come before its queries; shards hold vectors of one length.
            key = np.stack([np.asarray(batch.column(c)) for c in ("shard", "size", "asks")], axis=1)
            cuts = np.flatnonzero((np.diff(key, axis=0) != 0).any(axis=1)) + 1
            for some in np.split(np.arange(len(key)), cuts):
                if not len(some):
                    continue
                shard, size, asks = key[some[0]].tolist()
                if (shard, size) != now:
                    now, held, tree = (shard, size), [], None
                part = batch.slice(some[0], len(some))
                if not asks:
                    held.append(part)
                    continue
                if tree is None:
                    build(size)
                asked, own = rows(part, size), np.asarray(part.column("id"), np.int64)
                floor = np.asarray(part.column("floor"), np.int64)
                for at in range(0, len(own), BLOCK):
                    cut = slice(at, at + BLOCK)
                    best = search_block(tree, ids, asked[cut], own[cut], floor[cut], k)
                    if len(best.row):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(own[cut][best.row]), pa.array(best.id),
                             pa.array(best.score)], schema=shape)

    return search


def top_k(vectors: DataFrame, key: str, vector: str, asks: Column, k: int = 20) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): the k rows of highest inner product with each query.

    `vector` holds arrays of whole numbers; `asks` says which rows are queries. Every row is a
    candidate for all queries but those of its own key. Ties go to the smaller key; fewer than k
    candidates give fewer rows. Null keys and null vectors take no part, and vectors meet those of
    their own length only. Equal rows (key and vector) count once; rows of one key with different
    vectors are candidates each, and as queries they give one joint ranking. No rows give no rows,
    and other columns are not read, whatever their names.
    """
    usable = materialize(vectors.select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<long>").alias("vector"),
        F.coalesce(asks, F.lit(False)).alias("query")).where(
        "id is not null and vector is not null").dropDuplicates(["id", "vector"]), "vectors")
    shards = max(SHARDS, -(-usable.count() // SHARD_ROWS))
    home = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    size = F.size("vector")
    stored = usable.select(home.alias("shard"), size.alias("size"), F.lit(0).alias("asks"), "id",
                           "vector", F.lit(LOW).alias("floor"))
    asked = usable.where("query").select("id", "vector", home.alias("home"), size.alias("size"))

    def searched(found: DataFrame) -> DataFrame:
        rows = stored.unionByName(found.select(
            "shard", "size", F.lit(1).alias("asks"), "id", "vector", "floor"))
        return rows.repartitionById(shards, F.col("shard")).sortWithinPartitions(
            "shard", "size", "asks").mapInArrow(_searcher(k),
                                                "query_id long, vec_id long, score long")

    first = materialize(searched(asked.select(
        "*", F.col("home").alias("shard"), F.lit(LOW).alias("floor"))), "home")
    kth = first.groupBy(F.col("query_id").alias("id")).agg(
        F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") == k)
    others = asked.join(kth, "id", "left").select(
        "*", F.coalesce("least", F.lit(LOW)).alias("floor"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")).where("shard <> home")
    every = first.unionByName(searched(others))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return every.select("*", place.cast("int").alias("rank")).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding,
    lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank,
        vec_id, score FROM p)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20
"""


@query("op1_top_k", SQL)
def op1(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", whole_numbers(F.col("embedding")).alias("whole"))
    return top_k(vectors, "vec_id", "whole", F.col("vec_id") % 20 == 0, 20)
