"""Sharding by balanced label propagation.

Documents with equal texts are linked. Rows start in shards by hash; a linked document wants to go
where most of its neighbours are. As all rows of a text are neighbours of each other, one round tells
every wish; what is left is room. Shards admit whole groups, larger ones first, as far as their quota
allows, counted without the rows that leave; a group refused there goes to a shard that has room for
all of it, and is cut only if there is none, which happens to fewer groups than there are shards.
Documents without links have no wish and fill what is left, so in the end all shards hold the same
number of rows, to one.

Work goes on (group, shard) counts, the joins are equi-joins of plain columns which Spark splits for
a hot group, and places are numbered by buckets, never by one window per shard.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialize, query, table

BUCKET_ROWS = 1024  # rows that one window numbers, about


def hashed(*columns: Column | str) -> Column:
    return F.xxhash64(*columns)


def numbered(rows: DataFrame, by: list[str], order: list[str], tier: Column, total: int,
             name: str) -> DataFrame:
    """`rows` with a gapless number from 0 per `by`, by `tier` and then by hash of `order`.

    Rows are put into buckets by hash; the rows before a bucket come from the bucket counts.
    """
    buckets = 1 + total // BUCKET_ROWS
    spread = hashed(*order, F.lit("place"))
    placed = rows.withColumn("_spread", spread).withColumn(
        "_bucket", tier.cast("long") * buckets + F.pmod("_spread", F.lit(buckets)))
    counts = placed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)
                                                       ).alias("_before"))
    within = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy("_spread", *order))
    return placed.withColumn("_within", within).join(offsets, [*by, "_bucket"]).withColumn(
        name, F.col("_before") + F.col("_within") - 1).drop(
        "_spread", "_bucket", "_before", "_within")


def allot(kinds: list[tuple[int, int, int]], rooms: list[int]) -> tuple[list, list]:
    """Shards for `kinds`, (members, wish, groups): whole groups as (members, wish, low, high, shard)
    for the groups numbered low to high - 1 of a kind, and what is cut as (members, wish, place, low,
    high, shard) for the rows numbered low to high - 1 of one group.

    Larger groups first; a shard takes those that wish it, then those refused elsewhere, the
    fullest shard that has room first. A group is cut only when no shard has room for all of it.
    Less than `members` is then free in each shard, and that is all that the rows not placed yet
    have, earlier cut groups (none smaller) among them: fewer groups than shards are ever cut.
    """
    rooms, by_size, whole, cut = list(rooms), {}, [], []
    for members, wish, n in kinds:
        by_size.setdefault(members, []).append((wish, n))
    for members in sorted(by_size, reverse=True):
        refused = []
        for wish, n in sorted(by_size[members]):
            own = min(n, rooms[wish] // members)
            rooms[wish] -= own * members
            if own:
                whole.append((members, wish, 0, own, wish))
            if own < n:
                refused.append((wish, own, n))
        for wish, at, n in refused:
            for _, shard in sorted((room, i) for i, room in enumerate(rooms) if room >= members):
                more = min(n - at, rooms[shard] // members)
                if more:
                    rooms[shard] -= more * members
                    whole.append((members, wish, at, at + more, shard))
                    at += more
            cut += [(members, wish, place) for place in range(at, n)]
    pieces = []
    for members, wish, place in cut:  # after all whole groups, into the fewest shards
        at = 0
        for room, shard in sorted(((room, i) for i, room in enumerate(rooms)), reverse=True):
            more = min(members - at, room)
            if more:
                rooms[shard] -= more
                pieces.append((members, wish, place, at, at + more, shard))
                at += more
    return whole, pieces


def small_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A broadcast table of whole numbers, from Arrow (no Python rows)."""
    columns = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * len(names))]
    return F.broadcast(spark.createDataFrame(pa.Table.from_arrays(columns, names)))


def settle(rows: DataFrame, rooms: list[int]) -> DataFrame:
    """`rows` (row columns, group, h, shard) with `members`, and the shard of linked rows settled."""
    spark = rows.sparkSession
    held = rows.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("n"))
    wishes = materialize(held.groupBy("group").agg(
        F.max(F.struct("n", hashed("group", "shard").alias("x"), "shard")).alias("best"),
        F.sum("n").alias("members")).where("members > 1").select(
        "group", "members", F.col("best.shard").alias("wish")), "wishes")
    # Sizes that differ are as many as the root of twice the rows at most.
    kinds = [(r["members"], r["wish"], r["n"]) for r in wishes.groupBy("members", "wish").agg(
        F.count(F.lit(1)).alias("n")).collect()]
    whole, pieces = allot(kinds, rooms)
    places = numbered(wishes, ["members", "wish"], ["group"], F.lit(0), sum(k[2] for k in kinds),
                      "at").withColumnRenamed("wish", "first")
    bound = small_table(spark, whole, ["_members", "_first", "_low", "_high", "target"])
    going = materialize(places.join(bound, (F.col("members") == F.col("_members")) & (
        F.col("first") == F.col("_first")) & (F.col("at") >= F.col("_low")) & (
        F.col("at") < F.col("_high")), "left").select("group", "members", "first", "at", "target"),
        "going")
    linked = materialize(rows.join(going, "group", "left").withColumn(
        "members", F.coalesce("members", F.lit(1).cast("long"))).withColumn(
        "shard", F.coalesce(F.col("target").cast("int"), F.col("shard"))), "settled")
    columns = [*rows.columns, "members"]
    done = linked.where("members = 1 or target is not null").select(*columns)
    if not pieces:
        return done
    torn = numbered(linked.where("members > 1 and target is null"), ["group"],
                    ["h", "id", "group"], F.lit(0), sum(p[4] - p[3] for p in pieces), "row")
    parts = small_table(spark, pieces, ["_members", "_first", "_at", "_low", "_high", "_shard"])
    torn = torn.join(parts, (F.col("members") == F.col("_members")) & (
        F.col("first") == F.col("_first")) & (F.col("at") == F.col("_at")) & (
        F.col("row") >= F.col("_low")) & (F.col("row") < F.col("_high"))).withColumn(
        "shard", F.col("_shard").cast("int"))
    return done.unionByName(torn.select(*columns))


def balanced_shards(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    shards: int = 8) -> DataFrame:
    """(id, size, text_crc32, members, shard, slot) per row; counts of shards are at most one apart
    and slots run from 0 without a gap.

    `members` is the number of rows with this text. A null text counts as the empty one (size 1).
    Rows with null keys are placed like any others; repeated rows each have a place. Groups larger
    than a shard fill shards and go on in others. No rows give no rows, and other columns are not
    read, whatever their names. A very long text is one row like any other; only its digest and
    length go on.
    """
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = materialize(docs.select(
        F.col(key).alias("id"), (F.octet_length(said) + 1).cast("long").alias("size"),
        F.crc32(said.cast("binary")).alias("text_crc32"), F.unhex(F.md5(said.cast("binary"))
                                                                  ).alias("group")).withColumn(
        "h", hashed("id", "group")).withColumn(
        "shard", F.pmod(hashed("h", F.lit("first")), F.lit(shards)).cast("int")), "rows")
    total = rows.count()
    rooms = [total // shards + (i < total % shards) for i in range(shards)]
    settled = settle(rows, rooms)
    tier = F.when(F.col("members") == 1, 1).otherwise(0)
    order = ["h", "id", "group"]
    placed = materialize(numbered(settled, ["shard"], order, tier, total, "place"), "placed")
    own_quota = F.lit(total // shards) + F.when(F.col("shard") < total % shards, 1).otherwise(0)
    kept = placed.where(F.col("place") < own_quota).withColumn("slot", F.col("place"))
    # Shards with room left, as one row that holds `shards` entries.
    counts = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    every = docs.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    room = every.join(F.broadcast(counts), "shard", "left").select(
        "shard", F.least(F.coalesce("n", F.lit(0)), own_quota).alias("n"), own_quota.alias("quota"))
    gaps = room.agg(F.sort_array(F.collect_list(F.struct("shard", "n", "quota"))).alias("room"))
    moved = numbered(placed.where(F.col("place") >= own_quota).drop("place").withColumn(
        "all", F.lit(0)), ["all"], order, F.lit(0), total, "over")
    # Each entry with the number of free places before it.
    lined = F.expr("""transform(room, (x, i) -> struct(x.shard AS shard, x.n AS n,
        aggregate(slice(room, 1, i), 0L, (a, y) -> a + y.quota - y.n) AS before,
        x.quota - x.n AS free))""")
    gaps = gaps.select(lined.alias("room"))
    moved = moved.drop("shard").crossJoin(F.broadcast(gaps)).withColumn("to", F.expr(
        "filter(room, x -> over >= x.before AND over < x.before + x.free)[0]")).withColumn(
        "shard", F.col("to.shard")).withColumn(
        "slot", F.col("to.n") + F.col("over") - F.col("to.before"))
    columns = ["id", "size", "text_crc32", "members", "shard", "slot"]
    return kept.select(*columns).unionByName(moved.select(*columns))


@query("op9_sharding")
def op9(spark, sf_dir):
    placed = balanced_shards(table(spark, sf_dir, "documents"), "doc_id")
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32",
                         F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))
