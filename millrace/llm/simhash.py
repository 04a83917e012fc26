"""SimHash near-duplicates by vantage-point trees.

Fingerprints are compared as distinct values only, so copies cost nothing here. A top tree, fitted
on a bounded sample, deals every fingerprint to one home shard; a fingerprint within the radius of a
border also visits the shards beyond it (each pair of shards once). Within a shard a tree over the
home fingerprints is built and visitors are streamed past it in blocks; both trees leave out a
branch when the triangle inequality rules it out. A shard puts out a spanning forest of its links,
not the links, so a group of near copies costs as many rows as it has members; components of the
forest are components of the links.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import LOWER_BYTES, materialize, query, table
from millrace.llm.components import components

SAMPLE = 1 << 16       # fingerprints, at most about so many, that the top tree is fitted on
SHARD_ROWS = 4096      # home fingerprints of a shard that the top tree aims at
WIDE_ROWS = 1 << 16    # the same where the radius is so wide that the top tree leaves out no shard
SHARD_HASHES = 1 << 22  # shingle hashes that the home rows of a shard hold, aimed at
LEAF_ROWS = 128        # fingerprints in a leaf within a shard
BLOCK = 512            # visitors compared at once
PRINT = 4              # 64-bit words of the fingerprints of near copies
DRAWN = 16             # sampled fingerprints that a border of the top tree rests on, at least


def shingles(text: bytes, words: int) -> list[bytes]:
    """All shingles of the lower-cased words, repeats included; the whole sequence if it is shorter."""
    found = text.translate(LOWER_BYTES).split()
    if not found:
        return []
    joined = b" ".join(found)
    if len(found) <= words:
        return [joined]
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return [joined[s:e] for s, e in zip(starts[:len(found) - words + 1].tolist(),
                                        ends[words - 1:].tolist())]


def hashes(found: list[bytes], width: int) -> np.ndarray:
    """One row of `width` 64-bit hashes per shingle: XXH64 with seed 42, wider ones XXH3."""
    if width == 1:
        raw = b"".join([xxhash.xxh64_digest(s, 42) for s in found])
    else:
        raw = b"".join([xxhash.xxh3_128_digest(s, 42) for s in found])
    return np.frombuffer(raw, ">u8").astype(np.uint64).reshape(len(found), width)


def widened(hashed: np.ndarray, width: int) -> np.ndarray:
    """Rows of `width` numbers: the given ones, then mixed copies of them (splitmix64)."""
    parts = [hashed]
    for turn in range(1, -(-width // hashed.shape[1])):
        x = hashed + np.uint64(turn * 0x9E3779B97F4A7C15 % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        parts.append(x ^ (x >> np.uint64(31)))
    return np.concatenate(parts, axis=1)[:, :width]


def fingerprint(hashed: np.ndarray) -> np.ndarray:
    """Bits that over half of the rows have, as `width` unsigned numbers; zero without rows."""
    width = hashed.shape[1]
    counts = np.zeros(64 * width, np.int64)
    for at in range(0, len(hashed), 1 << 15):
        part = np.ascontiguousarray(hashed[at:at + (1 << 15)], dtype="<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), -1), axis=1,
                             bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return np.packbits(2 * counts > len(hashed), bitorder="little").view("<u8")


def prints(text: str, words: int, width: int = 1, sets: bool = False):
    """Struct column: `print` (8 * width bytes, big-endian) and `n_shingles`; with `sets` also
    `shingle_set` (sorted distinct hashes), which then also make the fingerprint, and `set_key`."""
    kind = "print binary, n_shingles long" + (
        ", set_key binary, shingle_set array<long>" if sets else "")

    def print_texts(texts: pa.Array) -> pa.Array:
        rows, counts, keys, held = [], [], [], []
        for text in pc.fill_null(texts, "").cast(pa.large_binary()).to_pylist():
            hashed = hashes(shingles(text, words), min(width, 2))
            if sets:
                hashed = np.unique(hashed, axis=0)
                own = np.sort(hashed[:, 0]).view(np.int64)
                held.append(own)
                keys.append(hashlib.md5(own.tobytes()).digest())
            rows.append(fingerprint(widened(hashed, width)).astype(">u8").tobytes())
            counts.append(len(hashed))
        columns = [pa.array(rows, pa.binary()), pa.array(counts, pa.int64())]
        if sets:
            columns += [pa.array(keys, pa.binary()), pa.array(held, pa.list_(pa.int64()))]
        return pa.StructArray.from_arrays(columns, [p.split()[0] for p in kind.split(", ")])

    return F.arrow_udf(print_texts, kind)(F.col(text).cast("string"))


def numbers(column: pa.Array, width: int) -> np.ndarray:
    """Fingerprints of a binary column as rows of unsigned numbers."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, width)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    found = np.bitwise_count(a[..., 0] ^ b[..., 0]).astype(np.int16)
    for i in range(1, a.shape[-1]):  # a sum over so short an axis takes several times as long
        found += np.bitwise_count(a[..., i] ^ b[..., i])
    return found


class Tree:
    """A vantage-point tree as a complete binary tree: children of node i are 2i+1 and 2i+2.

    The inner child holds what lies within the node's border, the outer child the rest.
    """

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        inner = (1 << depth) - 1
        self.points = np.zeros((inner, points.shape[1]), np.uint64)
        self.borders = np.zeros(inner, np.int16)
        members = [np.arange(len(points))]
        for level in range(depth):
            parted = []
            for k, own in enumerate(members):
                node = (1 << level) - 1 + k
                if len(own):
                    # The point furthest from any one point of the node parts it most unevenly in
                    # distance, which leaves fewest near the border.
                    far = own[np.argmax(distance(points[own], points[own[0]]))]
                    gaps = distance(points[own], points[far])
                    self.points[node], self.borders[node] = points[far], np.median(gaps)
                    # Equal distances stay together; the emptier side takes the border if it can.
                    if 2 * (gaps <= self.borders[node]).sum() > 1.5 * len(own) and (
                            gaps < self.borders[node]).any():
                        self.borders[node] -= 1
                    inside = gaps <= self.borders[node]
                    parted += [own[inside], own[~inside]]
                else:
                    parted += [own, own]
            members = parted
        self.leaves = members

    def homes(self, found: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        node = np.zeros(len(found), np.int64)
        for _ in range(self.depth):
            inside = distance(found, self.points[node]) <= self.borders[node]
            node = 2 * node + np.where(inside, 1, 2)
        return node - ((1 << self.depth) - 1)

    def visits(self, found: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of all leaves that may hold a point within the radius."""
        row, node = np.arange(len(found)), np.zeros(len(found), np.int64)
        for _ in range(self.depth):
            gap, border = distance(found[row], self.points[node]), self.borders[node]
            inner, outer = gap <= border + radius, gap > border - radius
            row = np.concatenate((row[inner], row[outer]))
            node = np.concatenate((2 * node[inner] + 1, 2 * node[outer] + 2))
        return row, node - ((1 << self.depth) - 1)


class Groups:
    """Groups of the home rows of a shard; labels are kept flat."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: int, b: int) -> bool:
        x, y = self.label[a], self.label[b]
        if x == y:
            return False
        self.label[self.label == max(x, y)] = min(x, y)
        return True


def alike(a: np.ndarray, b: np.ndarray, share: float) -> bool:
    """Jaccard similarity of two sorted sets, exactly."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common >= share * (len(a) + len(b) - common)


class Shard:
    """Home rows of a shard, with their tree, and the links found so far as a forest."""

    def __init__(self, keys: list, points: np.ndarray, sets: list | None, radius: int,
                 share: float):
        self.keys, self.points, self.sets = keys, points, sets
        self.radius, self.share = radius, share
        self.tree = Tree(points, max(0, math.ceil(math.log2(max(1, len(keys)) / LEAF_ROWS))))
        self.groups = Groups(len(keys))

    def probe(self, keys: list, points: np.ndarray, sets: list | None,
              own: np.ndarray | None = None) -> Iterator[tuple]:
        """Edges that tie the given rows to the home rows; `own` are their places if they are home
        rows themselves, which are tied to earlier ones only."""
        for at in range(0, len(keys), BLOCK):
            block = points[at:at + BLOCK]
            rows, leaves = self.tree.visits(block, self.radius)
            near_row, near_home = [], []
            order = np.argsort(leaves, kind="stable")
            rows, leaves = rows[order], leaves[order]
            cuts = np.flatnonzero(np.diff(leaves)) + 1
            for some in np.split(np.arange(len(rows)), cuts):
                members = self.tree.leaves[leaves[some[0]]] if len(some) else ()
                if len(members):
                    r, h = np.nonzero(distance(block[rows[some]][:, None], self.points[members])
                                      <= self.radius)
                    near_row.append(rows[some][r])
                    near_home.append(members[h])
            if not near_row:
                continue
            r, h = np.concatenate(near_row), np.concatenate(near_home)
            if own is not None:
                earlier = h < own[at:at + BLOCK][r]
                r, h = r[earlier], h[earlier]
            order = np.lexsort((h, r))
            r, h = r[order], h[order]
            for some in np.split(np.arange(len(r)), np.flatnonzero(np.diff(r)) + 1):
                if len(some):
                    yield from self._tie(at + int(r[some[0]]), h[some], keys, sets, own)

    def _tie(self, row: int, homes: np.ndarray, keys: list, sets: list | None, own) -> Iterator:
        first = None if own is None else int(own[row])
        while len(homes):
            home = int(homes[0])
            if first is not None and self.groups.label[home] == self.groups.label[first]:
                homes = homes[self.groups.label[homes] != self.groups.label[first]]
                continue
            if sets is None or alike(sets[row], self.sets[home], self.share):
                yield keys[row], self.keys[home]
                if first is None:
                    first = home
                else:
                    self.groups.join(first, home)
            homes = homes[1:]


def _depths(counts: dict[int, int], sampled: dict[int, np.ndarray],
            shard_rows: int) -> dict[int, int]:
    return {zone: max(0, min(math.ceil(math.log2(max(1, n) / shard_rows)),
                             int(math.log2(max(1, len(sampled.get(zone, ())) / DRAWN)))))
            for zone, n in counts.items()}


def near_links(found: DataFrame, radius: int, width: int = 1, share: float | None = None,
               beside: bool = False, shard_rows: int | None = None) -> DataFrame:
    """Edges (a, b) of a forest that has the components of all links.

    `found` holds distinct keys with their `print`, a `zone` (few values) and, for `share`, their
    `shingle_set`. Two rows link if their prints differ in at most `radius` bits and, with `share`,
    their sets are that similar. Rows meet rows of their own zone and, with `beside`, of the zone
    after and before it.
    """
    has_sets = share is not None
    weight = F.sum(F.size("shingle_set")) if has_sets else F.lit(0)
    sized, heavy = {}, {}
    for r in found.groupBy("zone").agg(F.count(F.lit(1)).alias("n"), weight.alias("w")).collect():
        sized[r["zone"]], heavy[r["zone"]] = r["n"], r["w"]
    step = math.ceil(sum(sized.values()) / SAMPLE) or 1
    drawn: dict[int, list] = {}
    for r in found.where(F.pmod(F.xxhash64("print", F.lit("sample")), F.lit(step)) == 0
                         ).select("zone", "print").collect():
        drawn.setdefault(r["zone"], []).append(bytes(r["print"]))
    sampled = {zone: np.frombuffer(b"".join(sorted(p)), ">u8").astype(np.uint64).reshape(-1, width)
               for zone, p in drawn.items()}
    shard_rows = shard_rows or SHARD_ROWS
    depths = _depths({z: max(n, heavy[z] * shard_rows // SHARD_HASHES) for z, n in sized.items()},
                     sampled, shard_rows)
    trees, offsets, total = {}, {}, 0
    for zone in sorted(sized):
        trees[zone] = Tree(sampled.get(zone, np.zeros((0, width), np.uint64)), depths[zone])
        offsets[zone] = total
        total += 1 << depths[zone]
    payload = ["key", "print"] + (["shingle_set"] if has_sets else [])
    kinds = {f.name: f.dataType.simpleString() for f in found.schema}
    key_kind = kinds["key"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = numbers(batch.column("print"), width)
            zones = np.asarray(batch.column("zone"))
            for zone in np.unique(zones).tolist():
                at = np.flatnonzero(zones == zone)
                own = trees[zone].homes(points[at])
                picks, shards, home = [at], [own + offsets[zone]], [np.ones(len(at), bool)]
                row, leaf = trees[zone].visits(points[at], radius)
                later = leaf > own[row]
                picks.append(at[row[later]])
                shards.append(leaf[later] + offsets[zone])
                home.append(np.zeros(int(later.sum()), bool))
                if beside and zone + 1 in trees:
                    row, leaf = trees[zone + 1].visits(points[at], radius)
                    picks.append(at[row])
                    shards.append(leaf + offsets[zone + 1])
                    home.append(np.zeros(len(row), bool))
                pick, shard, mine = map(np.concatenate, (picks, shards, home))
                most = 1 << (8 if has_sets else 13)
                for s in range(0, len(pick), most):
                    part = batch.take(pa.array(pick[s:s + most]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard[s:s + most], pa.int32()), pa.array(mine[s:s + most])]
                        + [part.column(c) for c in payload], ["shard", "home", *payload])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, shard = None, [], None

        def edges(pairs) -> Iterator[pa.RecordBatch]:
            pairs = list(pairs)
            if pairs:
                yield pa.RecordBatch.from_pydict({"a": [p[0] for p in pairs],
                                                  "b": [p[1] for p in pairs]}, schema=shape)

        def unpack(part: pa.RecordBatch):
            sets = None
            if has_sets:
                lists = part.column("shingle_set")
                flat, ends = np.asarray(lists.flatten()), np.asarray(lists.value_lengths())
                sets = np.split(flat, np.cumsum(ends)[:-1]) if len(ends) else []
            return part.column("key").to_pylist(), numbers(part.column("print"), width), sets

        def built() -> Iterator[pa.RecordBatch]:
            nonlocal shard, held
            keys, points, sets = [], [np.zeros((0, width), np.uint64)], [] if has_sets else None
            for part in held:
                k, p, s = unpack(part)
                keys += k
                points.append(p)
                if has_sets:
                    sets += s
            points, held = np.concatenate(points), []
            shard = Shard(keys, points, sets, radius, share or 0.0)
            yield from edges(shard.probe(keys, points, sets, np.arange(len(keys))))

        for batch in batches:
            ids, homes = np.asarray(batch.column("shard")), np.asarray(batch.column("home"))
            cuts = np.flatnonzero((np.diff(ids) != 0) | (np.diff(homes.astype(np.int8)) != 0)) + 1
            for some in np.split(np.arange(len(ids)), cuts):
                if not len(some):
                    continue
                part = batch.slice(some[0], len(some))
                if ids[some[0]] != now:
                    if held:
                        yield from built()
                    now, shard = ids[some[0]], None
                if homes[some[0]]:
                    held.append(part)
                    continue
                if held or shard is None:
                    yield from built()
                yield from edges(shard.probe(*unpack(part)))
        if held:
            yield from built()

    shape = pa.schema([("a", _arrow(key_kind)), ("b", _arrow(key_kind))])
    dealt = found.select("zone", *payload).mapInArrow(
        deal, "shard int, home boolean, " + ", ".join(f"{c} {kinds[c]}" for c in payload))
    return dealt.repartitionById(max(total, 1), F.col("shard")).sortWithinPartitions(
        "shard", F.desc("home")).mapInArrow(search, f"a {key_kind}, b {key_kind}")


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}[kind]


def simhash_components(docs: DataFrame, key: str, text: str = "text", words: int = 3,
                       radius: int = 3) -> DataFrame:
    """(id, print as long, component_id) per row: rows whose fingerprints differ in at most
    `radius` bits link, and component_id is the smallest `key` that links lead to.

    A null or empty text has fingerprint zero and links like any other. Null keys keep their row;
    they name a component only if nothing else does (component_id null). Repeated rows each get
    their row. No rows give no rows. Other columns of `docs` are not read, whatever their names.
    All shingles of a very long text count; its words are in the memory of one task.
    """
    printed = materialize(docs.select(F.col(key).alias("id"), prints(text, words).alias("p")).select(
        "id", F.conv(F.hex("p.print"), 16, -10).cast("long").alias("key"), "p.print"), "prints")
    return _named(printed, "id", near_links(
        materialize(printed.groupBy("key").agg(F.min("print").alias("print")).withColumn(
            "zone", F.lit(0)), "distinct"), radius))


def _named(printed: DataFrame, key: str, edges: DataFrame) -> DataFrame:
    """`printed` with the smallest `id` of each row's component."""
    least = printed.groupBy("key").agg(F.min("id").alias("least"))
    roots = components(edges).withColumnRenamed("node", "key")
    least = materialize(least.join(roots, "key", "left").withColumn(
        "root", F.coalesce("root", "key")), "least")
    tops = least.groupBy("root").agg(F.min("least").alias("component_id"))
    by_key = least.select("key", "root").join(tops, "root").select("key", "component_id")
    return printed.join(by_key, "key").select("id", "key", "component_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
                    share: float = 0.8, radius: int = 84) -> DataFrame:
    """Struct `doc` (the input row), `group` (the row number that stands for it) and `kept`: one row
    of each group is kept, that of the smallest key.

    Documents link if the sets of their shingles have a Jaccard similarity of `share` or more; a
    group is what links reach. Candidates are found by 256-bit fingerprints of the sets: at a
    similarity of 0.8 each bit differs with a chance of 0.19 at most (sets of 4 and 5 shingles; 0.16
    or less for 60 common ones and more), so a radius of 84 misses three links in 10^8 for those and
    one in 10^12 for long texts, and two unrelated texts meet twice in 10^8. A smaller `share` wants
    a wider radius. The sets of candidates alone are then compared exactly. Sets that similar
    have sizes that differ by a factor of 1 / share at most, so fingerprints meet those of their own
    and the neighbouring size zones only.

    Texts without a word (null and empty ones too) are copies of each other. Null keys come after
    all others, equal keys in the order of the rows. No rows give no rows; input columns stay inside
    `doc`, so their names cannot clash. All shingles of a very long text count.
    """
    rows = materialize(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(key).alias("id"),
        prints(text, words, PRINT, sets=True).alias("p")
    ).select("doc", "id", F.col("p.set_key").alias("key"), "p.print",
             F.col("p.n_shingles").alias("n")).withColumn("row", F.monotonically_increasing_id()),
        "printed")
    step = math.log(1 / share) * (1 + 1e-9)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    distinct = materialize(rows.groupBy("key").agg(
        F.min("print").alias("print"), F.min("n").alias("n"), first.alias("first")).withColumn(
        "zone", F.when(F.col("n") > 0, F.floor(F.log("n") / step)).otherwise(-1).cast("int")),
        "distinct")
    # A radius of a third of the bits reaches every shard, so a fingerprint is sent to all of its
    # two zones; shards as large as a task can hold keep that small.
    near = materialize(near_links(distinct.select("key", "print", "zone"), radius, PRINT, beside=True,
                                  shard_rows=WIDE_ROWS), "near")
    ends = near.select(F.col("a").alias("key")).union(near.select("b")).distinct()
    some = ends.join(distinct, "key").select("key", "print", "zone", F.col("first.row").alias("row"))
    said = f"doc.`{text}`"
    sets = materialize(some.join(rows.select("row", F.col(said).alias("said")), "row").select(
        "key", "print", "zone", prints("said", words, PRINT, sets=True).alias("p")).select(
        "key", "print", "zone", "p.shingle_set"), "sets")
    roots = components(near_links(sets, radius, PRINT, share, beside=True)).withColumnRenamed("node", "key")
    grouped = distinct.select("key", "first").join(roots, "key", "left").withColumn(
        "root", F.coalesce("root", "key"))
    kept = materialize(grouped.groupBy("root").agg(F.min("first").alias("first")), "kept")
    named = grouped.select("key", "root").join(kept, "root").select(
        "key", F.col("first.row").alias("group"))
    return rows.join(named, "key").select("doc", "group", (F.col("row") == F.col("group")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that `near_duplicates` keeps."""
    return near_duplicates(docs, **options).where("kept").select("doc.*")


@query("op8_simhash_near_dedup")
def op8(spark, sf_dir):
    found = simhash_components(table(spark, sf_dir, "documents"), "doc_id")
    return found.select(F.col("id").alias("doc_id"),
                        F.lower(F.lpad(F.hex("key"), 16, "0")).alias("fingerprint"),
                        "component_id")
