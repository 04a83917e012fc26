"""SimHash components against brute force over all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from conftest import SMALL

from millrace.llm import simhash
from millrace.llm.components import components
from millrace.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_print(text, words=3):
    found = WORD.findall((text or "").translate(LOWERED))
    if not found:
        return 0
    parts = [" ".join(found[i:i + words]) for i in range(max(1, len(found) - words + 1))]
    hashed = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def plain_components(rows, radius=3):
    prints = [(key, plain_print(text)) for key, text in rows]
    values = np.array(sorted({p for _, p in prints}), np.uint64)
    top = {int(v): int(v) for v in values}

    def root(v):
        while top[v] != v:
            v = top[v]
        return v

    for i, v in enumerate(values):
        for w in values[i + 1:][np.bitwise_count(values[i + 1:] ^ v) <= radius]:
            top[root(int(w))] = root(int(v))
    least = {}
    for key, p in prints:
        if key is not None:
            least[root(p)] = min(key, least.get(root(p), key))
    return sorted(((key, f"{p:016x}", least.get(root(p))) for key, p in prints), key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_whole_table_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = plain_components([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(QUERIES["op8_simhash_near_dedup"](spark, SMALL)) == want


@pytest.fixture
def small_shards(monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_ROWS", 16)
    monkeypatch.setattr(simhash, "LEAF_ROWS", 4)
    monkeypatch.setattr(simhash, "DRAWN", 2)


def near_prints(n, seed):
    """Clusters around a few centres, so that many pairs are near the radius."""
    chance = random.Random(seed)
    centres = [chance.getrandbits(64) for _ in range(12)]
    out = set()
    while len(out) < n:
        p = chance.choice(centres)
        for _ in range(chance.randint(0, 6)):
            p ^= 1 << chance.randrange(64)
        out.add(p)
    return sorted(out)


@pytest.mark.parametrize("radius", [0, 3, 9])
def test_many_shards_lose_no_link(spark, small_shards, radius):
    values = near_prints(600, radius)
    rows = [(i, v.to_bytes(8, "big"), 0) for i, v in enumerate(values)]
    found = spark.createDataFrame(rows, "key long, print binary, zone int")
    edges = simhash.near_links(found, radius)
    roots = {r.node: r.root for r in components(edges).collect()}
    array = np.array(values, np.uint64)
    label = list(range(len(values)))
    for i, v in enumerate(array):
        for j in np.flatnonzero(np.bitwise_count(array ^ v) <= radius):
            a, b = label[i], label[j]
            if a != b:
                label = [min(a, b) if x in (a, b) else x for x in label]
    classes = {}
    for i in range(len(values)):
        classes.setdefault(label[i], set()).add(roots.get(i, i))
    assert all(len(c) == 1 for c in classes.values())
    assert len(set(map(lambda c: next(iter(c)), classes.values()))) == len(classes)


def test_zones_beside_each_other_meet(spark, small_shards):
    rows = [(z * 10 + i, (i << 8).to_bytes(8, "big"), z) for z in range(3) for i in range(1)]
    found = spark.createDataFrame(rows, "key long, print binary, zone int")
    assert len(simhash.near_links(found, 3, beside=True).collect()) == 2
    assert simhash.near_links(found, 3).collect() == []


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a b c d"), (4, "A B C D"), (4, "A B C D"),
            (5, "one"), (6, "One"), (7, long), (8, long + " end"), (None, "x y z q"), (9, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 as component_id", "2 as key", "3 as print")
    got = simhash.simhash_components(docs, "doc_id")
    got = rows_of(got.selectExpr("id", "lower(lpad(hex(key), 16, '0'))", "component_id"))
    assert got == plain_components(rows)
    assert simhash.simhash_components(docs.where("false"), "doc_id").collect() == []


def test_components_of_chains_and_stars(spark):
    chain = [(i + 1, i) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1300)]
    edges = spark.createDataFrame(chain + star + [(5, 5), (None, 3)], "a long, b long")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert {roots[i] for i in range(100, 161)} == {100}
    assert {roots[i] for i in [7, *range(1000, 1300)]} == {7}
    assert 5 not in roots and len(roots) == 61 + 301
    assert components(edges.where("false")).collect() == []
