"""Shards: the law, gapless slots, and fewer cut groups than by hash."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from millrace.llm import sharding
from millrace.llm.queries import QUERIES


def law_holds(rows, shards=8):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op9_sharding"](spark, SMALL).collect()
    law_holds(rows)
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (
            len(raw) + 1, zlib.crc32(raw), "rows", None)
    where = defaultdict(set)
    for r in rows:
        where[docs[r.doc_id]].add(r.shard)
    assert all(len(found) == 1 for found in where.values())


@pytest.mark.parametrize("bucket", [3, 1024])
def test_groups_stay_together_where_there_is_room(spark, monkeypatch, bucket):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket)
    # a third of the rows are one text; 100 groups of 2 to 9; the rest is alone
    texts = ["hot"] * 700 + [f"g{i}" for i in range(100) for _ in range(2 + i % 8)]
    texts += [f"alone {i}" for i in range(2100 - len(texts))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sharding.balanced_shards(docs).collect()
    law_holds(rows)
    where = defaultdict(Counter)
    for r in rows:
        where[texts[r.id]][r.shard] += 1
    cut = [t for t, found in where.items() if len(found) > 1 and t != "hot"]
    assert len(cut) <= 2
    assert max(where["hot"].values()) > 2 * 700 / 8  # more together than by hash
    again = sharding.balanced_shards(docs).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


@pytest.mark.parametrize("n", [0, 1, 5, 8, 9, 17])
def test_small_and_odd_tables(spark, n):
    rows = [(None if i % 3 == 0 else i // 2, None if i % 4 == 0 else "" if i % 4 == 1 else "x" * i)
            for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn(
        "shard", F.lit("mine")).withColumn("slot", F.lit(1)).withColumn("group", F.lit(2))
    law_holds(sharding.balanced_shards(docs).collect())


def test_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "same")] * 40 + [(2, "other")] * 3, "doc_id long, text string")
    rows = sharding.balanced_shards(docs).collect()
    law_holds(rows)
    assert Counter(r.id for r in rows) == {1: 40, 2: 3}


@pytest.mark.parametrize("sizes", [[2] * 800, [10] * 160, [10] * 144 + [1] * 160,
                                   [533] + [10] * 96 + [1] * 107, [110] * 14 + [2] * 30])
def test_groups_stay_whole_where_most_rows_are_linked(spark, sizes):
    texts = [f"g{i}" for i, n in enumerate(sizes) for _ in range(n)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sharding.balanced_shards(docs).collect()
    law_holds(rows)
    where = defaultdict(set)
    for r in rows:
        where[texts[r.id]].add(r.shard)
    cut = [t for t, found in where.items() if len(found) > 1]
    assert len(cut) < 8 and (len(set(sizes)) > 1 or not cut)


def test_allotment_fills_the_rooms():
    chance = random.Random(5)
    for _ in range(300):
        shards = chance.randint(1, 9)
        kinds = [(n, w, chance.randint(1, 9)) for n in chance.sample(range(2, 99), chance.randint(0, 9))
                 for w in range(shards) if chance.random() < 0.6]
        total = sum(n * g for n, _, g in kinds) + chance.randint(0, 50)
        rooms = [total // shards + (i < total % shards) for i in range(shards)]
        whole, pieces = sharding.allot(kinds, rooms)
        left = list(rooms)
        got = Counter()
        for n, w, low, high, shard in whole:
            left[shard] -= n * (high - low)
            got[n, w] += n * (high - low)
        for n, w, _, low, high, shard in pieces:
            left[shard] -= high - low
            got[n, w] += high - low
        assert min(left) >= 0 and got == Counter({(n, w): n * g for n, w, g in kinds})
        assert len({p[:3] for p in pieces}) < max(shards, 1) + (shards == 1 and bool(pieces))


def test_very_long_texts_are_rows_like_others(spark):
    texts = ["long " * 400_000] * 3 + [f"t{i}" for i in range(29)]
    docs = spark.createDataFrame(enumerate(texts), "doc_id long, text string")
    rows = sharding.balanced_shards(docs).collect()
    law_holds(rows)
    assert sorted(r.size for r in rows)[-3:] == [2_000_001] * 3
    assert len({r.shard for r in rows if r.size > 9}) == 1
