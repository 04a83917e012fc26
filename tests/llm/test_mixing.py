"""Mixing: SQL twin, budgets against a plain water-filling, prefixes across buckets."""

import random
from fractions import Fraction

from conftest import SMALL
from oracle import compare, connect
from pyspark.sql import functions as F

from millrace.llm import mixing
from millrace.llm.queries import ORACLES, QUERIES


def test_matches_sql(spark):
    name = "op4_mixing"
    assert compare(spark, connect(SMALL), SMALL, QUERIES[name], ORACLES[name])[0] == "exact"


def share(given, children):
    """Budgets of children {name: (room, weight)}: full ones drop out until the rest can share."""
    out, left = {}, dict(children)
    while left:
        total = sum(w for _, w in left.values())
        full = [n for n, (room, w) in left.items() if room <= Fraction(given * w, total)]
        if not full:
            return out | {n: given * w // total for n, (_, w) in left.items()}
        for n in full:
            out[n] = left.pop(n)[0]
            given -= out[n]
    return out


def test_budgets_against_plain_water_filling(spark):
    chance = random.Random(3)
    rows = [(a, b, 1, chance.choice([0, 5, 100, 1000, 10**12])) for a in "pqrs"
            for b in "uvwxyz"[:chance.randint(1, 6)]]
    weights = [{"p": 7, "q": 2}, {"u": 5, "x": 3}]
    leaves = spark.createDataFrame(rows, "a string, b string, docs long, tokens long")
    for budget in (0, 17, 2500, 10**12, 10**15):
        got = {(r.a, r.b): r.budget for r in
               mixing.leaf_budgets(leaves, ["a", "b"], weights, budget, 2).collect()}
        tops = share(budget, {a: (2 * sum(r[3] for r in rows if r[0] == a), weights[0].get(a, 1))
                              for a in {r[0] for r in rows}})
        want = {}
        for a, given in tops.items():
            for b, n in share(given, {r[1]: (2 * r[3], weights[1].get(r[1], 1))
                                      for r in rows if r[0] == a}).items():
                want[a, b] = n
        assert got == want


def mix(docs, budget=None, epochs=2):
    return mixing.mix_sources(docs, {"s": F.col("source")}, [{}], budget=budget, epochs=epochs)


def test_prefix_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    docs = spark.range(500).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 9).cast("int")).alias("text"),
        F.lit("only").alias("source"))
    tokens = {i: i % 9 for i in range(500)}
    total = sum(tokens.values())
    for budget in (0, 1, 777, total - 1, total, total + 5, 2 * total, 9 * total):
        rows = mix(docs, budget).collect()
        passes, rest = divmod(min(budget, 2 * total), total)
        by_epoch = {}
        for r in rows:
            by_epoch.setdefault(r.epoch, []).append(r.doc.doc_id)
        assert [len(by_epoch.get(e, ())) for e in range(passes)] == [500] * passes
        last = by_epoch.get(passes, [])
        read = sum(tokens[i] for i in last)
        assert (rest <= read < rest + 9) if rest else not last
        assert len(set(last)) == len(last)


def test_other_seeds_take_other_documents(spark):
    docs = spark.range(300).selectExpr("id as doc_id", "'a b c' as text", "'s' as source")
    picks = [{r.doc.doc_id for r in mixing.mix_sources(
        docs, {"s": F.col("source")}, [{}], budget=300, seed=seed).collect()} for seed in (1, 2)]
    assert picks[0] != picks[1] and all(len(p) == 100 for p in picks)


def test_odd_rows(spark):
    rows = [(1, None, None, "k"), (2, "", "a", "k"), (None, "x y", None, None),
            (3, "x y z", "a", "k"), (3, "x y z", "a", "k"), (4, "w " * 200000, "b", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, epoch string")
    docs = docs.withColumn("s", docs.doc_id).withColumn("bucket", docs.doc_id)
    got = mix(docs, epochs=1).collect()
    assert sorted(str(r.doc.doc_id) for r in got) == ["2", "3", "3", "4", "None"] or (
        sorted(str(r.doc.doc_id) for r in got) == ["1", "2", "3", "3", "4", "None"])
    assert {r.s for r in got} == {"a", "b", "(none)"}
    assert mix(docs.where("false")).collect() == []
