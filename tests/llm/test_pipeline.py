"""The pipeline against a plain version of every stage, and near duplicates against all pairs."""

import random
import re

import corpus_pipeline
import duckdb
import pytest
import sentencepiece
from conftest import SMALL
from pyspark.sql import functions as F

from millrace.llm import mixing, pieces, simhash
from millrace.llm.quality_rules import SQL as QUALITY_SQL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, words=5):
    found = WORD.findall((text or "").translate(LOWERED))
    return {" ".join(found[i:i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def plain_groups(texts, share=0.8):
    """Label per text: what pairs of a Jaccard similarity of `share` or more connect."""
    sets, label = [shingle_set(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            b, common = sets[j], len(a & sets[j])
            if label[i] != label[j] and common >= share * (len(a) + len(b) - common):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def plain_keep(rows):
    """Of (id, text) rows in order: the places of those that stay."""
    label = plain_groups([t for _, t in rows])
    first = {}
    for place, (key, _) in enumerate(rows):
        rank = (key is None, key if key is not None else 0, place)
        first[label[place]] = min(first.get(label[place], rank), rank)
    return sorted(r[2] for r in first.values())


def near_copies(n, seed):
    chance = random.Random(seed)
    word = lambda: f"w{chance.randrange(4000)}"
    texts = []
    while len(texts) < n:
        base = [word() for _ in range(chance.choice([3, 8, 30, 80, 200]))]
        texts.append(" ".join(base))
        for _ in range(chance.choice([0, 0, 1, 4])):
            copy = list(base)
            for _ in range(chance.choice([0, 1, 2, 5])):
                copy[chance.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    return texts[:n]


def test_no_link_is_lost_at_the_border(spark):
    """Pairs of a similarity of 0.8 exactly, of 5 and 4 shingles, whose fingerprints differ most."""
    texts = []
    for i in range(600):
        found = [f"w{i}x{k}" for k in range(9)]
        texts += [" ".join(found), " ".join(found[:8])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = simhash.drop_near_duplicates(docs).collect()
    assert sorted(r.doc_id for r in kept) == list(range(0, 1200, 2))


@pytest.mark.parametrize("shards", [None, 8])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, shards):
    if shards:
        for name in ("SHARD_ROWS", "WIDE_ROWS", "LEAF_ROWS"):
            monkeypatch.setattr(simhash, name, shards)
        monkeypatch.setattr(simhash, "DRAWN", 2)
    texts = near_copies(400, 4)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = simhash.near_duplicates(docs).collect()
    assert sorted(r.doc.doc_id for r in got if r.kept) == plain_keep(list(enumerate(texts)))
    label, mine = plain_groups(texts), {r.doc.doc_id: r.group for r in got}
    assert len(set(zip(label, (mine[i] for i in range(len(texts)))))) == len(set(label))


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [(1, None, "a"), (2, "", "b"), (None, "  ", "c"), (3, "x y", "d"), (3, "X  y", "e"),
            (None, "q r s t u v", "f"), (4, long, "g"), (5, long + " more", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string").withColumn(
        "key", F.lit(1)).withColumn("row", F.lit(2)).withColumn("print", F.lit("p"))
    kept = simhash.drop_near_duplicates(docs).collect()
    assert kept[0].__fields__ == docs.columns
    assert sorted(str(r.doc_id) for r in kept) == ["1", "3", "4", "None"]
    assert simhash.drop_near_duplicates(docs.where("false")).collect() == []


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SMALL).cache()
        out.append((docs.toArrow(), made.toArrow(), docs.columns))
        docs = made
    return out


def test_every_stage_returns_the_columns_of_documents(stages):
    for before, after, columns in stages[:-1]:
        assert after.column_names == columns and 0 < after.num_rows


def test_quality_stage(stages):
    before, after, _ = stages[0]
    connection = duckdb.connect()
    connection.register("documents", before)
    want = connection.execute(f"SELECT doc_id FROM ({QUALITY_SQL}) WHERE kept ORDER BY 1").fetchall()
    assert sorted(after["doc_id"].to_pylist()) == [r[0] for r in want]


def test_near_copies_stage(stages):
    before, after, _ = stages[1]
    rows = list(zip(before["doc_id"].to_pylist(), before["text"].to_pylist()))
    assert sorted(after["doc_id"].to_pylist()) == sorted(rows[i][0] for i in plain_keep(rows))


def test_mixing_stage(stages):
    before, after, _ = stages[2]
    connection = duckdb.connect()
    connection.register("kept_docs", before)
    want = connection.execute("WITH " + mixing.mixing_sql("kept_docs", "doc_id, text")).fetchall()
    assert sorted(zip(after["doc_id"].to_pylist(), after["text"].to_pylist())) == sorted(want)


def test_encoding_stage(stages):
    before, after, _ = stages[3]
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    ids = {}
    for key, text in zip(before["doc_id"].to_pylist(), before["text"].to_pylist()):
        ids[key] = b"".join(i.to_bytes(4, "little") for i in
                            library.encode(text or "", add_bos=True, add_eos=True))
    assert after.num_rows == before.num_rows
    for r in after.to_pylist():
        assert r["ids"] == ids[r["doc_id"]] and r["n_tokens"] == len(r["ids"]) // 4
        assert r["round_trip"]


def test_run_is_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns == stages[-1][1].column_names and got.count() == stages[-1][1].num_rows
