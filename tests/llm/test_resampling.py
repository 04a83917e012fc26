"""Importance resampling: SQL twin, hashes against zlib, a plain version, odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from conftest import SMALL
from oracle import compare, connect

from millrace.llm import resampling as own
from millrace.llm.queries import ORACLES, QUERIES

NAME = "op12_importance_resampling"


def plain_features(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    runs = [" ".join(words[i:i + k]) for i in range(len(words)) for k in (1, 2, 3)
            if i + k <= len(words)]
    return words, [zlib.crc32(run.encode()) % 10_000 for run in runs]


def test_matches_sql(spark):
    assert compare(spark, connect(SMALL), SMALL, QUERIES[NAME], ORACLES[NAME])[0] == "exact"


def test_buckets_against_zlib(monkeypatch):
    chance = random.Random(4)
    marks = "  abcXYZé日🙂0-\n_\x7f\x80'"
    texts = ["", " ", "one", "x" * 300 + " " + "é" * 700 + " a", "A b C"] + [
        "".join(chance.choice(marks) for _ in range(chance.randint(0, 80))) for _ in range(300)]
    for stretch in (own.STRETCH, 5):
        monkeypatch.setattr(own, "STRETCH", stretch)
        n_words, n_features, got = own.feature_buckets([t.encode() for t in texts], 10_000)
        at = 0
        for text, words, n in zip(texts, n_words, n_features):
            want_words, want = plain_features(text)
            assert words == len(want_words) and n == len(want), repr(text)
            assert sorted(got[at:at + n].tolist()) == sorted(want)
            at += n
    assert own.feature_buckets([], 7)[2].tolist() == []


def test_shift_is_concatenation():
    sizes = np.array([0, 1, 5, 255, 256, 70_000])
    crc = np.array([zlib.crc32(b"left")] * len(sizes), np.uint32)
    tails = [bytes(range(256)) * 300][0]
    got = own.shifted(crc, sizes) ^ np.array([zlib.crc32(tails[:n]) for n in sizes], np.uint32)
    assert got.tolist() == [zlib.crc32(b"left" + tails[:n]) for n in sizes]


def plain(docs, target, percent=5):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(plain_features(text)[1])
    for text in target:
        t.update(plain_features(text)[1])
    S, T = s.total(), t.total()
    rows = []
    for doc_id, text in docs:
        words, found = plain_features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + 10_000)
                                                / ((s[b] + 1) * (T + 10_000)))) for b in found)
        key = f"42:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, len(words) >= 20])
    fits = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, row in enumerate(fits[:percent * len(fits) // 100], 1):
        row[4] = i
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def test_plain_version_and_odd_rows(spark):
    chance = random.Random(8)
    words = [f"w{i}" for i in range(60)] + ["Ä", "日本", "MiX"]
    docs = [(i, " ".join(chance.choices(words, k=chance.randint(0, 60)))) for i in range(400)]
    docs += [(1000, None), (1001, ""), (None, "some words " * 30), (1002, docs[5][1]),
             (1003, "long text and " * 60_000)]
    target = ["w1 w2 w3 mix", None, "日本 Ä"]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, score int")
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = own.importance_resample(frame, wanted, keep=["doc_id", "score"], percent=20).collect()
    found = sorted(((r.doc.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got), key=repr)
    assert found == plain(docs, target, 20)
    assert {r.doc.score for r in got} == {1}


def test_repeated_rows_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(30))
    frame = spark.createDataFrame([(1, text)] * 40, "doc_id long, text string")
    none = frame.where("false")
    got = own.importance_resample(frame, none.select("text")).collect()
    assert len({(r.weight, r.score) for r in got}) == 1
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2]
    assert own.importance_resample(none, frame.select("text")).collect() == []
