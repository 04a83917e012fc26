"""The language model: base scores by brute force, gradients, lanes, held-out gain."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL

from millrace.llm import language_model as lm
from millrace.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    """{place: (held_out, n_tokens, n_known, train_tokens, base)} of (id, text) rows."""
    lists = [[*WORD.findall((text or "").translate(LOWERED)), ""] for _, text in rows]
    held = [zlib.crc32(("" if key is None else str(key)).encode()) % 5 == 1 for key, _ in rows]
    counts = Counter(t for own, out in zip(lists, held) if not out for t in own)
    n, v = sum(counts.values()), len(counts)
    return [(out, len(own), sum(t in counts for t in own), n,
             sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own))
            for own, out in zip(lists, held)]


def check(got, want):
    assert len(got) == len(want)
    for r, (held, n, known, total, base) in zip(got, want):
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert math.isfinite(r.score) and r.score < 0


@pytest.mark.parametrize("frequent", [1 << 17, 1500])
def test_base_by_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)  # the second leaves most words to the join
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    got = sorted(QUERIES["op5_language_model"](spark, SMALL).collect(), key=lambda r: r.doc_id)
    check(got, plain(docs))


def test_beats_the_base_on_held_out_texts(spark):
    rows = QUERIES["op5_language_model"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_learns_an_order_of_words(spark):
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words[(i + k) % 40] for k in range(200)) for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = [r for r in lm.score_documents(docs).collect() if r.held_out]
    assert sum(r.score for r in rows) > 0.6 * sum(r.base_score for r in rows)


def params():
    chance = np.random.default_rng(0)
    made = lm.first_params(np.sort(chance.integers(1, 999, lm.WORDS))[::-1].astype(float), 5000.0)
    return {k: v + chance.normal(size=v.shape).astype(np.float32) * 0.05 for k, v in made.items()}


def test_shares_sum_to_one():
    every = np.arange(lm.WORDS + 1)
    out, _ = lm._output(params(), np.zeros((len(every), lm.HIDDEN), np.float32), every)
    assert np.exp(out.astype(float)).sum() == pytest.approx(1, abs=1e-5)


def test_lanes_and_windows_do_not_change_the_score(monkeypatch):
    own, chance = params(), np.random.default_rng(1)
    sizes = chance.integers(1, 90, 40)
    ids = chance.integers(0, lm.WORDS + 1, sizes.sum())
    want = []
    for part in np.split(ids, np.cumsum(sizes)[:-1]):
        h, total = np.zeros((1, lm.HIDDEN), np.float32), 0.0
        for token in part:
            out, _ = lm._output(own, h, np.array([token]))
            total, h = total + float(out[0]), lm._step(own, h, np.array([token]))
        want.append(total)
    for lanes, window in ((512, 32), (3, 7), (1, 1)):
        monkeypatch.setattr(lm, "WIDE_LANES", lanes)
        monkeypatch.setattr(lm, "WIDE_WINDOW", window)
        assert lm.score_pool(own, ids, sizes) == pytest.approx(want, rel=1e-5)


def test_gradients(monkeypatch):
    monkeypatch.setattr(lm, "WINDOW", 200)
    own, chance = params(), np.random.default_rng(2)
    ids, sizes = chance.integers(0, lm.WORDS + 1, 300), np.array([100, 120, 80])
    grads = {}
    monkeypatch.setattr(lm.Trainer, "_update", lambda self, g, n: grads.update(g))
    lm.Trainer({k: v.copy() for k, v in own.items()}).pool(ids, sizes)
    for name, grad in grads.items():
        at = int(np.argmax(np.abs(grad)))
        losses = []
        for step in (0.01, -0.01):
            moved = {k: v.copy() for k, v in own.items()}
            moved[name].ravel()[at] += step
            losses.append(-lm.score_pool(moved, ids, sizes).sum())
        assert (losses[0] - losses[1]) / 0.02 == pytest.approx(grad.ravel()[at], rel=0.02)


def test_frequent_words_take_whole_classes(spark):
    rows = [("a", 90), ("b", 40), ("c", 40), ("d", 39), ("e", 2), ("f", 2), ("g", 1)]
    counts = spark.createDataFrame(rows, "word string, n long")
    names = lambda most: "".join(r["word"] for r in lm.frequent_words(counts, most))
    assert [names(n) for n in (0, 1, 2, 4, 5, 6, 7)] == [
        "", "a", "a", "abcd", "abcd", "abcdef", "abcdefg"]


def test_tokens():
    said = pa.array(["long ago", "A b\x0bc\x0c\x1fd  E É", None, "", "  x "])
    flat, sizes = lm.token_lists(said.slice(1))
    assert flat.to_pylist() == ["a", "b", "c", "\x1fd", "e", "É", "x"]
    assert sizes.tolist() == [6, 0, 0, 1]


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (3, "A  a b\n"), (4, "x " * 60000),
            (7, "never seen"), (10, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 as score", "'p' as part", "2 as held_out", "doc_id as row")
    got = lm.score_documents(docs).collect()
    check(sorted(got, key=lambda r: (str(r.doc_id), r.n_tokens)),
          [w for _, w in sorted(zip(rows, plain(rows)), key=lambda p: (str(p[0][0]), p[1][1]))])
    assert lm.score_documents(docs.where("false")).collect() == []
    lone = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    only = spark.createDataFrame([(lone, "a b")], "doc_id long, text string")
    check(lm.score_documents(only).collect(), plain([(lone, "a b")]))
