"""Phrase collocations: SQL twin, a plain version with forced collisions and small chunks, odd rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SMALL
from oracle import compare, connect

from millrace.llm import collocations as own
from millrace.llm.queries import ORACLES, QUERIES

NAME = "op11_collocations"
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, least, top=2000, longest=5):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang][tuple(words[i:i + size])] += 1
    out = []
    for lang, counts in f.items():
        found = []
        for phrase, a in counts.items():
            if len(phrase) == 1 or a < least:
                continue
            cuts = [(1000 * a * n[lang] // (counts[phrase[:k]] * counts[phrase[k:]]), k,
                     counts[phrase[:k]], counts[phrase[k:]]) for k in range(1, len(phrase))]
            score, _, left, right = min(cuts)
            held = any(100 * b >= 100 * a and len(p) > len(phrase) and any(
                p[i:i + len(phrase)] == phrase for i in range(len(p)))
                for p, b in counts.items() if b >= least)
            if not held:
                found.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def mined(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1) for r in rows], "text string, lang string, n int")
    return sorted(map(tuple, own.mine_collocations(docs.repartition(3), **options).collect()))


@pytest.fixture(scope="module")
def rows():
    chance = random.Random(6)
    words = ["the", "of", "New", "york", "stock", "é", "日本", "a\x00b", "x" * 40, "\x1c", "not"]
    marks = ["  ", " ", " ", " ", " ", "\t", ". ", ", ", "\n", "; "]
    out = []
    for i in range(120):
        text = "".join(chance.choice(words) + chance.choice(marks)
                       for _ in range(chance.randint(0, 60)))
        out.append((text, chance.choice(["en", "en", "en", "fr", None, "und"])))
    return out + [(None, "en"), ("", None), ("...", "de"), ("one", "de"), (out[3][0], out[3][1])]


def test_matches_sql(spark):
    assert compare(spark, connect(SMALL), SMALL, QUERIES[NAME], ORACLES[NAME])[0] == "exact"


def test_plain_version(spark, rows):
    want = plain(rows, 4)
    assert len(want) > 100 and {r[0] for r in want} == {"en", "fr", "und"}
    assert mined(spark, rows, least=4) == want
    assert mined(spark, rows, least=4, top=7) == [r for r in want if r[1] <= 7]


@pytest.mark.parametrize("sizes", [own.Sizes(bits=6), own.Sizes(bits=11, chunk=50, held=10)])
def test_collisions_and_small_chunks_change_nothing(spark, rows, sizes):
    assert mined(spark, rows, least=4, sizes=sizes) == plain(rows, 4)


def test_longest_is_a_parameter(spark, rows):
    for longest in (2, 3):
        assert mined(spark, rows, least=4, sizes=own.Sizes(longest=longest)) == plain(
            rows, 4, longest=longest)


def test_prints_are_those_of_the_stretch():
    text = own.Text([b"ab  ab c", b"x ab c"], np.zeros(2, np.uint64), own.Sizes())
    assert text.data.tobytes() == b"ab ab c x ab c "
    first = text.sequences(2)
    assert first.tolist() == [0, 1, 3, 4]
    prints = text.prints(first, 2)
    assert prints[1] == prints[3] and len(set(prints.tolist())) == 3
    assert text.words().tolist()[0] == text.words().tolist()[1]


def test_very_long_text_and_empty_table(spark):
    text = "alpha beta gamma. " * 300_000
    got = mined(spark, [(text, "en"), ("word " * 1000, "en")])
    assert {r[2]: r[3] for r in got} == {
        "alpha beta gamma": 300_000, "word word": 999, "word word word": 998,
        "word word word word": 997, "word word word word word": 996}
    docs = spark.createDataFrame([], "text string, lang string")
    assert own.mine_collocations(docs).collect() == []


def test_hot_phrase_is_exact_beyond_64_bits(spark):
    words = spark.createDataFrame([("en", 4 * 10**15)], "lang string, n long")
    known = spark.createDataFrame([("en", "a b", 10**15), ("en", "a", 2 * 10**15), ("en", "b", 10**15)],
                                  "lang string, phrase string, n long")
    assert own.cut_scores(known, words).first().score == 1000 * 10**15 * 4 * 10**15 // (2 * 10**30)
