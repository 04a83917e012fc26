"""Licence scans against plain search, and expressions by hand."""

import re

import pytest
from conftest import SMALL

from millrace.llm import licences
from millrace.llm.licences import evaluate, postfix, read_parts
from millrace.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    words = WORD.findall((text or "").translate(LOWERED))
    places = sorted((i, label) for phrase, label in licences.BASE.items()
                    for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split())
    at = [i for i, _ in places]
    return (len(words), len(places), min(at, default=None), max(at, default=None),
            ",".join(sorted({label for _, label in places})))


def test_base_against_plain_search(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op6_licences"](spark, SMALL).collect()
    assert len(got) == len(docs) and any(r.n_base for r in got)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(docs[r.doc_id])
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels
        assert 0 <= r.score <= 1


@pytest.mark.parametrize("text,score,labels", [
    ("MIT", 0.9, ["mit"]),
    ("MIT OR GPL-2.0-only", 0.9, ["mit", "gpl-2.0-only"]),
    ("MIT AND GPL-2.0-only", 0.3, ["mit", "gpl-2.0-only"]),
    ("GPL-2.0-only WITH Classpath-exception-2.0 AND MIT", 0.4,
     ["gpl-2.0-only", "classpath-exception-2.0", "mit"]),
    ("(MIT OR AGPL-3.0) AND (CC0-1.0 OR GPL-3.0+)", 0.9, ["mit", "agpl-3.0", "cc0-1.0", "gpl-3.0+"]),
    ("AGPL-3.0 or mit and lgpl-2.1", 0.4, ["agpl-3.0", "mit", "lgpl-2.1"]),
    ("MIT */", 0.9, ["mit"]), ("MIT License text", 0.9, ["mit"]), ("Strange-1", 0.0, ["strange-1"]),
    ("((MIT))", 0.9, ["mit"]), ("MIT) AND", 0.9, ["mit"]),
])
def test_expressions(text, score, labels):
    value, named = evaluate(postfix(read_parts(text, 0)))
    assert value == pytest.approx(score) and sorted(named) == sorted(labels)


@pytest.mark.parametrize("text", ["", "MIT AND", "(MIT OR", "AND MIT", "()", "(MIT", "*/"])
def test_broken_expressions_are_left_out(text):
    assert postfix(read_parts(text, 0)) is None


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "The MIT\nLicense, gnu-general public.license", "a"),
            (3, "The MIT\nLicense, gnu-general public.license", "a"),
            (4, "// SPDX-License-Identifier: Apache-2.0 OR MIT\ncc by nc apache license", None),
            (None, "x " * 100000 + "CC BY MIT license é" + "cc by", "a"),
            (5, "SPDX-License-Identifier: (MIT", "a"), (6, "émit license mit licenses", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found string")
    got = {(r.doc.doc_id, r.doc.text): r
           for r in licences.scan_licences(docs.withColumn("score", docs.doc_id)).collect()}
    found = {k[0]: [(f.word, f.label, f.base) for f in r.found] for k, r in got.items()}
    assert found[1] == found[2] == found[5] == found[6] == []
    assert found[3] == [(1, "mit", True), (3, "gpl", True)]
    assert found[4] == [(8, "cc-by", True), (8, "cc-by-nc", False), (11, "apache", True),
                        (0, "apache-2.0", False), (0, "mit", False)]
    assert found[None] == [(100000, "cc-by", True), (100002, "mit", True)]
    assert [r.score for k, r in got.items() if k[0] == 4] == [0.3]
    assert licences.scan_licences(docs.where("false")).collect() == []
    assert len(licences.scan_licences(docs).collect()) == len(rows)
