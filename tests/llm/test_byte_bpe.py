"""Byte-level BPE against the tiktoken library on whole texts, and round trips."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from conftest import SMALL

from millrace.llm import byte_bpe as own
from millrace.llm.queries import QUERIES

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
ODD = ["", " ", "   ", "  a", "a  ", "\n\n x", "it's 'sabc don't", "abc123!?x", "日本語 テキスト",
       "🙂🙂\U0010fffe", "\x00\x01\x1c \x85\xa0x", "<|endoftext|>", "a 　b", "'s", "x's"]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in
             map(bytes.split, open(RANKS, "rb").read().splitlines())}
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return own.codec(open(RANKS, "rb").read(), PATTERN)


def test_odd_texts(codec, library):
    for text in ODD:
        assert codec.encode(text).tolist() == library.encode_ordinary(text)
        assert codec.decode(codec.encode(text)) == text.encode()


def test_segments_do_not_change_ids(codec, library):
    chance = random.Random(3)
    marks = "   \n\t\x85　\x1cabé日1²'s!-🙂"
    for _ in range(3000):
        text = "".join(chance.choice(marks) for _ in range(chance.randint(0, 60)))
        size, run = chance.randint(1, 9), chance.randint(2, 5)
        assert "".join(part for part, _ in own.segments(text, size, run)) == text
        assert codec.encode(text, size, run).tolist() == library.encode_ordinary(text), repr(text)


def test_very_long_texts(codec, library):
    prose = "The quick brown fox, it's 12 years old.\n\n  And then " * 6000
    assert codec.encode(prose).tolist() == library.encode_ordinary(prose)
    assert max(len(part) for part, _ in own.segments(prose)) < own.SEGMENT + 20
    for text in (" " * 1_500_000 + "x", "x" + "\n" * 1_500_000, "日" * 200_000, "ab1" * 100_000):
        assert codec.decode(codec.encode(text)) == text.encode()
    blank = "x" + " " * 50_000 + "yes" + "\t" * 50_000
    padded = blank + " word" * 20_000
    assert codec.encode(padded).tolist() == library.encode_ordinary(padded)


def test_query_against_the_library(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet")
            .collect()}
    got = QUERIES["op13_byte_bpe"](spark, SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(docs[r.doc_id].encode()).hexdigest())


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (1, None, "x"), (None, "a b", None), (2, "", None), (3, "é" * 300_000, "")],
        "doc_id long, text string, ids string")
    got = own.byte_bpe(docs.withColumn("doc", docs.doc_id).withColumn("decoded", docs.text), RANKS,
                       PATTERN).collect()
    assert sorted(bytes(r.decoded).decode() for r in got) == ["", "", "", "a b", "é" * 300_000]
    assert [r.doc.ids for r in got if not r.ids].count("x") == 2
    assert own.byte_bpe(docs.where("false"), RANKS, PATTERN).collect() == []


def test_columns_apart(spark):
    docs = spark.createDataFrame([("it's", [1, 2]), (None, None)], "text string, ids array<int>")
    coded = docs.withColumn("own", own.bpe_encode("text", RANKS, PATTERN))
    got = coded.select("text", "own", own.bpe_decode("own", RANKS, PATTERN).alias("back"),
                       own.bpe_decode("ids", RANKS, PATTERN).alias("other")).collect()
    assert bytes(got[0].back) == b"it's" and got[1].own == [] and bytes(got[1].other) == b""
