"""Encoding and decoding against the sentencepiece library."""

import hashlib
import random

import pyarrow as pa
import pytest
import sentencepiece
from conftest import SMALL

from millrace.llm import pieces
from millrace.llm.queries import QUERIES

MODEL = pieces.default_model()
ODD = ["", " ", "  ", "   a", "a   ", " a  b ", "▁", "a▁b", "▁▁ ▁", "\n\n\t", "x" * 3000,
       "ab" * 999, " " * 2000 + "x", "日本語 テキスト", "🙂🙂 emoji\U0010fffe", "é è é", "\x00\x01",
       "<s> </s> <unk> <0x41>", "aaaaaaaaaaaaaaaaaaaaaaaaaaa", "1234567890 " * 30, "the the  the",
       "  non-breaking", "ſ ﬁ ① Ａ", "a" * 17 + " " * 17 + "a"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def check(library, texts):
    own = pieces.codec(open(MODEL, "rb").read())
    ids, borders = own.encode(pa.array(texts, pa.string()))
    decoded = own.decode(ids, borders).to_pylist()
    for i, text in enumerate(texts):
        want = library.encode(text, add_bos=True, add_eos=True)
        assert ids[borders[i]:borders[i + 1]].tolist() == want, repr(text[:50])
        assert decoded[i] == library.decode(want)


def test_odd_texts(library):
    check(library, ODD)


def test_random_texts(library):
    chance = random.Random(5)
    marks = "  ▁abcdefthein\n\t.,'#é日🙂ŝ"
    check(library, ["".join(chance.choice(marks) for _ in range(chance.randint(0, 60)))
                    for _ in range(3000)])
    vocabulary = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    check(library, ["".join(chance.choice(vocabulary) for _ in range(30)) for _ in range(2000)])


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr(pieces, "MEMORY", 3)
    for text in ("a b c d e", "f g a b", "c d a"):
        check(library, [text, None or ""])


def test_bytes_that_are_no_text():
    own = pieces.codec(open(MODEL, "rb").read())
    import numpy as np

    ids = np.array([1, int(own.model.bytes[0xE6]), 2], np.int32)
    assert own.decode(ids, np.array([0, 3])).to_pylist() == ["�"]


def test_query_against_the_library(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet")
            .collect()}
    got = QUERIES["op2_sentencepiece"](spark, SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id], add_bos=True, add_eos=True)
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(packed).hexdigest(),
            hashlib.sha256(library.decode(ids).encode()).hexdigest())


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (None, "a b", None)],
                                 "doc_id long, text string, ids string")
    got = pieces.sentencepiece_encode(docs.withColumn("doc", docs.doc_id), MODEL).collect()
    assert [len(r.ids) for r in got].count(8) == 2 and len(got) == 3
    assert sorted(r.decoded for r in got) == ["", "", "a b"]
    assert pieces.sentencepiece_encode(docs.where("false"), MODEL).collect() == []


def test_very_long_texts(spark, library):
    texts = ["The quick brown fox  jumps. " * 20_000, "x" * 200_000, "日本" * 50_000]
    docs = spark.createDataFrame(enumerate(texts), "doc_id long, text string")
    for r in pieces.sentencepiece_encode(docs, MODEL).collect():
        want = library.encode(r.doc.text, add_bos=True, add_eos=True)
        assert bytes(r.ids) == b"".join(i.to_bytes(4, "little") for i in want)
        assert r.decoded == library.decode(want)
