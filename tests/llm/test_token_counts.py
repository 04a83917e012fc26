"""Edited token counts against encoding the edited text in full."""

import random

import public_tokenizers
import pytest
from conftest import SMALL

from millrace.llm import token_counts
from millrace.llm.queries import QUERIES

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def own():
    return token_counts.counter(open(RANKS, "rb").read(), public_tokenizers.PATTERN)


def full(own, text):
    return len(own.encoding.encode_ordinary(text))


@pytest.mark.parametrize("alphabet", ["ab '", "it's we'll  \n\t", "aé日 1.,'rev", "   \n", "a"])
def test_random_edits(own, alphabet):
    chance = random.Random(len(alphabet))
    for _ in range(300):
        text = "".join(chance.choice(alphabet) for _ in range(chance.randint(0, 700)))
        edits = []
        for _ in range(chance.randint(0, 6)):
            start = chance.randint(0, len(text) + 2)
            edits.append({"start": start, "stop": start + chance.choice([0, 0, 1, 2, 30, 400]),
                          "text": "".join(chance.choice(alphabet) for _ in
                                          range(chance.choice([0, 1, 2, 40])))})
        chars, tokens = token_counts.leaves(own, text)
        assert tokens.sum() == full(own, text) and chars.sum() == len(text)
        done, chars, tokens, total, again = token_counts.apply_edits(own, text, chars, tokens, edits)
        want, end = "", len(text)
        for start, stop, new in reversed(token_counts.clean_edits(edits, len(text))):
            want, end = new + text[stop:end] + want, start
        assert done == text[:end] + want
        assert total == tokens.sum() == full(own, done) and chars.sum() == len(done)
        # the tree that comes out can be edited again
        more = [{"start": len(done) // 2, "stop": len(done) // 2, "text": "x "}]
        last, chars, tokens, total, _ = token_counts.apply_edits(own, done, chars, tokens, more)
        assert total == full(own, last)


def test_a_small_edit_encodes_little_again(own):
    text = "some words here, and there " * 4000
    chars, tokens = token_counts.leaves(own, text)
    at = len(text) // 2
    edits = [{"start": at, "stop": at + 3, "text": "other"}]
    _, _, _, total, again = token_counts.apply_edits(own, text, chars, tokens, edits)
    assert 0 < again <= 3 * token_counts.LEAF
    assert total == full(own, text[:at] + "other" + text[at + 3:])


def test_query_against_full_encoding(spark, own):
    import re

    found = re.compile("|".join(f"({p})" for p, _ in token_counts.MASKS))
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet")
            .collect()}
    got = QUERIES["op7_token_counts"](spark, SMALL).collect()
    assert len(got) == len(docs) and any(r.n_edits for r in got)
    for r in got:
        masked, n = found.subn(lambda m: token_counts.MASKS[m.lastindex - 1][1], docs[r.doc_id])
        assert (r.n_tokens, r.n_edits, r.n_tokens_edited) == (
            full(own, docs[r.doc_id]), n, full(own, masked))


def test_odd_rows(spark):
    one = [{"start": 0, "stop": 1, "text": "zz"}]
    rows = [(1, None, one), (2, "", [{"start": 0, "stop": 0, "text": "new"}]), (3, "a b", None),
            (3, "a b", None), (None, "a b c", [{"start": 0, "stop": 2, "text": None}, None]),
            (4, "word " * 50000, one), (5, "ab", [{"start": 1, "stop": 9, "text": "x"}])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, edits "
                                 "array<struct<start:int,stop:int,text:string>>")
    docs = docs.withColumn("before", docs.doc_id).withColumn("after", docs.doc_id)
    got = {r.doc.doc_id: r.after for r in
           token_counts.count_edited(docs, RANKS, public_tokenizers.PATTERN).collect()}
    assert (got[1].text, got[1].n_tokens) == ("", 0)
    assert got[2].text == "new" and got[2].n_tokens == 1
    assert got[None].text == "b c" and got[5].text == "ab" and got[4].text.startswith("zzord ")
    assert token_counts.count_edited(docs.where("false"), RANKS,
                                     public_tokenizers.PATTERN).collect() == []
