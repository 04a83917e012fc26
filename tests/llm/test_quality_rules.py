"""Quality rules: SQL twin, hand-worked measures, host verdicts."""

from conftest import SMALL
from oracle import compare, connect

from millrace.llm.queries import ORACLES, QUERIES
from millrace.llm.quality_rules import measure_text, quality_rules, repeated_words

NAME = "op10_quality_rules"
CLEAN = " ".join(f"word{i} and then" for i in range(40))


def test_matches_sql(spark):
    assert compare(spark, connect(SMALL), SMALL, QUERIES[NAME], ORACLES[NAME])[0] == "exact"


def test_measures_by_hand():
    assert repeated_words("a b c d a b c".encode().split()) == 6
    assert repeated_words("a a a a".encode().split()) == 4
    assert repeated_words(b"".split()) == 0
    text = "é b#\nx\n \nx\n\nx"
    assert measure_text(text.encode(), len(text)) == (5, 6, 1, 4, 2, 0)


def judged(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, kept string")
    return {r.doc.doc_id: r for r in quality_rules(docs, **options).collect()}


def test_host_verdict_only_hits_failing_documents(spark):
    odd = CLEAN.replace("and", "a#nd")  # fails the symbol rule alone
    rows = [(i, odd, "bad", "x") for i in range(40)] + [(40, CLEAN, "bad", "x")]
    rows += [(100 + i, CLEAN, "good", "x") for i in range(40)] + [(140, odd, "good", "x")]
    got = judged(spark, rows)
    assert not got[0].kept and got[0].host_bad and got[0].failed == ["symbols"]
    assert got[40].kept and got[100].kept
    assert got[140].kept and not got[140].host_bad
    # shrunk: neither host reaches its raw rate
    assert 0 < got[140].host_rate and got[0].host_rate < 40 / 41 + 1e-9


def test_one_failure_in_a_tiny_host_is_not_a_bad_host(spark):
    odd = CLEAN.replace("and", "a#nd")
    rows = [(i, CLEAN, f"h{i % 7}", None) for i in range(70)] + [(99, odd, "tiny", None)]
    assert judged(spark, rows)[99].kept


def test_more_symbols_than_words_are_rejected_anywhere(spark):
    noise = CLEAN.replace("and", "a##nd##")
    got = judged(spark, [(i, CLEAN, "good", None) for i in range(30)] + [(30, noise, "good", None)])
    assert not got[30].kept and got[30].failed == ["symbols", "noise"] and not got[30].host_bad


def test_odd_rows(spark):
    rows = [(1, None, None, None), (2, "", "a", None), (None, CLEAN, None, "y"),
            (3, CLEAN, "a", "z"), (3, CLEAN, "a", "z"), (4, "word " * 200000, "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, kept string")
    got = quality_rules(docs.withColumn("host", docs.source).withColumn("m", docs.doc_id))
    found = got.collect()
    assert len(found) == 6
    assert [r.kept for r in found if r.doc.text == CLEAN] == [True] * 3
    assert not any(r.kept for r in found if r.doc.text != CLEAN)
    assert {r.doc.kept for r in found if r.kept} == {"y", "z"}
    assert quality_rules(docs.where("false")).collect() == []
