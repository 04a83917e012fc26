"""URL filters: SQL twin, exact membership, rules by hand."""

import pytest
from conftest import SMALL
from oracle import compare, connect
from pyspark.sql import functions as F

from millrace.llm import urls
from millrace.llm.queries import ORACLES, QUERIES


def test_matches_sql(spark):
    name = "op3_url_filter"
    assert compare(spark, connect(SMALL), SMALL, QUERIES[name], ORACLES[name])[0] == "exact"


@pytest.mark.parametrize("share", [0, 1, 30, 97])
def test_exact_over_the_universe(spark, share):
    keys = spark.range(6000).select(F.concat(F.lit("k"), F.col("id")).alias("key"),
                                    (F.col("id") % 100 < share).alias("listed"))
    levels = urls.build_cascade(keys)
    got = keys.withColumn("found", urls.in_cascade(levels, F.col("key")))
    assert got.where("found <> listed").count() == 0
    assert (len(levels) > 1) == (share > 0) and len(levels) < 12


def test_slices_are_exact(spark):
    rows = spark.range(3000).select(F.array(F.concat(F.lit("k"), F.col("id")),
                                            F.concat(F.lit("k"), F.col("id") + 1)).alias("keys"), "id")
    listed = spark.range(0, 3000, 7).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    got = urls.flag_listed(rows, "keys", listed, max_bits=900)
    assert got.where("listed <> (id % 7 = 0 or (id + 1) % 7 = 0 and id < 2999)").count() == 0


def judge(spark, rows, listed=("bad.net", "x.net/p", None, "bad.net")):
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, keys int")
    names = spark.createDataFrame([(n,) for n in listed], "key string")
    return {r.row.page_id: (r.host, r.path, r.rule, r.verdict)
            for r in urls.filter_urls(pages, names, urls.RULES).collect()}


def test_by_hand(spark):
    said = [None, "", "no scheme.net/", "http://", "http://BAD.net", "http://a.bad.NET/É?q",
            "http://notbad.net/", "https://x.net/p#f", "https://x.net/p/q", "http://org/",
            "http://example.org/es/1", "http://a.example.org/en/12", "http://anexample.org/es/",
            "http://b.com/fr/", "http://b.com/de/x", "http://b.com/fr", "http://example.org",
            "a://b://c/d", "http://bad.net:80/", "http://.bad.net/", "http://" + "a." * 30 + "net/"]
    got = judge(spark, [(i, u, "h", 1) for i, u in enumerate(said)])
    assert [got[i][3] for i in range(len(said))] == [
        "allow", "allow", "allow", "allow", "block", "block", "allow", "block", "allow", "allow",
        "block", "block", "allow", "allow", "block", "allow", "allow", "allow", "allow", "block",
        "allow"]
    assert got[0] == ("", "", None, "allow") and got[5][:2] == ("a.bad.net", "/É")
    assert [got[i][2] for i in (9, 10, 11, 12, 13, 14, 15, 16)] == [
        "org/", "example.org/es/", "example.org/en/1", "org/", "com/fr/", "com/de/", None, None]


def test_empty_tables(spark):
    assert judge(spark, []) == {}
    assert judge(spark, [(1, "http://bad.net/", None, None)], ())[1][3] == "allow"


def test_repeated_and_very_long_urls(spark):
    path = "p" * 200_000
    rows = [(1, "http://bad.net/a", "h", 1)] * 3 + [(2, f"http://x.net/{path}", "h", 1),
                                                    (3, f"http://{'a' * 100_000}.bad.net/", "h", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, keys int")
    names = spark.createDataFrame([("bad.net",), (f"x.net/{path}",)], "key string")
    got = urls.filter_urls(pages, names, urls.RULES).collect()
    assert sorted((r.row.page_id, r.verdict) for r in got) == [
        (1, "block"), (1, "block"), (1, "block"), (2, "block"), (3, "block")]
