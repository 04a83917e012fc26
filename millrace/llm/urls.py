"""URL filters with a cascade of Bloom filters.

The first filter holds the listed keys. Keys of the corpus that pass it without being listed go into
the second, listed keys that pass the second go into the third, and so on until nothing passes
wrongly. Over the keys of the corpus the cascade answers exactly, with about as many bits as the list
needs at the rate of listed to unlisted keys, and a lookup is an expression: no join, no shuffle of
the documents.

All levels are built by aggregation: positions are hashed and bits are or-ed per 64-bit word. The
words of one level, bounded in number, become a binary constant of the lookup expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ascii_lower, materialize, query, table

MAX_BITS = 1 << 26      # bits of one cascade, about; a longer list is cut into slices of the keys
DEEP_RATE = 1 / 16      # false positives of the levels after the first
MAX_LEVELS = 64

# Rules as (verdict, host, path) and listed domains.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
LISTED_NAMES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
LISTED_ENDINGS = ["example.com", "example.net", "example.org"]


@dataclass
class Level:
    data: bytes  # bit p is bit p % 8 of byte p // 8
    hashes: int
    salt: int

    def holds(self, key: Column) -> Column:
        """Whether all bits of the key are set."""
        found = F.lit(True)
        for i in range(self.hashes):
            at = position(key, self.salt, i, 8 * len(self.data))
            byte = F.substring(F.lit(self.data), (F.shiftright(at, 3) + 1).cast("int"), 1)
            number = F.conv(F.hex(byte), 16, 10).cast("int")
            found = found & (F.call_function("shiftright", number, (at % 8).cast("int"))
                             .bitwiseAND(1) == 1)
        return found


def position(key: Column, salt: int, turn: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(salt), F.lit(turn)), F.lit(bits).cast("long"))


def build_level(keys: DataFrame, n: int, rate: float, salt: int) -> Level:
    """One filter: positions are hashed and or-ed per word; the words, whose number the caller has
    bounded, come to the driver and go out with the plan."""
    hashes = max(1, round(math.log2(1 / rate)))
    words = max(1, math.ceil(n * math.log2(1 / rate) / math.log(2) / 64))
    at = [position(F.col("key"), salt, i, 64 * words) for i in range(hashes)]
    set_bits = keys.select(F.explode(F.array(*at)).alias("at")).select(
        F.shiftright("at", 6).cast("int").alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))
        .alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    data = bytearray(8 * words)
    for row in set_bits.collect():
        data[8 * row["word"]:8 * row["word"] + 8] = row["bits"].to_bytes(8, "little", signed=True)
    return Level(bytes(data), hashes, salt)


def build_cascade(universe: DataFrame, salt: int = 0) -> list[Level]:
    """Levels over `universe` (key, listed), one row per key."""
    parts = {r["listed"]: r["n"] for r in
             universe.groupBy("listed").agg(F.count(F.lit(1)).alias("n")).collect()}
    inside, n = universe.where("listed").select("key"), parts.get(True, 0)
    outside, others = universe.where("not listed").select("key"), parts.get(False, 0)
    if not n:
        return []
    levels, rate = [], min(0.5, max(n, 1) * math.sqrt(0.5) / max(others, 1))
    while n:
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascade does not end: keys share all hashes")
        level = build_level(inside, n, rate, salt + len(levels))
        levels.append(level)
        passed = materialize(outside.where(level.holds(F.col("key"))), "passed")
        inside, outside, n, rate = passed, inside, passed.count(), DEEP_RATE
    return levels


def in_cascade(levels: list[Level], key: Column) -> Column:
    """Exact for the keys of the universe: the first filter that rejects a key decides."""
    answer = F.lit(len(levels) % 2 == 1)
    for i in range(len(levels) - 1, -1, -1):
        answer = F.when(~levels[i].holds(key), F.lit(i % 2 == 1)).otherwise(answer)
    return answer


def flag_listed(df: DataFrame, keys: str, listed: DataFrame, flag: str = "listed",
                max_bits: int = MAX_BITS) -> DataFrame:
    """`df` with `flag`: whether any of its `keys` (array of strings) is in `listed` (key).

    The universe is every distinct key of `df` and of the list. If the list would need more than
    `max_bits`, keys are cut into slices by hash; each slice has a cascade of its own and the rows
    pass them one after the other, so that one filter at a time is in memory.
    """
    seen = df.select(F.explode(keys).alias("key"), F.lit(False).alias("listed"))
    named = listed.select(F.col("key").cast("string").alias("key"), F.lit(True).alias("listed"))
    universe = materialize(seen.unionByName(named).where("key is not null").groupBy("key").agg(
        F.bool_or("listed").alias("listed")), "keys")
    totals = universe.agg(F.count(F.lit(1)).alias("all"), F.count_if("listed").alias("n")).first()
    size = totals["n"] * (math.log2(1 + totals["all"] / max(totals["n"], 1)) + 4) * 1.5
    slices = max(1, math.ceil(size / max_bits))
    out = df.withColumn(flag, F.lit(False))
    for s in range(slices):
        def mine(key: Column, s: int = s) -> Column:
            return F.pmod(F.xxhash64(key, F.lit("slice")), F.lit(slices)) == s

        levels = build_cascade(universe.where(mine(F.col("key"))), salt=1000 * s)
        if levels:
            hit = F.exists(keys, lambda k: mine(k) & in_cascade(levels, k))
            out = out.withColumn(flag, F.col(flag) | F.coalesce(hit, F.lit(False)))
            if s + 1 < slices:
                out = materialize(out, "flagged")
    return out


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for text without `://`."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def url_keys(host: Column, path: Column) -> Column:
    """What a list may name: the host, each domain above it, and the host with its path."""
    labels = F.split(host, r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)),
                        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.array_distinct(F.filter(F.concat(above, F.array(F.concat(host, path))),
                                     lambda k: k != ""))


def first_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as (rule, verdict); null if none fits."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, of, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(of + start).alias("rule"),
                                      F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]],
                url: str = "url", max_bits: int = MAX_BITS) -> DataFrame:
    """Judge urls: struct `row` (the input row), `host`, `path`, `rule`, `listed`, `verdict`.

    The longest fitting rule decides; without one, a url is blocked if its host, a domain above it
    or its host with path is in `listed` (key). Null urls and text without `://` have neither host
    nor path, fit nothing and are allowed. Null keys of the list are left out, repeated ones count
    once; an empty list blocks nothing. Repeated rows are judged each, no rows give no rows, and
    input columns stay inside `row`, so their names cannot clash. A very long url is a key like any
    other, hashed as a whole.
    """
    host, path = url_parts(F.col(url))
    parted = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"),
                          host.alias("host"), path.alias("path"))
    keyed = parted.withColumn("keys", url_keys(F.col("host"), F.col("path")))
    flagged = flag_listed(keyed, "keys", listed, max_bits=max_bits)
    decided = flagged.withColumn("by", first_rule(F.col("host"), F.col("path"), rules))
    return decided.select(
        "row", "host", "path", F.col("by.rule").alias("rule"), "listed",
        F.coalesce("by.verdict", F.when(F.col("listed"), "block").otherwise("allow")
                   ).alias("verdict"))


def listed_domains(spark) -> DataFrame:
    names = [f"{n}.{e}" for n in LISTED_NAMES for e in LISTED_ENDINGS]
    return spark.range(1).select(F.explode(F.array(*map(F.lit, names))).alias("key"))


SQL = """
WITH parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3)
    ELSE '' END AS rest FROM pages)),
ruled AS (
  SELECT *, CASE
    WHEN regexp_matches(host, '(^|[.])example[.]org$') AND starts_with(path, '/en/1')
      THEN 'example.org/en/1'
    WHEN regexp_matches(host, '(^|[.])example[.]org$') AND starts_with(path, '/es/')
      THEN 'example.org/es/'
    WHEN regexp_matches(host, '(^|[.])com$') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN regexp_matches(host, '(^|[.])com$') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN regexp_matches(host, '(^|[.])org$') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host, '(^|[.])(%s)[.]example[.](com|net|org)$') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
""" % "|".join(LISTED_NAMES)


@query("op3_url_filter", SQL)
def op3(spark, sf_dir):
    judged = filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"),
                         listed_domains(spark), RULES)
    return judged.select("row.page_id", "host", "path", "rule", "verdict")
