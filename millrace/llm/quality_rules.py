"""Quality rules with host verdicts.

Every document is measured against a few rules. The rates at which the documents of a host fail are
shrunk towards an empirical beta prior, so that a host of three documents is not judged by them
alone, and the verdict on the host goes back to its documents: what a good host is forgiven (one
failed rule) a bad host is not.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialize, query, table

PRIOR_DOCS = 10.0  # the prior weighs as much as so many documents at least
SYMBOLS = b"#*$%&|<>"
MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, " \
           "n_repeat_words long"


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a three-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts, covered, end = Counter(windows), 0, 0
    for start, window in enumerate(windows):
        if counts[window] > 1:
            covered += start + 3 - max(start, end)
            end = start + 3
    return covered


def measure_text(text: bytes, n_chars: int) -> tuple[int, ...]:
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (len(words), n_chars - len(text) + sum(map(len, words)),
            len(text) - len(text.translate(None, SYMBOLS)), len(lines),
            len(lines) - len(set(lines)), repeated_words(words))


def _measures(texts: pa.Array) -> pa.Array:
    texts = pc.fill_null(texts, "")
    chars = pc.utf8_length(texts).to_pylist()
    rows = [measure_text(t, n) for t, n in
            zip(texts.cast(pa.large_binary()).to_pylist(), chars)]
    columns = list(zip(*rows)) or [()] * 6
    names = [part.split()[0] for part in MEASURES.split(", ")]
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def measures(text: str):
    """Struct column of the measures of a text; null is the empty text."""
    def measure_texts(texts: pa.Array) -> pa.Array:
        return _measures(texts)

    return F.arrow_udf(measure_texts, MEASURES)(F.col(text).cast("string"))


def failures() -> dict[str, F.Column]:
    """The rules over the struct `m` of measures; true where a document fails."""
    m = {name: F.col(f"m.{name}") for name in (part.split()[0] for part in MEASURES.split(", "))}
    return {
        "short": m["n_words"] < 50,
        "repeating": 100 * m["n_repeat_words"] > 50 * m["n_words"],
        "symbols": 10 * m["n_symbols"] > m["n_words"],
        "noise": m["n_symbols"] > m["n_words"],
        "lines": 10 * m["n_dup_lines"] > 3 * m["n_lines"],
        "word_length": (m["word_chars"] < 3 * m["n_words"])
                       | (m["word_chars"] > 12 * m["n_words"]),
    }


def host_rates(measured: DataFrame, limit: float) -> DataFrame:
    """One row per host: documents, failing documents, shrunk rate, verdict.

    The beta prior comes from the hosts themselves by moments: its mean is the rate over all
    documents, its strength what the spread of the rates leaves after the spread that chance gives,
    but `PRIOR_DOCS` documents at least, so that few and very different hosts are still shrunk.
    """
    hosts = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("docs"),
        F.count(F.when(F.col("n_failed") > 0, 1)).alias("failing"))
    d, f = F.col("docs").cast("double"), F.col("failing").cast("double")
    total = hosts.agg(F.sum("docs").cast("double").alias("n"), F.sum("failing").alias("k"),
                      F.sum(f * f / d).alias("squares"), F.count(F.lit(1)).alias("hosts"))
    mean = F.col("k") / F.col("n")
    chance = mean * (1 - mean)
    spread = F.col("squares") / F.col("n") - mean * mean - chance * F.col("hosts") / F.col("n")
    strength = F.when(spread > chance / 1e6, F.greatest(chance / spread - 1, F.lit(PRIOR_DOCS))
                      ).otherwise(F.lit(1e6))
    prior = total.select(mean.alias("mean"), strength.alias("strength"))
    # One row, so the join is with a single pair of numbers.
    rate = (f + F.col("mean") * F.col("strength")) / (d + F.col("strength"))
    return hosts.crossJoin(F.broadcast(prior)).select(
        "host", "docs", "failing", rate.alias("host_rate"), (rate > limit).alias("host_bad"))


def quality_rules(docs: DataFrame, text: str = "text", host: str = "source",
                  host_limit: float = 0.5) -> DataFrame:
    """Judge documents: struct `doc` (the input row) with `m` (measures), `failed` (names of failed
    rules), `base_failed`, `host_rate`, `host_bad` and `kept`.

    A document is rejected if it is short or repeats itself, if it fails two rules of the six (more
    symbols than words fail two at once), or if it fails one and its host is bad. A document that fails no rule is always kept.

    A null text is an empty one and fails. Documents with a null host form one host. Repeated rows
    are judged alike. No rows give no rows. Input columns stay inside `doc`, so their names cannot
    clash with those of the result. The measures of long texts take memory in proportion to one
    Arrow batch. A host may hold any share of the rows: rates are pre-aggregated, verdicts join
    back from one row per host.
    """
    rules = failures()
    measured = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                           F.col(host).cast("string").alias("host"), measures(text).alias("m"))
    judged = measured.select(
        "doc", "host", "m",
        F.filter(F.array(*[F.when(r, F.lit(n)) for n, r in rules.items()]),
                 F.isnotnull).alias("failed"),
        (rules["short"] | rules["repeating"]).alias("base_failed"),
    ).withColumn("n_failed", F.size("failed"))
    # Two passes over the texts: measuring again costs less than a written copy of all documents.
    # The verdicts are written, so that their size is known when the join is planned.
    hosts = materialize(host_rates(judged, host_limit).select(
        F.col("host").alias("of"), "host_rate", "host_bad"), "hosts")
    return judged.join(hosts, F.col("host").eqNullSafe(F.col("of"))).select(
        "doc", "m", "failed", "base_failed", "host_rate", "host_bad",
        (~F.col("base_failed") & (F.col("n_failed") < F.when(F.col("host_bad"), 1).otherwise(2))
         ).alias("kept"))


SQL = r"""
WITH words AS (
  SELECT doc_id, source, rowid AS r, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT *, row_number() OVER () AS rowid FROM documents)),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n
  FROM (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
        FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM words))),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words
  FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY r),
lines AS (
  SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM words),
m AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM words JOIN lines USING (r) LEFT JOIN covered USING (r)),
j AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
    (n_words < 50)::INT + (100 * n_repeat_words > 50 * n_words)::INT
    + (10 * n_symbols > n_words)::INT + (n_symbols > n_words)::INT + (10 * n_dup_lines > 3 * n_lines)::INT
    + (word_chars < 3 * n_words OR word_chars > 12 * n_words)::INT AS n_failed FROM m),
h AS (
  SELECT source, count(*)::DOUBLE AS d, count(*) FILTER (n_failed > 0)::DOUBLE AS f
  FROM j GROUP BY source),
p AS (
  SELECT sum(f) / sum(d) AS mean, sum(f * f / d) / sum(d) AS sq, count(*) / sum(d) AS hn FROM h),
q AS (
  SELECT mean, mean * (1 - mean) AS chance, sq - mean * mean - mean * (1 - mean) * hn AS spread
  FROM p),
s AS (
  SELECT mean, CASE WHEN spread > chance / 1e6 THEN greatest(chance / spread - 1, 10.0)
                    ELSE 1e6 END AS strength FROM q),
v AS (SELECT source, (f + mean * strength) / (d + strength) > 0.5 AS bad FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (NOT base_failed AND n_failed < CASE WHEN bad THEN 1 ELSE 2 END) AS kept
FROM j JOIN v ON j.source IS NOT DISTINCT FROM v.source
"""


@query("op10_quality_rules", SQL)
def op10(spark, sf_dir):
    judged = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return judged.select("doc.doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines",
                         "m.n_repeat_words", "base_failed", "kept")
