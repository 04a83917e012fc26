"""Importance resampling towards a target distribution.

Documents and target texts become counts of hashed word runs. The gain of a bucket is the logarithm
of how much more often the target has it, a document weighs the sum of its gains, and seeded Gumbel
noise on the weights draws without replacement: the highest scores are the sample.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import LOWER_BYTES, materialize, query, table, unsigned_part
from millrace.llm.pieces import portions
from millrace.operators.ordered import number_rows

BUCKETS = 10_000
RUN = 3             # words of the longest feature
STRETCH = 1 << 16   # characters that are cut into words in one call, up to the next separator
SHORT = 32          # bytes of words that are hashed side by side; longer ones go one by one
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
FEATURES = "n_words long, n_features long, buckets binary"
_GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


@lru_cache(maxsize=1)
def splitter():
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    return Split(Regex(WORDS), behavior="removed", invert=True)


@lru_cache(maxsize=1)
def byte_table() -> np.ndarray:
    """What the CRC of reflected polynomial 0xEDB88320 makes of each byte."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, crc >> 1 ^ np.uint32(0xEDB88320), crc >> 1)
    return crc


@lru_cache(maxsize=64)
def shift_table(power: int) -> np.ndarray:
    """(4, 256): where 2**power zero bytes take each byte of a CRC. Shifting is linear, so the four
    bytes are moved apart and put together again."""
    if power:
        half = shift_table(power - 1)
        return _moved(half, half)
    place = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    return byte_table()[place & 255] ^ place >> 8


def _moved(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    return by[0][crc & 255] ^ by[1][crc >> 8 & 255] ^ by[2][crc >> 16 & 255] ^ by[3][crc >> 24]


def shifted(crc: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRCs followed by `sizes` zero bytes each: crc(ab) = shifted(crc(a), len(b)) ^ crc(b)."""
    out = crc.copy()
    for power in range(int(sizes.max(initial=0)).bit_length()):
        here = np.flatnonzero(sizes >> power & 1)
        out[here] = _moved(out[here], shift_table(power))
    return out


def word_offsets(text: str) -> np.ndarray:
    """Start and end of every word, in characters, as rows of pairs."""
    found, at = [], 0
    while at < len(text):
        gap = _GAP.search(text, at + STRETCH)
        end = gap.start() if gap else len(text)
        pairs = splitter().pre_tokenize_str(text[at:end])
        found.append(at + np.fromiter(chain.from_iterable(p for _, p in pairs), np.int64,
                                      2 * len(pairs)))
        at = end
    return np.concatenate(found or [np.zeros(0, np.int64)]).reshape(-1, 2)


def word_crcs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of the stretches of `data`."""
    step, crc = byte_table(), np.full(len(starts), 0xFFFFFFFF, np.uint32)
    for i in range(min(SHORT, int(sizes.max(initial=0)))):
        here = np.flatnonzero(sizes > i)
        old = crc[here]
        crc[here] = step[(old ^ data[starts[here] + i]) & 255] ^ old >> 8
    crc ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(sizes > SHORT).tolist():
        crc[i] = zlib.crc32(data[starts[i]:starts[i] + sizes[i]])
    return crc


def feature_buckets(texts: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words per text, features per text, bucket of every feature, text after text)."""
    pairs, data, counts, base = [], [], [], 0
    for raw in texts:
        lowered = raw.translate(LOWER_BYTES)
        text = lowered.decode()
        own = word_offsets(text)
        if len(text) < len(lowered):  # offsets in characters to offsets in bytes
            units = np.frombuffer(lowered, np.uint8)
            own = np.append(np.flatnonzero(units & 0xC0 != 0x80), len(units))[own]
        pairs.append(own + base)
        counts.append(len(own))
        data.append(lowered)
        base += len(lowered)
    n_words = np.array(counts, np.int64)
    spans = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)
    joined = np.frombuffer(b"".join(data), np.uint8)
    sizes = spans[:, 1] - spans[:, 0]
    crcs = word_crcs(joined, spans[:, 0], sizes)
    owner = np.repeat(np.arange(len(texts)), n_words)
    blank = np.uint32(zlib.crc32(b" "))
    found, owners, run = [crcs], [owner], crcs
    for length in range(2, RUN + 1):
        # Windows of offset pairs: run i goes on with the word `length` - 1 places later.
        run = shifted(_moved(run[:-1], shift_table(0)) ^ blank, sizes[length - 1:]) \
            ^ crcs[length - 1:] if len(run) else run
        within = owner[length - 1:] == owner[:len(run)]
        found.append(run[within])
        owners.append(owner[:len(run)][within])
    order = np.argsort(np.concatenate(owners), kind="stable")
    n_features = sum(np.bincount(o, minlength=len(texts)) for o in owners)
    return n_words, n_features, (np.concatenate(found) % np.uint32(buckets))[order]


def features(text: str, buckets: int = BUCKETS) -> Column:
    """Struct column FEATURES of a text: `buckets` packs one unsigned 16-bit number per feature.
    Null is the text without words."""
    def found(texts: pa.Array) -> pa.Array:
        done = []
        for part in portions(pc.fill_null(texts, "")):
            n_words, n_features, hashed = feature_buckets(part.cast(pa.binary()).to_pylist(), buckets)
            ends = np.concatenate(([0], np.cumsum(2 * n_features)))
            packed = pa.Array.from_buffers(pa.binary(), len(part), [
                None, pa.py_buffer(ends.astype(np.int32).tobytes()),
                pa.py_buffer(hashed.astype("<u2").tobytes())])
            done.append((pa.array(n_words), pa.array(n_features.astype(np.int64)), packed))
        columns = [pa.concat_arrays(c) for c in zip(*done)] or [
            pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.binary())]
        return pa.StructArray.from_arrays(columns, ["n_words", "n_features", "buckets"])

    return F.arrow_udf(found, FEATURES)(F.col(text).cast("string"))


def bucket_counts(found: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n) over the `buckets` of all rows; a task hands on one row per bucket at most."""
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(packed, "<u2"), minlength=buckets)
        here = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(total[here])], ["bucket", "n"])

    return found.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """(bucket, gain) for every bucket, from the counts of both sides, each with one added."""
    both = raw.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    for side, name in ((raw, "s"), (target, "t")):
        both = both.join(side.withColumnRenamed("n", name), "bucket", "left").fillna(0, [name])
    sums = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    s, t, all_s, all_t = (F.col(c).cast("double") for c in ("s", "t", "all_s", "all_t"))
    share = (t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets))
    return both.crossJoin(F.broadcast(sums)).select(
        "bucket", F.floor(1000 * F.log(share)).alias("gain"))


def summed(packed: str, values: np.ndarray) -> Column:
    """Sum of the values of the buckets in a packed column."""
    def add(rows: pa.Array) -> pa.Array:
        ends = np.frombuffer(rows.buffers()[1], np.int32)[rows.offset:rows.offset + len(rows) + 1]
        own = np.frombuffer(rows.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]].view("<u2")
        running = np.concatenate(([0], np.cumsum(values[own])))
        return pa.array(np.diff(running[(ends - ends[0]) // 2]))

    return F.arrow_udf(add, "long")(F.col(packed))


def importance_resample(docs: DataFrame, target: DataFrame, *, keep: list[str] | None = None,
                        text: str = "text", percent: int = 5, min_words: int = 20,
                        buckets: int = BUCKETS, seed: int = 42, doc_id: str = "doc_id") -> DataFrame:
    """Draw `percent` of the documents of `min_words` words or more towards the texts of `target`.

    Struct `doc` (the columns `keep`, the id alone if not given), `n_words`, `n_features`, `weight`,
    `score` and `rank` (from 1, null if not drawn) for every document. A null text has no words and
    weighs 0. Noise hangs on seed and id; a null id counts as an empty one in it and comes last among
    equal scores. Repeated rows have equal scores and are drawn each by itself, in no defined order
    among them. An empty target takes from every bucket in proportion to its count; no rows give no
    rows. Kept columns stay inside `doc`, so their names cannot clash. Very long texts are cut into
    words in stretches; a task holds the hashes of one portion of a batch.

    The buckets of all features are written (two bytes each), so texts are cut into words once.
    `buckets` counts, at most 65,536, are all that comes to the driver.
    """
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets must be at most 65536")
    keep = keep or [doc_id]
    found = materialize(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"),
        F.col(doc_id).cast("string").alias("_id"), features(text, buckets).alias("f")
    ).select("doc", "_id", "f.*"), "features")
    wanted = target.select(features(text, buckets).alias("f")).select("f.*")
    known = gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets), buckets)
    values = np.zeros(buckets, np.int64)
    for row in known.collect():
        values[row["bucket"]] = row["gain"]

    named = F.concat(F.lit(f"{seed}:"), F.coalesce("_id", F.lit("")))
    chance = (unsigned_part(F.sha2(named, 256), 1, 8).cast("double") + 0.5) / F.lit(2.0 ** 32)
    scored = materialize(found.select(
        "doc", "_id", "n_words", "n_features", summed("buckets", values).alias("weight")
    ).withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(chance)))), "scored")
    fits = F.col("n_words") >= min_words
    drawn = percent * scored.where(fits).count() // 100
    order = {"_late": ~fits, "_low": -F.col("score"), "_null": F.col(f"doc.`{doc_id}`").isNull(),
             "_key": F.col(f"doc.`{doc_id}`")} if doc_id in keep else {
        "_late": ~fits, "_low": -F.col("score"), "_key": F.col("_id")}
    return number_rows(scored.withColumns(order), [], list(order), "_place").select(
        "doc", "n_words", "n_features", "weight", "score",
        F.when(F.col("_place") <= drawn, F.col("_place").cast("long")).alias("rank"))


SQL = r"""
WITH tab AS (
  SELECT list(v ORDER BY i) AS tb FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i))),
words AS (
  SELECT row_number() OVER () AS r, doc_id, side, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT doc_id, text, 's' AS side FROM documents
        UNION ALL SELECT NULL, text, 't' FROM benchmark)),
runs AS (
  SELECT r, side, f, count(*) AS n FROM (
    SELECT r, side, array_to_string(w[i:i + k - 1], ' ') AS f FROM (
      SELECT r, side, w, k, unnest(range(1, len(w) - k + 2)) AS i
      FROM words, (SELECT unnest([1, 2, 3]) AS k))) GROUP BY r, side, f),
hashed AS (
  SELECT f, xor(list_reduce(
      list_concat([4294967295], list_transform(range(1, octet_length(encode(f)) + 1),
        lambda i: ('0x' || substr(hex(encode(f)), 2 * i - 1, 2))::BIGINT)),
      lambda c, b: xor(tb[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 AS b
  FROM (SELECT DISTINCT f FROM runs), tab),
placed AS (SELECT r, side, b, sum(n)::BIGINT AS n FROM runs JOIN hashed USING (f) GROUP BY r, side, b),
counts AS (
  SELECT b, coalesce(s, 0) AS s, coalesce(t, 0) AS t FROM (SELECT unnest(range(10000)) AS b)
  LEFT JOIN (SELECT b, sum(n) FILTER (side = 's') AS s, sum(n) FILTER (side = 't') AS t
             FROM placed GROUP BY b) USING (b)),
gain AS (
  SELECT b, CAST(floor(1000 * ln((t::DOUBLE + 1) * ((SELECT sum(s)::DOUBLE FROM counts) + 10000)
    / ((s::DOUBLE + 1) * ((SELECT sum(t)::DOUBLE FROM counts) + 10000)))) AS BIGINT) AS g FROM counts),
weights AS (
  SELECT r, sum(n)::BIGINT AS n, sum(n * g)::BIGINT AS w FROM placed JOIN gain USING (b) GROUP BY r),
scored AS (
  SELECT r, doc_id, len(words.w) >= 20 AS fits, coalesce(weights.n, 0) AS n_features,
    coalesce(weights.w, 0) AS weight,
    coalesce(weights.w, 0) + CAST(floor(-1000 * ln(-ln((
      ('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM words LEFT JOIN weights USING (r) WHERE side = 's'),
placed_rows AS (
  SELECT *, row_number() OVER (ORDER BY fits DESC, score DESC, doc_id NULLS LAST) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= 5 * (SELECT count(*) FROM scored WHERE fits) // 100 THEN place END AS rank
FROM placed_rows
"""


@query("op12_importance_resampling", SQL)
def op12(spark, sf_dir):
    drawn = importance_resample(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                table(spark, sf_dir, "benchmark").select("text"))
    return drawn.select("doc.doc_id", "n_features", "weight", "score", "rank")
