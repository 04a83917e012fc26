"""Phrase collocations: frequent word sequences, and how much more frequent than their parts.

Sums of bytes times growing powers of a base give the Rabin-Karp fingerprint of any stretch of text
by one subtraction, so all sequences of a length are hashed side by side. Two passes count
fingerprints: words and pairs first, then the longer sequences in which every pair is frequent. A
third pass cuts the text out where the fingerprints of frequent sequences occur, checks every
occurrence against the one its fingerprint points to, and counts by text, so a collision changes
no result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import LOWER_BYTES, materialize, query, table

LONGEST = 5            # words of the longest phrase
LEAST = 100            # occurrences of a frequent phrase
TOP = 2000             # phrases reported per language
CHUNK = 15 << 16       # bytes of text worked at a time, up to the end of a piece
HELD = 1 << 20         # distinct fingerprints a task counts before it hands them on
FILTER_BITS = 1 << 27  # most bits of the filter over frequent fingerprints
BASE = 0x9E3779B97F4A7C15
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
#: Lowers A-Z; ends of pieces become line feeds and tabs become blanks.
PLAIN = LOWER_BYTES.translate(bytes(10 if b in ENDS else 32 if b == 9 else b for b in range(256)))


@dataclass(frozen=True)
class Sizes:
    """What the tasks need to know. `bits` are kept of a fingerprint."""
    longest: int = LONGEST
    chunk: int = CHUNK
    held: int = HELD
    bits: int = 64


@lru_cache(maxsize=2)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0, 1, ... of the base and of its inverse, modulo 2**64."""
    def up(base: int) -> np.ndarray:
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    return up(BASE), up(pow(BASE, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits over all bits."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
    return x ^ x >> np.uint64(31)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all stretches (start, size), one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Text:
    """The words of a chunk, joined by single blanks, with prefix sums of their bytes.

    Word i stands at `starts[i]` to `ends[i]` and belongs to document `docs[i]`; sequences lie
    within one `piece`.
    """

    def __init__(self, parts: list[bytes], keys: np.ndarray, sizes: Sizes):
        raw = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
        inside = (raw != 32) & (raw != 10)
        step = np.diff(inside.astype(np.int8), prepend=0)
        starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        self.piece = np.searchsorted(np.flatnonzero(raw == 10), starts)
        borders = np.cumsum([len(p) + 1 for p in parts])
        self.docs = np.searchsorted(borders, starts, "right")
        inside[ends] = True  # the first separator after a word stays, as a blank
        self.data = np.where(raw == 10, 32, raw).astype(np.uint8)[inside]
        self.sizes = ends - starts
        self.starts = np.cumsum(self.sizes + 1) - (self.sizes + 1)
        self.ends = self.starts + self.sizes
        self.keys, self.keep = keys, np.uint64((1 << sizes.bits) - 1)
        up, self.down = powers(1 << max(10, int(len(self.data)).bit_length()))
        self.sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data + np.uint64(1)) * up[:len(self.data)], out=self.sums[1:])

    def sequences(self, length: int) -> np.ndarray:
        """First words of the sequences of `length` words."""
        return np.flatnonzero(self.piece[length - 1:] == self.piece[:max(0, len(self.piece) - length + 1)])

    def prints(self, first: np.ndarray, length: int) -> np.ndarray:
        """Fingerprints of sequences, different for different keys of the document."""
        at = self.starts[first]
        hashed = (self.sums[self.ends[first + length - 1]] - self.sums[at]) * self.down[at]
        return mixed(hashed ^ self.keys[self.docs[first]]) & self.keep

    def words(self) -> np.ndarray:
        """A number for every word, the same for the same text (checked byte by byte)."""
        everything = np.arange(len(self.starts))
        _, pointer, number = np.unique(self.prints(everything, 1), return_index=True,
                                       return_inverse=True)
        pointed = pointer[number]
        same = self.sizes == self.sizes[pointed]
        if same.all():
            same = self.data[ranges(self.starts, self.sizes)] == self.data[
                ranges(self.starts[pointed], self.sizes)]
        if same.all():
            return number
        known: dict[bytes, int] = {}
        data = self.data.tobytes()
        return np.fromiter((known.setdefault(data[a:b], len(known)) for a, b in
                            zip(self.starts.tolist(), self.ends.tolist())), np.int64, len(self.starts))


class Filter:
    """Two bits for each fingerprint of a set; others pass by chance only."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(64 * len(bits) - 1)

    def passes(self, prints: np.ndarray) -> np.ndarray:
        found = np.ones(len(prints), bool)
        for at in (prints & self.mask, prints >> np.uint64(32) & self.mask):
            found &= (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)) == 1
        return found


def build_filter(frequent: DataFrame, most: int = FILTER_BITS) -> Filter:
    """A filter of 16 bits a fingerprint, up to `most` bits (16 MB) that come to the driver; with
    more fingerprints than that, more sequences pass by chance and are counted in vain."""
    bits = min(max(1 << 10, 1 << (16 * frequent.count()).bit_length()), most)
    mask = F.lit(bits - 1).cast("long")
    places = F.array(F.col("print").bitwiseAND(mask),
                     F.shiftrightunsigned("print", 32).bitwiseAND(mask))
    words = frequent.select(F.explode(places).alias("at")).groupBy(
        F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.call_function(
            "shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))).alias("bits"))
    found = words.toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return Filter(out.view(np.uint64))


def texts_of(batches, sizes: Sizes) -> Iterator[tuple[Text, pa.Array]]:
    """The (lang, text) rows in chunks, with the languages of the documents of each chunk. A text
    longer than a chunk is cut at the end of a piece."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        names = langs.dictionary
        keys = np.array([int.from_bytes(hashlib.blake2b(n.encode(), digest_size=8).digest())
                         for n in names.to_pylist()], np.uint64)
        parts, codes, held = [], [], 0

        def chunk() -> tuple[Text, pa.Array]:
            own = np.array(codes)
            return Text(parts, keys[own], sizes), names.take(pa.array(own))

        for code, text in zip(langs.indices.to_pylist(), batch.column(1).to_pylist()):
            text, at = text.translate(PLAIN), 0
            while at < len(text):
                end = text.find(b"\n", at + sizes.chunk) + 1 or len(text)
                parts.append(text[at:end])
                codes.append(code)
                held, at = held + end - at, end
                if held >= sizes.chunk:
                    yield chunk()
                    parts, codes, held = [], [], 0
        if parts:
            yield chunk()


class Counts:
    """Counts of fingerprints over the chunks of a task."""

    def __init__(self):
        self.parts, self.held = [], 0

    def add(self, prints: np.ndarray) -> None:
        found = np.unique(prints, return_counts=True)
        self.parts.append(found)
        self.held += len(found[0])

    def merge(self) -> None:
        prints, counts = (np.concatenate(c) for c in zip(*self.parts))
        order = np.argsort(prints)
        prints = prints[order]
        heads = np.flatnonzero(np.diff(prints, prepend=prints[:1] ^ np.uint64(1)))
        self.parts = [(prints[heads], np.add.reduceat(counts[order], heads))] if len(prints) else []
        self.held = len(heads)

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self.merge()
        for prints, counts in self.parts:
            for a in range(0, len(prints), 100_000):
                own = prints[a:a + 100_000].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(own), pa.string()), pa.array(own), pa.array(counts[a:a + 100_000])],
                    ["lang", "print", "n"])
        self.parts, self.held = [], 0


def count_prints(docs: DataFrame, lengths: range, sizes: Sizes, least: int,
                 pairs: Filter | None = None) -> DataFrame:
    """Frequent fingerprints of the lengths (print, n), those of sequences whose pairs all pass;
    rows without a fingerprint give the number of words per language."""
    shared = docs.sparkSession.sparkContext.broadcast(pairs)

    def count(batches):
        counts, words, chosen = Counts(), {}, shared.value
        for text, langs in texts_of(batches, sizes):
            per_doc = np.bincount(text.docs, minlength=len(langs)).tolist()
            for lang, n in zip(langs.to_pylist(), per_doc):
                words[lang] = words.get(lang, 0) + n
            if chosen:
                good = np.zeros(len(text.starts), bool)
                first = text.sequences(2)
                good[first] = chosen.passes(text.prints(first, 2))
                run = good
            for length in lengths:
                if chosen:  # every pair of the sequence is frequent
                    run = run[:len(text.starts) - length + 2] & good[length - 2:] \
                        if length > lengths.start else good[:-1] & good[1:]
                    first = np.flatnonzero(run)
                else:
                    first = text.sequences(length)
                counts.add(text.prints(first, length))
            if counts.held > sizes.held:
                counts.merge()
                if counts.held > sizes.held // 2:
                    yield from counts.batches()
        yield from counts.batches()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(words), pa.string()), pa.nulls(len(words), pa.int64()),
             pa.array(list(words.values()), pa.int64())], ["lang", "print", "n"])

    counted = docs.mapInArrow(count, "lang string, print long, n long")
    return materialize(counted.groupBy("lang", "print").agg(F.sum("n").alias("n")).where(
        (F.col("n") >= least) | F.col("print").isNull()), "prints")


def count_phrases(docs: DataFrame, frequent: Filter, sizes: Sizes, least: int) -> DataFrame:
    """Frequent sequences of 1 to `longest` words by text: (lang, phrase, n)."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def count(batches):
        chosen = shared.value
        for text, langs in texts_of(batches, sizes):
            numbers = text.words()
            for length in range(1, sizes.longest + 1):
                first = text.sequences(length)
                prints = text.prints(first, length)
                passed = chosen.passes(prints)
                first, prints = first[passed], prints[passed]
                _, pointer, group = np.unique(prints, return_index=True, return_inverse=True)
                pointed = first[pointer][group]
                # An occurrence is the phrase it is taken for if it has the same words, and the
                # same language: both are in the fingerprint, and neither is taken on trust.
                same = np.ones(len(first), bool)
                for i in range(length):
                    same &= numbers[first + i] == numbers[pointed + i]
                same &= text.keys[text.docs[first]] == text.keys[text.docs[pointed]]
                tally = np.bincount(group[same], minlength=len(pointer))
                yield phrases(text, langs, first[pointer], length, tally)
                others = first[~same]
                if len(others):
                    yield phrases(text, langs, others, length, np.ones(len(others), np.int64))

    counted = docs.mapInArrow(count, "lang string, phrase string, n long")
    return materialize(counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(
        F.col("n") >= least), "phrases")


def phrases(text: Text, langs: pa.Array, first: np.ndarray, length: int,
            counts: np.ndarray) -> pa.RecordBatch:
    """Rows of sequences, their texts cut out."""
    starts, sizes = text.starts[first], text.ends[first + length - 1] - text.starts[first]
    ends = np.concatenate(([0], np.cumsum(sizes)))
    data = text.data[ranges(starts, sizes)].tobytes()
    names = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(ends.astype(np.int64)),
                                             pa.py_buffer(data))
    return pa.RecordBatch.from_arrays(
        [langs.take(pa.array(text.docs[first])), names.cast(pa.string()),
         pa.array(counts.astype(np.int64))], ["lang", "phrase", "n"])


def cut_scores(known: DataFrame, words: DataFrame) -> DataFrame:
    """Phrases of two words or more with the cut of the lowest score: lang, phrase, a, k, l, r, n,
    score. The products are exact up to counts of 10**16 and an error beyond."""
    split = known.withColumn("w", F.split("phrase", " ")).where(F.size("w") > 1)
    cuts = split.select("lang", "phrase", F.col("n").alias("a"), "w", F.explode(
        F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    parts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("w", 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        own = known.select("lang", F.col("phrase").alias(side), F.col("n").alias(name))
        parts = parts.join(own, ["lang", side]).drop(side)
    a, n, le, r = (f"cast({c} as decimal(16, 0))" for c in "anlr")
    scored = parts.join(words, "lang").withColumn("score", F.expr(
        f"(cast(1000 as decimal(4, 0)) * {a} * {n}) div ({le} * {r})"))
    least = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("cut"))
    return least.select("lang", "phrase", "cut.*")


def not_inside(found: DataFrame) -> DataFrame:
    """Without the phrases that a longer one holds and that are not more frequent than it."""
    w = F.col("w")
    longer = found.select("lang", "a", F.split("phrase", " ").alias("w")).where(F.size("w") > 2)
    held = longer.select("lang", "a", w, F.explode(F.sequence(F.lit(2), F.size(w) - 1)).alias("size"))
    held = held.select("lang", "a", w, "size", F.explode(
        F.sequence(F.lit(1), F.size(w) - F.col("size") + 1)).alias("at"))
    most = held.select("lang", "a", F.array_join(F.slice(w, F.col("at"), F.col("size")), " ").alias(
        "phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("holder"))
    return found.join(most, ["lang", "phrase"], "left").where(
        "holder is null or 100 * holder < 100 * a").drop("holder")


def mine_collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST,
                      top: int = TOP, sizes: Sizes = Sizes()) -> DataFrame:
    """The `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut into pieces at `[.,;:!?]` and line ends, and into words at
    blanks and tabs. A phrase has 2 to `longest` words of one piece and `least` occurrences or more;
    its score is floor(1000 * a * n / (l * r)) for the cut into two parts where that is lowest. A
    phrase inside a longer one that occurs as often is left out.

    Null and empty texts have no words; a null language is `und`. Repeated rows count each. No rows
    give no rows. Other columns of `docs` are not read. A very long text is worked in chunks cut at
    the ends of pieces; the memory of a task is bounded by the chunk or the longest piece. Equal
    scores are ordered by occurrences and then by the bytes of the phrase, which is unique.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    short = count_prints(rows, range(1, 3), sizes, least)
    totals = short.where("print is null").select("lang", "n")
    frequent = short.where("print is not null").select("print")
    if sizes.longest > 2:
        longer = count_prints(rows, range(3, sizes.longest + 1), sizes, least, build_filter(frequent))
        frequent = frequent.unionByName(longer.where("print is not null").select("print"))
    known = count_phrases(rows, build_filter(frequent), sizes, least)
    kept = materialize(not_inside(cut_scores(known, totals)), "collocations")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
runs AS (
  SELECT lang, size, phrase, count(*) AS f FROM (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase FROM (
      SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
      FROM words, (SELECT unnest([1, 2, 3, 4, 5]) AS size))) GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT lang, phrase, size, f AS a, k, array_to_string(w[1:k], ' ') AS first,
    array_to_string(w[k + 1:size], ' ') AS rest
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM runs
        WHERE size > 1)),
scored AS (
  SELECT c.lang, c.phrase, c.size, a, k, p.f AS l, q.f AS r, n,
    ((1000::HUGEINT * a * n) // (p.f::HUGEINT * q.f))::BIGINT AS score
  FROM cuts c JOIN runs p ON p.lang = c.lang AND p.phrase = first
  JOIN runs q ON q.lang = c.lang AND q.phrase = rest JOIN totals t ON t.lang = c.lang),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (
  SELECT lang, max(f) AS holder, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
    SELECT lang, f, w, k, unnest(range(1, size - k + 2)) AS i FROM (
      SELECT lang, f, size, string_split(phrase, ' ') AS w, unnest(range(2, size)) AS k
      FROM runs WHERE size > 2)) GROUP BY lang, array_to_string(w[i:i + k - 1], ' ')),
kept AS (
  SELECT best.* FROM best LEFT JOIN held USING (lang, phrase)
  WHERE holder IS NULL OR 100 * holder < 100 * a)
SELECT * FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, n, score FROM kept) WHERE rank <= 2000
"""


@query("op11_collocations", SQL)
def op11(spark, sf_dir):
    return mine_collocations(table(spark, sf_dir, "documents").select("lang", "text"))
