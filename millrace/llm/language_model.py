"""A gated recurrent language model over words, trained where the data lies.

Counting: one pass gives every training word with its count. The most frequent words, in classes of
equal size, are what the model tells apart; all others form one more class, in which words have
their smoothed unigram share. So the model gives a proper probability to any text.

Training: each task trains its own copy on its documents by truncated back-propagation; the copies
are averaged, weighted by tokens, and the average is where the next round starts. A round takes its
share of the training documents, all rounds together take every one.

Scoring: documents run side by side in lanes; the state goes on from window to window until a
document ends, so the score is that of the whole text. Words beyond a bounded list of frequent ones
get their counts by a join afterwards.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialize, query, table

END = ""               # never a word
CLASS_WORDS, CLASSES = 32, 32
WORDS = CLASS_WORDS * CLASSES  # told apart by the model, the end of the text among them
OTHER = WORDS          # number of every other word, and with CLASSES its class
FREQUENT = 1 << 17     # words whose counts every task has; a fixed bound
HIDDEN = 24
ROUNDS = 2
RATE, CLIP, SEED = 0.01, 1.0, 17
LANES, WINDOW = 256, 16        # of training
WIDE_LANES, WIDE_WINDOW = 512, 32  # of scoring
STRETCH = 2048         # training starts a document anew after so many tokens
POOL = 1 << 21         # tokens worked at once
SHAPES = {"inputs": (WORDS + 1, 3 * HIDDEN), "turn": (HIDDEN, 3 * HIDDEN), "turn_bias": (HIDDEN,),
          "classes": (HIDDEN, CLASSES + 1), "class_bias": (CLASSES + 1,),
          "words": (CLASSES, HIDDEN, CLASS_WORDS), "word_bias": (CLASSES, CLASS_WORDS)}
Params = dict[str, np.ndarray]


def pack(params: Params) -> bytes:
    return b"".join(params[name].astype("<f4").tobytes() for name in SHAPES)


def unpack(data: bytes) -> Params:
    flat, at, out = np.frombuffer(data, "<f4"), 0, {}
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at:at + n].reshape(shape).astype(np.float32)
        at += n
    return out


def first_params(counts: np.ndarray, other: float) -> Params:
    """Small random weights; the biases alone give the unigram shares."""
    chance = np.random.default_rng(SEED)
    params = {name: (chance.normal(size=shape) * 0.1).astype(np.float32)
              for name, shape in SHAPES.items()}
    shares = np.zeros(WORDS) + 0.5
    shares[:len(counts)] += counts
    by_class = shares.reshape(CLASSES, CLASS_WORDS)
    params["word_bias"] = np.log(by_class).astype(np.float32)
    params["class_bias"] = np.log(np.append(by_class.sum(axis=1), other + 0.5)).astype(np.float32)
    params["turn_bias"] *= 0
    params["classes"] *= 0.1
    params["words"] *= 0.1
    return params


def _gates(params: Params, h: np.ndarray, x: np.ndarray):
    """One step of the recurrent unit from the gathered inputs `x`: the next state and what the way
    back needs (both gates, the inner part of the candidate, the candidate)."""
    g = h @ params["turn"]
    gates = x[:, :2 * HIDDEN] + g[:, :2 * HIDDEN]
    np.negative(gates, out=gates)
    np.exp(gates, out=gates)
    gates += 1
    np.reciprocal(gates, out=gates)
    r, z = gates[:, :HIDDEN], gates[:, HIDDEN:]
    inner = g[:, 2 * HIDDEN:]
    inner += params["turn_bias"]
    n = r * inner
    n += x[:, 2 * HIDDEN:]
    np.tanh(n, out=n)
    after = h - n
    after *= z
    after += n
    return after, gates, inner, n


def _step(params: Params, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return _gates(params, h, params["inputs"][ids])[0]


def _log_share(logits: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logarithm of each column's softmax at one row, and the softmax (in place of logits). Columns
    are tokens, so that sums run along whole rows."""
    logits -= logits.max(axis=0)
    picked = logits[rows, np.arange(logits.shape[1])]
    np.exp(logits, out=logits)
    total = logits.sum(axis=0)
    logits /= total
    return picked - np.log(total), logits


def _output(params: Params, h: np.ndarray, ids: np.ndarray, grads: Params | None = None):
    """Natural logarithm of each token's share; with `grads` also d(-sum)/dh, and adds to them."""
    # By class, so that what belongs to one is a slice; tokens are columns.
    order = np.argsort(ids // CLASS_WORDS, kind="stable")
    h, ids = np.ascontiguousarray(h[order].T), ids[order]
    of = ids // CLASS_WORDS
    borders = np.searchsorted(of, np.arange(CLASSES + 1)).tolist()
    logits = params["classes"].T @ h
    logits += params["class_bias"][:, None]
    out, share = _log_share(logits, of)
    back = None
    if grads is not None:
        share[of, np.arange(len(ids))] -= 1
        grads["classes"] += h @ share.T
        grads["class_bias"] += share.sum(axis=1)
        back = params["classes"] @ share
    for c, (low, high) in enumerate(zip(borders, borders[1:])):
        if low == high:
            continue
        own, row = h[:, low:high], ids[low:high] - c * CLASS_WORDS
        logits = params["words"][c].T @ own
        logits += params["word_bias"][c][:, None]
        logs, share = _log_share(logits, row)
        out[low:high] += logs
        if grads is not None:
            share[row, np.arange(high - low)] -= 1
            grads["words"][c] += own @ share.T
            grads["word_bias"][c] += share.sum(axis=1)
            back[:, low:high] += params["words"][c] @ share
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return out[place], None if back is None else back.T[place]


@dataclass
class Lanes:
    """Documents laid one after the other into lanes, the longest lane first."""
    ids: np.ndarray      # (steps, lanes), OTHER where a lane has ended
    starts: np.ndarray   # (steps, lanes), True where a document begins
    ends: np.ndarray     # steps of each lane, falling
    row: np.ndarray      # place of every token, documents one after the other
    lane: np.ndarray


def lay_out(ids: np.ndarray, sizes: np.ndarray, lanes: int) -> Lanes:
    heap = [(0, i) for i in range(max(1, min(lanes, len(sizes))))]
    offset, lane = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    filled = np.zeros(len(heap), np.int64)
    for d in np.argsort(-sizes, kind="stable").tolist():
        used, i = heap[0]
        offset[d], lane[d] = used, i
        filled[i] = used + sizes[d]
        heapq.heapreplace(heap, (int(filled[i]), i))
    order = np.argsort(-filled, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    lane, ends = place[lane], filled[order]
    heads = np.cumsum(sizes) - sizes
    row = np.arange(len(ids)) + np.repeat(offset - heads, sizes)
    column = np.repeat(lane, sizes)
    grid = np.full((int(ends[0]) if len(sizes) else 0, len(heap)), OTHER, np.int16)
    starts = np.zeros(grid.shape, bool)
    grid[row, column] = ids
    starts[offset[sizes > 0], lane[sizes > 0]] = True
    return Lanes(grid, starts, ends, row, column)


def windows(laid: Lanes, size: int) -> Iterator[tuple[slice, int]]:
    """(steps, lanes that are not over yet) of each window."""
    for at in range(0, len(laid.ids), size):
        yield slice(at, min(at + size, len(laid.ids))), int((laid.ends > at).sum())


def score_pool(params: Params, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Natural logarithm of each document's probability, other words as one word."""
    laid = lay_out(ids, sizes, WIDE_LANES)
    logs = np.zeros(laid.ids.shape, np.float32)
    h = np.zeros((laid.ids.shape[1], HIDDEN), np.float32)
    for steps, n in windows(laid, WIDE_WINDOW):
        block, starts, seen = laid.ids[steps, :n], laid.starts[steps, :n], []
        h = h[:n]
        x, goes_on = params["inputs"][block], (~starts).astype(np.float32)[:, :, None]
        for t in range(len(block)):
            h = h * goes_on[t]
            seen.append(h)
            h = _gates(params, h, x[t])[0]
        valid = np.arange(steps.start, steps.stop)[:, None] < laid.ends[:n]
        out, _ = _output(params, np.stack(seen)[valid], block[valid].astype(np.int64))
        part = np.zeros(block.shape, np.float32)
        part[valid] = out
        logs[steps, :n] = part
    per_token = logs[laid.row, laid.lane].astype(np.float64)
    return np.add.reduceat(per_token, np.cumsum(sizes) - sizes) if len(sizes) else np.zeros(0)


class Trainer:
    """Adam over truncated back-propagation."""

    def __init__(self, params: Params):
        self.params = params
        self.mean = {k: np.zeros_like(v) for k, v in params.items()}
        self.square = {k: np.zeros_like(v) for k, v in params.items()}
        self.turns = self.tokens = 0

    def pool(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Documents in stretches; the state goes on between windows, gradients do not."""
        whole, left = np.divmod(sizes, STRETCH)
        parts = np.concatenate([[STRETCH] * w + [rest] * (rest > 0)
                                for w, rest in zip(whole.tolist(), left.tolist())] or [[]])
        laid = lay_out(ids, parts.astype(np.int64), LANES)
        h = np.zeros((laid.ids.shape[1], HIDDEN), np.float32)
        for steps, n in windows(laid, WINDOW):
            valid = np.arange(steps.start, steps.stop)[:, None] < laid.ends[:n]
            h = self._window(h[:n], laid.ids[steps, :n], laid.starts[steps, :n], valid)
        self.tokens += len(ids)

    def _window(self, h, block, starts, valid) -> np.ndarray:
        params, steps = self.params, len(block)
        grads = {k: np.zeros_like(v) for k, v in params.items()}
        shape = (*block.shape, HIDDEN)
        states, inner, n = (np.empty(shape, np.float32) for _ in range(3))
        gates = np.empty((*block.shape, 2 * HIDDEN), np.float32)
        x, goes_on = params["inputs"][block], (~starts).astype(np.float32)[:, :, None]
        for t in range(steps):
            states[t] = h * goes_on[t]
            h, gates[t], inner[t], n[t] = _gates(params, states[t], x[t])
        if valid.all():
            _, outer = _output(params, states.reshape(-1, HIDDEN), block.ravel().astype(np.int64),
                               grads)
            outer = outer.reshape(shape)
        else:
            _, back = _output(params, states[valid], block[valid].astype(np.int64), grads)
            outer = np.zeros_like(states)
            outer[valid] = back
        r, z = gates[..., :HIDDEN], gates[..., HIDDEN:]
        # What a gradient of the next state is multiplied by on its way into each gate.
        to_n = (1 - z) * (1 - n * n)
        to_r, to_z = inner * r * (1 - r), (states - n) * z * (1 - z)
        above = np.zeros_like(h)  # gradient of the state after step t
        into, turned = (np.empty((*block.shape, 3 * HIDDEN), np.float32) for _ in range(2))
        turn = np.ascontiguousarray(params["turn"].T)
        for t in range(steps - 1, -1, -1):
            d_n = above * to_n[t]
            np.multiply(d_n, to_r[t], out=turned[t, :, :HIDDEN])
            np.multiply(above, to_z[t], out=turned[t, :, HIDDEN:2 * HIDDEN])
            np.multiply(d_n, r[t], out=turned[t, :, 2 * HIDDEN:])
            into[t, :, 2 * HIDDEN:] = d_n
            above = above * z[t]
            above += turned[t] @ turn
            above += outer[t]
            above *= goes_on[t]
        into[..., :2 * HIDDEN] = turned[..., :2 * HIDDEN]
        turned = turned.reshape(-1, 3 * HIDDEN)
        grads["turn"] += states.reshape(-1, HIDDEN).T @ turned
        grads["turn_bias"] += turned[:, 2 * HIDDEN:].sum(axis=0)
        flat = block.ravel()
        order = np.argsort(flat, kind="stable")
        heads = np.flatnonzero(np.diff(flat[order], prepend=-1))
        grads["inputs"][flat[order][heads]] = np.add.reduceat(
            into.reshape(-1, 3 * HIDDEN)[order], heads)
        self._update(grads, max(1, int(valid.sum())))
        return h

    def _update(self, grads: Params, n: int) -> None:
        self.turns += 1
        size = np.sqrt(sum(float(np.vdot(g, g)) for g in grads.values())) / n
        scale = np.float32(min(1.0, CLIP / max(size, 1e-12)) / n)
        rate = np.float32(RATE * np.sqrt(1 - 0.999**self.turns) / (1 - 0.9**self.turns))
        for k, g in grads.items():
            g *= scale
            mean, square = self.mean[k], self.square[k]
            mean *= np.float32(0.9)
            mean += np.float32(0.1) * g
            square *= np.float32(0.999)
            g *= g
            g *= np.float32(0.001)
            square += g
            np.sqrt(square, out=g)
            g += np.float32(1e-6)
            np.divide(mean, g, out=g)
            g *= rate
            self.params[k] -= g


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, a null id as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def token_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of all texts, flat, and the number of words of each."""
    if texts.offset:  # the functions below are wrong on a slice that begins within its buffers
        texts = texts.take(pa.array(np.arange(len(texts))))
    parts = pc.ascii_split_whitespace(pc.ascii_lower(
        pc.fill_null(texts, "").cast(pa.large_string())))
    flat = parts.flatten()
    real = np.asarray(pc.not_equal(flat, ""))
    of = np.repeat(np.arange(len(parts)), np.asarray(parts.value_lengths()))
    return flat.filter(pa.array(real)), np.bincount(of[real], minlength=len(parts))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over `text`; every text ends with END."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ends = [], 0

        def flush() -> pa.RecordBatch:
            found = pc.value_counts(pa.concat_arrays(held))
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays([found.field(0).cast(pa.string()), pa.array([END])]),
                 pa.concat_arrays([found.field(1), pa.array([ends], pa.int64())])], ["word", "n"])

        for batch in batches:
            held.append(token_lists(batch.column(0))[0])
            ends += batch.num_rows
            if sum(map(len, held)) >= POOL:
                yield flush()
                held, ends = [], 0
        if ends:
            yield flush()

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(
        F.sum("n").alias("n")).where("n > 0")


def frequent_words(counts: DataFrame, most: int) -> list:
    """The (word, n) rows of highest count, by count and word: `most` at most, and all of a size
    class (a sixteenth of an octave of the count) or none of it.

    Only the rows that are wanted come to the driver, not as many from every task.
    """
    classed = counts.withColumn("class", F.floor(F.log2("n") * 16))
    taken, least = 0, None
    for r in sorted(classed.groupBy("class").agg(F.count(F.lit(1)).alias("v")).collect(),
                    key=lambda r: -r["class"]):
        taken += r["v"]
        if taken > most:
            break
        least = r["class"]
    if least is None:
        return []
    found = classed.where(F.col("class") >= least).select("word", "n").collect()
    return sorted(found, key=lambda r: (-r["n"], r["word"]))


class Numbers:
    """Ranks of the frequent words by count; the end of a text always has rank 0."""

    def __init__(self, words: list[str], counts: list[int]):
        self.words, self.counts = pa.array(words, pa.large_string()), np.array(counts, np.float64)

    def ranks(self, texts: pa.Array):
        """(rank of each token with the end of every text, -1 if not frequent; tokens per text;
        place of each token in the words; the words)."""
        flat, sizes = token_lists(texts)
        coded = flat.dictionary_encode()
        words = coded.dictionary
        of_word = np.asarray(pc.fill_null(pc.index_in(words, self.words), -1), np.int64)
        sizes = sizes + 1
        ends = np.cumsum(sizes) - 1
        inner = np.ones(int(sizes.sum()), bool)
        inner[ends] = False
        rank, place = np.zeros(len(inner), np.int64), np.full(len(inner), -1)
        place[inner] = np.asarray(coded.indices, np.int64)
        rank[inner] = of_word[place[inner]] if len(words) else 0
        return rank, sizes, place, words


def model_ids(rank: np.ndarray) -> np.ndarray:
    return np.where((rank >= 0) & (rank < WORDS), rank, OTHER)


def train_round(docs: DataFrame, numbers, params: bytes) -> bytes | None:
    """The average of the copies that the tasks train on `text`; None without a text."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(unpack(params))
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> None:
            if held:
                trainer.pool(*(np.concatenate(p) for p in zip(*held)))
                held.clear()

        for batch in batches:
            rank, sizes, _, _ = numbers.value.ranks(batch.column(0))
            held.append((model_ids(rank), sizes))
            if sum(len(i) for i, _ in held) >= POOL // 4:
                flush()
        flush()
        if trainer.tokens:
            yield from weighted(TaskContext.get().partitionId(), trainer.tokens, trainer.params)

    def weighted(part: int, weight: float, own: Params) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([float(weight)]), pa.array([pack(own)])],
            ["part", "weight", "params"])

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = None, 0.0
        for batch in batches:
            for w, data in zip(batch.column("weight").to_pylist(), batch.column("params").to_pylist()):
                own = np.frombuffer(data, "<f4").astype(np.float64) * w
                total, weight = own if total is None else total + own, weight + w
        if total is not None:
            yield from weighted(0, weight, unpack((total / weight).astype("<f4").tobytes()))

    shape = "part int, weight double, params binary"
    copies = docs.select("text").mapInArrow(train, shape)
    fan = 8  # rows that reach the driver, whatever the number of copies
    kept = copies.repartition(fan, "part").mapInArrow(average, shape).collect()
    rows = [r for r in kept if r["params"] is not None]
    if not rows:
        return None
    weight = sum(r["weight"] for r in rows)
    mean = sum(np.frombuffer(bytes(r["params"]), "<f4").astype(np.float64) * (r["weight"] / weight)
               for r in rows)
    return mean.astype("<f4").tobytes()


@dataclass
class Language:
    """What training leaves: all counts, the frequent words, the parameters, totals."""
    counts: DataFrame
    numbers: object
    params: bytes
    tokens: int
    words: int
    other_tokens: int
    other_words: int

    @property
    def base_total(self) -> float:
        return self.tokens + 0.5 * (self.words + 1)

    @property
    def other_total(self) -> float:
        return self.other_tokens + 0.5 * (self.other_words + 1)


def learn(docs: DataFrame, rounds: int = ROUNDS) -> Language:
    """Train on all rows of `docs` (text, part): `part` deals them to rounds by its remainder."""
    spark = docs.sparkSession
    counts = materialize(word_counts(docs), "counts")
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = frequent_words(counts.where(F.col("word") != END), FREQUENT - 1)
    ends = sum(r["n"] for r in counts.where(F.col("word") == END).collect())
    numbers = Numbers([END] + [r["word"] for r in top], [ends] + [r["n"] for r in top])
    told = int(numbers.counts[:WORDS].sum())
    seen = int((numbers.counts[:WORDS] > 0).sum())
    shared = spark.sparkContext.broadcast(numbers)
    params = pack(first_params(numbers.counts[:WORDS], totals["n"] - told))
    for turn in range(rounds):
        own = docs.where(F.pmod(F.col("part"), F.lit(rounds)) == turn)
        params = train_round(own, shared, params) or params
    return Language(counts, shared, params, totals["n"], totals["v"], totals["n"] - told,
                    totals["v"] - seen)


SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, n_rare long, " \
         "base double, score double, rare array<struct<word:string,n:long>>"


def score_texts(docs: DataFrame, model: Language) -> DataFrame:
    """One row of SCORED per row of `docs` (doc_id, held_out, text). `rare` holds the words whose
    counts the tasks do not have; `base` and `score` lack them."""
    numbers, data = model.numbers, model.params
    base_log, other_log = np.log10(model.base_total), np.log10(model.other_total)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        params, row = unpack(data), TaskContext.get().partitionId() << 40
        held: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal row
            if not held:
                return
            ids, sizes = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            logs, at = score_pool(params, ids, sizes) / np.log(10), 0
            for _, own, columns, told, rare in held:
                n = len(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + n)), *columns[:5], columns[5],
                     pa.array(logs[at:at + n] + told), rare],
                    [p.split()[0] for p in SCORED.split(", ")])
                row, at = row + n, at + n
            held.clear()

        for batch in batches:
            rank, sizes, place, words = numbers.value.ranks(batch.column("text"))
            n, doc = len(sizes), np.repeat(np.arange(len(sizes)), sizes)
            known = rank >= 0
            log_counts = np.log10(numbers.value.counts + 0.5)
            logs = log_counts[np.maximum(rank, 0)]
            seen = known & (numbers.value.counts[np.maximum(rank, 0)] > 0)
            n_known = np.bincount(doc[seen], minlength=n)
            frequent = np.bincount(doc[known], minlength=n)
            # Subtract per token: sums of large parts that cancel would lose digits.
            base = np.bincount(doc, weights=np.where(known, logs - base_log, 0.0), minlength=n)
            loose = known & (rank >= WORDS)
            told = np.bincount(doc[loose], weights=logs[loose] - other_log, minlength=n)
            pair, counts = np.unique(doc[~known] * max(1, len(words)) + place[~known],
                                     return_counts=True)
            of, word = np.divmod(pair, max(1, len(words)))
            rare = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(np.bincount(of, minlength=n)))), pa.int32()),
                pa.StructArray.from_arrays([words.take(pa.array(word)).cast(pa.string()),
                                            pa.array(counts, pa.int64())], ["word", "n"]))
            columns = [batch.column("doc_id"), batch.column("held_out"),
                       pa.array(sizes.astype(np.int64)), pa.array(n_known.astype(np.int64)),
                       pa.array((sizes - frequent).astype(np.int64)), pa.array(base)]
            held.append((model_ids(rank), sizes, columns, told, rare))
            if sum(len(h[0]) for h in held) >= POOL:
                yield from flush()
        yield from flush()

    return docs.select("doc_id", "held_out", "text").mapInArrow(score, SCORED)


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row.

    Learns from the rows whose crc32 of the key as text leaves a remainder other than 1 by 5, and
    scores all, in whole. A null text is empty (its end is its one token), a null key counts as the
    empty text. Repeated rows are learnt from and scored each. Without training rows, every word is
    unknown and the model is its first state. No rows give no rows; other columns are not read.
    A very long text goes through in windows that hand on their state, so its score is that of the
    whole. `score` depends on how the table is partitioned, as every task trains on its part;
    `base_score` and the counts do not.
    """
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                      fold(F.col(key)).alias("crc"))
    own = own.select("doc_id", "text", (F.col("crc") % 5 == 1).alias("held_out"),
                     F.expr("crc div 5").alias("part"))
    model = learn(own.where("not held_out").select("text", "part"))
    scored = materialize(score_texts(own, model), "scored")
    rare = scored.where("n_rare > 0").select("row", F.inline("rare"))
    counts = model.counts.select("word", F.col("n").alias("c"))
    log_count = F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    logs = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * (log_count - math.log10(model.base_total))).alias("more_base"),
        F.sum(F.col("n") * (log_count - math.log10(model.other_total))).alias("more_score"))
    return scored.drop("rare").join(logs, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"))


@query("op5_language_model")
def op5(spark, sf_dir):
    return score_documents(table(spark, sf_dir, "documents"))
