"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

The words of a batch are made distinct first; words never merge with each other, since no piece has
the space mark behind another character. All new words are then laid out as one flat array of
symbols. A round looks up the rank of every neighbouring pair, takes the smallest rank per word,
merges the leftmost non-overlapping pairs of that rank in all words at once, and closes the gaps;
words without a mergeable pair leave. Where a merge makes a pair that would come before the
remaining pairs of its round (runs of spaces, odd vocabularies), the word is done one merge at a time.
"""

from __future__ import annotations

import heapq
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import query, table

MARK = "▁"
NONE = np.int32(2**31 - 1)
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
PORTION = 2 << 20  # bytes of text that the flat arrays of a task stand for, about
MEMORY = 300_000  # distinct words a task remembers before it starts anew


class Model:
    """Vocabulary and merge table of a BPE model with identity normalisation and byte fallback."""

    def __init__(self, proto: bytes):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(proto)
        norm, kind = model.normalizer_spec, model.trainer_spec
        if (kind.model_type != 2 or norm.precompiled_charsmap or not norm.add_dummy_prefix
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces
                or kind.treat_whitespace_as_suffix or not kind.byte_fallback):
            raise ValueError("only BPE models with identity normalisation, a dummy prefix, "
                             "escaped spaces and byte fallback can be read")
        self.bos, self.eos = kind.bos_id, kind.eos_id
        pieces = [(p.piece, p.score, p.type or NORMAL) for p in model.pieces]
        if {t for _, _, t in pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("the model has pieces of a kind that is not read here")
        symbol = {p: i for i, (p, _, t) in enumerate(pieces) if t == NORMAL}
        if any(MARK in p.lstrip(MARK) for p in symbol):
            raise ValueError("a piece goes over a word border")
        normal, self.n_pieces = dict(symbol), len(pieces)
        for char in sorted({c for p in normal for c in p}):
            symbol.setdefault(char, len(symbol) + len(pieces))
        order = {s: r for r, s in enumerate(sorted({-s for _, s, t in pieces if t == NORMAL}))}
        self.size = max(symbol.values()) + 2  # the last number stands for any other character
        merges = {}
        for whole, number in normal.items():
            for cut in range(1, len(whole)):
                left, right = symbol.get(whole[:cut]), symbol.get(whole[cut:])
                if left is not None and right is not None:
                    merges[left * self.size + right] = (number, order[-pieces[number][1]])
        keys = sorted(merges)
        self.keys = np.array(keys, np.int64)
        self.made = np.array([merges[k][0] for k in keys], np.int32)
        self.rank = np.array([merges[k][1] for k in keys], np.int32)
        self.chars = np.full(0x110000, self.size - 1, np.int32)
        for char, number in symbol.items():
            if len(char) == 1:
                self.chars[ord(char)] = number
        self.bytes = np.zeros(256, np.int32)
        surface = []
        for i, (p, _, t) in enumerate(pieces):
            if t == BYTE:
                self.bytes[int(p[1:-1], 16)] = i
                surface.append(bytes([int(p[1:-1], 16)]))
            else:
                surface.append({NORMAL: p.replace(MARK, " "), UNKNOWN: " ⁇ ", CONTROL: ""}[t]
                               .encode())
        self.is_byte = np.array([t == BYTE for _, _, t in pieces])
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.ends = np.cumsum([len(s) for s in surface])
        self.lengths = np.diff(self.ends, prepend=0)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of merging two symbols (NONE if they don't merge) and what they make."""
        wanted = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == wanted
        return np.where(hit, self.rank[at], NONE), np.where(hit, self.made[at], -1)

    def one_by_one(self, symbols: list[int]) -> list[tuple[int, int]]:
        """(symbol, first character) of a word, best pair first, leftmost first among equals."""
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n)) + [-1]
        symbols, heap = list(symbols), []

        def offer(at: int) -> None:
            if at >= 0 and after[at] >= 0:
                key = symbols[at] * self.size + symbols[after[at]]
                place = int(np.searchsorted(self.keys, key))
                if place < len(self.keys) and self.keys[place] == key:
                    heapq.heappush(heap, (int(self.rank[place]), at, symbols[at],
                                          symbols[after[at]], int(self.made[place])))

        for i in range(n):
            offer(i)
        while heap:
            _, at, left, right, made = heapq.heappop(heap)
            gone = after[at]
            if symbols[at] != left or gone < 0 or symbols[gone] != right:
                continue
            symbols[at], symbols[gone], after[at] = made, -1, after[gone]
            if after[gone] >= 0:
                before[after[gone]] = at
            offer(before[at])
            offer(at)
        return [(s, i) for i, s in enumerate(symbols) if s >= 0]

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, flat, and the number of ids of each; words have their space marks."""
        text = "".join(words)
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        first = self.chars[code]
        symbol, place = first.copy(), np.arange(len(code))
        word = np.repeat(np.arange(len(words)), sizes)
        rank, made = self._pairs(symbol, word)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        single: list[int] = []
        while len(symbol):
            heads = np.flatnonzero(np.diff(word, prepend=-1))
            least = np.repeat(np.minimum.reduceat(rank, heads), np.diff(heads, append=len(word)))
            over = least == NONE
            if over.any():
                done.append((word[over], place[over], symbol[over]))
                keep = ~over
                symbol, place, word = symbol[keep], place[keep], word[keep]
                rank, made, least = rank[keep], made[keep], least[keep]
                if not len(symbol):
                    break
            symbol, place, word, rank, made, bad = self._round(symbol, place, word, rank, made,
                                                               least)
            if len(bad):
                single += bad.tolist()
                keep = ~np.isin(word, bad)
                symbol, place, word, rank, made = (a[keep] for a in (symbol, place, word, rank,
                                                                     made))
        starts = np.cumsum(sizes) - sizes
        for w in single:
            out = self.one_by_one(first[starts[w]:starts[w] + sizes[w]].tolist())
            done.append((np.full(len(out), w), np.array([i for _, i in out]) + starts[w],
                         np.array([s for s, _ in out], np.int32)))
        if not done:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        word, place, symbol = (np.concatenate(part) for part in zip(*done))
        order = np.argsort(place, kind="stable")
        return self._ids(word[order], code[place[order]], symbol[order], len(words))

    def _pairs(self, symbol, word):
        rank, made = np.full(len(symbol), NONE), np.full(len(symbol), -1, np.int32)
        same = np.flatnonzero(word[1:] == word[:-1])
        rank[same], made[same] = self.look_up(symbol[same], symbol[same + 1])
        return rank, made

    def _round(self, symbol, place, word, rank, made, least):
        """One merge round; also the words in which a merge made a pair that had to come first."""
        n, at = len(symbol), np.arange(len(symbol))
        chosen = rank == least
        opens = chosen & ~np.concatenate(([False], chosen[:-1]))
        run = np.maximum.accumulate(np.where(opens, at, 0))
        merged = np.flatnonzero(chosen & ((at - run) % 2 == 0))
        level, own = rank[merged], word[merged]
        after = np.minimum(merged + 2, n - 1)
        has_after = (merged + 2 < n) & (word[after] == own)
        was_after = symbol[after]
        symbol[merged] = made[merged]
        gone = np.zeros(n, bool)
        gone[merged + 1] = True
        before = np.maximum(merged - 1, 0)
        has_before = (merged > 0) & (word[before] == own)
        before = np.where(gone[before], before - 1, before)
        next_rank, next_made = self.look_up(symbol[merged], was_after)
        next_rank[~has_after] = NONE
        last_rank, last_made = self.look_up(symbol[before], symbol[merged])
        last_rank[~has_before] = NONE
        bad = np.unique(own[(next_rank <= level) | (last_rank <= level)])
        rank[merged], made[merged] = next_rank, next_made
        before = before[has_before]
        rank[before], made[before] = last_rank[has_before], last_made[has_before]
        keep = ~gone
        return symbol[keep], place[keep], word[keep], rank[keep], made[keep], bad

    def _ids(self, word, code, symbol, n_words) -> tuple[np.ndarray, np.ndarray]:
        other = np.flatnonzero(symbol >= self.n_pieces)
        counts = np.bincount(word, minlength=n_words)
        if not len(other):
            return symbol.astype(np.int32), counts
        spelt = [self.bytes[list(chr(c).encode())] for c in code[other].tolist()]
        sizes = np.ones(len(symbol), np.int64)
        sizes[other] = [len(s) for s in spelt]
        ids = np.repeat(symbol, sizes).astype(np.int32)
        ids[np.repeat(symbol >= self.n_pieces, sizes)] = np.concatenate(spelt)
        return ids, np.bincount(word, weights=sizes, minlength=n_words).astype(np.int64)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start+1, ... of every range, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Codec:
    """A model with the words seen lately."""

    def __init__(self, proto: bytes):
        self.model = Model(proto)
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.flat, self.starts, self.sizes = (np.zeros(0, t) for t in (np.int32, int, int))

    def _slots(self, words: list[str]) -> np.ndarray:
        slots = self.slots
        new = [w for w in dict.fromkeys(words) if w not in slots]
        if new:
            ids, counts = self.model.words(new)
            self.starts = np.concatenate((self.starts, len(self.flat) + np.cumsum(counts) - counts))
            self.sizes = np.concatenate((self.sizes, counts))
            self.flat = np.concatenate((self.flat, ids))
            slots.update(zip(new, range(len(slots), len(slots) + len(new))))
        return np.fromiter(map(slots.__getitem__, words), np.int64, len(words))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, flat, with begin and end ids, and the borders of the texts."""
        if len(self.slots) > MEMORY:
            self._forget()
        n = len(texts)
        odd = np.array([not t or t[0] == " " or t[-1] == " " or "  " in t or MARK in t
                        for t in texts.to_pylist()], bool)
        counts = np.zeros(n, np.int64)
        parts = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        counts[~odd] = np.asarray(parts.value_lengths())
        coded = parts.flatten().dictionary_encode()
        usual = self._slots([MARK + w for w in coded.dictionary.to_pylist()])[
            np.asarray(coded.indices)] if len(coded) else np.zeros(0, np.int64)
        unusual: list[str] = []
        for i in np.flatnonzero(odd).tolist():
            words = _marked(texts[i].as_py())
            counts[i] = len(words)
            unusual += words
        where = np.repeat(odd, counts)
        slots = np.empty(len(where), np.int64)
        slots[~where] = usual
        slots[where] = self._slots(unusual)
        sizes = self.sizes[slots]
        ids = self.flat[ranges(self.starts[slots], sizes)]
        per_word = np.concatenate(([0], np.cumsum(sizes)))
        per_text = np.diff(per_word[np.concatenate(([0], np.cumsum(counts)))])
        borders = np.concatenate(([0], np.cumsum(per_text + 2)))
        out = np.empty(borders[-1], np.int32)
        inner = np.ones(len(out), bool)
        inner[borders[:-1]] = inner[borders[1:] - 1] = False
        out[borders[:-1]], out[borders[1:] - 1] = self.model.bos, self.model.eos
        out[inner] = ids
        return out, borders

    def decode(self, ids: np.ndarray, borders: np.ndarray) -> pa.Array:
        """Texts of the ids. Bytes that are no UTF-8 become replacement characters."""
        m = self.model
        sizes = m.lengths[ids]
        data = m.surface[ranges(m.ends[ids] - sizes, sizes)]
        ends = np.concatenate(([0], np.cumsum(sizes)))[borders]
        keep = np.ones(len(data), bool)
        filled = ends[:-1][np.diff(ends) > 0]
        keep[filled[data[filled] == 32]] = False  # the dummy prefix
        ends = np.concatenate(([0], np.cumsum(keep)))[ends]
        data = data[keep].tobytes()
        texts = pa.Array.from_buffers(pa.string(), len(ends) - 1, [
            None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data)])
        if m.is_byte[ids].any():
            try:
                texts.validate(full=True)
            except pa.ArrowInvalid:
                cuts = ends.tolist()
                texts = pa.array([data[a:b].decode("utf-8", "replace")
                                  for a, b in zip(cuts, cuts[1:])], pa.string())
        return texts


def _marked(text: str) -> list[str]:
    """The words of a text with odd spaces: a run of marks and what follows it."""
    if not text:
        return []
    out, open_marks = [], ""
    for part in text.replace(MARK, " ").split(" "):
        if part:
            out.append(open_marks + MARK + part)
            open_marks = ""
        else:
            open_marks += MARK
    return out + ([open_marks] if open_marks else [])


@lru_cache(maxsize=2)
def codec(proto: bytes) -> Codec:
    return Codec(proto)


def portions(texts: pa.Array) -> list[pa.Array]:
    """The texts in stretches of about PORTION bytes, or of one text that is longer."""
    ends = np.cumsum(np.asarray(pc.binary_length(texts), np.int64))
    cuts = np.flatnonzero(np.diff(ends // PORTION)) + 1
    borders = [0, *cuts.tolist(), len(texts)]
    return [texts.slice(a, b - a) for a, b in zip(borders, borders[1:]) if b > a]


def binary_array(data: np.ndarray, borders: np.ndarray) -> pa.Array:
    """Little-endian unsigned 32-bit ids of each text."""
    return pa.Array.from_buffers(pa.binary(), len(borders) - 1, [
        None, pa.py_buffer((4 * borders).astype(np.int32).tobytes()),
        pa.py_buffer(data.astype("<u4").tobytes())])


def encode_decode(text: str, model: str):
    """Struct column of `ids` (packed little-endian unsigned 32-bit numbers, with begin and end id)
    and `decoded`, the text that these ids stand for.

    The file `model` is read by the driver (about half a megabyte) and sent with the tasks. Null
    and empty texts have the begin and end id only and decode to an empty text.
    """
    proto = Path(model).read_bytes()

    def both(texts: pa.Array) -> pa.Array:
        own, texts = codec(proto), pc.fill_null(texts, "")
        done = [(binary_array(ids, borders), own.decode(ids, borders))
                for ids, borders in map(own.encode, portions(texts))]
        columns = [pa.concat_arrays(part) for part in zip(*done)] or [
            pa.array([], pa.binary()), pa.array([], pa.string())]
        return pa.StructArray.from_arrays(columns, ["ids", "decoded"])

    return F.arrow_udf(both, "ids binary, decoded string")(F.col(text).cast("string"))


def sentencepiece_encode(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """Struct `doc` (the input row), `ids` and `decoded` for every row.

    Repeated rows are encoded each; no rows give no rows; input columns stay inside `doc`, so their
    names cannot clash. A null text is an empty one. One task remembers at most `MEMORY` distinct
    words and one Arrow batch; a very long text is worked by itself, in memory in proportion to it.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       encode_decode(text, model).alias("p")).select("doc", "p.ids", "p.decoded")


def digests(coded: DataFrame) -> DataFrame:
    """Number and digest of the ids, and digest of the decoded text."""
    return coded.select("doc.doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op2_sentencepiece")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(sentencepiece_encode(docs, default_model()))
