"""Token counts that follow edits.

A text is cut into pre-tokens, 64 of them make a leaf, and a segment tree over the leaves holds
characters and tokens of every subtree. An edit touches the leaf in front of it (with a few
characters of context, as far as a pre-token looks ahead) and the leaves up to the first old leaf
border at which the new cutting falls in step with the old one. Only what lies between is cut and
encoded again; the sums above the changed leaves are updated and the root holds the new count.
"""

from __future__ import annotations

from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import query, table

LEAF = 64            # pre-tokens of a leaf
CONTEXT = 4          # characters before an edit that may be cut otherwise because of it
MEMORY = 400_000     # distinct pre-tokens whose counts a task remembers
TREE = "chars array<int>, tokens array<int>"
EDITS = "array<struct<start:int,stop:int,text:string>>"


class Counter:
    """Token counts of pre-tokens, remembered up to a bound."""

    def __init__(self, ranks: bytes, pattern: str):
        import base64

        import regex
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        self.cut = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=table,
                                          special_tokens={})
        self.known: dict[str, int] = {}

    def counts(self, parts: list[str]) -> list[int]:
        known = self.known
        if len(known) > MEMORY:
            known.clear()
        found = list(map(known.get, parts))
        if None in found:
            new = list({p for p, n in zip(parts, found) if n is None})
            # One call each: the library's batch call hands every short text to a thread pool.
            known.update(zip(new, map(len, map(self.encoding.encode_ordinary, new))))
            found = list(map(known.get, parts))
        return found


@lru_cache(maxsize=2)
def counter(ranks: bytes, pattern: str) -> Counter:
    return Counter(ranks, pattern)


def leaves(own: Counter, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Characters and tokens of every leaf of a text."""
    parts = own.cut.findall(text)
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    heads = np.arange(0, len(parts), LEAF)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.add.reduceat(sizes, heads), np.add.reduceat(np.array(own.counts(parts)), heads)


class SumTree:
    """A segment tree of token sums; the root is node 1, leaf i is node `width` + i."""

    def __init__(self, values: np.ndarray):
        self.width = 1 << max(0, int(len(values) - 1).bit_length())
        self.sums = np.zeros(2 * self.width, np.int64)
        self.sums[self.width:self.width + len(values)] = values
        level = self.width
        while level > 1:
            below = self.sums[level:2 * level]
            level //= 2
            self.sums[level:2 * level] = below[::2] + below[1::2]

    def replace(self, leaf: int, value: int) -> None:
        node = self.width + leaf
        change = value - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2

    @property
    def total(self) -> int:
        return int(self.sums[1])


def clean_edits(edits, n: int) -> list[tuple[int, int, str]]:
    """Edits in order, within the text; one that overlaps an earlier one is left out."""
    out, end = [], 0
    rows = [(e["start"], e["stop"], e["text"] or "") for e in edits or ()
            if e and e["start"] is not None and e["stop"] is not None]
    for start, stop, text in sorted(rows):
        if end <= start <= stop <= n:
            out.append((start, stop, text))
            end = stop
    return out


def apply_edits(own: Counter, text: str, chars: np.ndarray, tokens: np.ndarray, edits):
    """(edited text, characters and tokens of the leaves, total, pre-tokens encoded again).

    A changed stretch becomes one leaf, and the other leaves of it become empty.
    """
    edits = clean_edits(edits, len(text))
    if not edits:
        return text, chars, tokens, int(tokens.sum()), 0
    tree = SumTree(tokens)
    pieces, at, shifts, shift = [], 0, [], 0
    for start, stop, new in edits:
        pieces += [text[at:start], new]
        at, shift = stop, shift + len(new) - (stop - start)
        shifts.append(shift)
    edited = "".join([*pieces, text[at:]])
    if not len(chars):
        chars, tokens = leaves(own, edited)
        return edited, chars, tokens, int(tokens.sum()), 0 if not edited else len(
            own.cut.findall(edited))
    chars, tokens = chars.copy(), tokens.copy()
    heads = np.concatenate(([0], np.cumsum(chars)))  # old leaf borders
    n, again, i = len(chars), 0, 0
    while i < len(edits):
        first = int(np.searchsorted(heads[:n], max(0, edits[i][0] - CONTEXT), "right")) - 1
        before = shifts[i - 1] if i else 0
        place = begin = int(heads[first]) + before
        last, found = i, []

        def border(last: int, least: int) -> tuple[int, int]:
            """The edits and the old border that the stretch goes to at least."""
            while True:
                leaf = max(least, int(np.searchsorted(heads, edits[last][1], "left")))
                if last + 1 < len(edits) and edits[last + 1][0] - CONTEXT < heads[leaf]:
                    last += 1
                else:
                    return last, leaf

        last, leaf = border(last, first + 1)
        while True:
            goal = int(heads[leaf]) + shifts[last] if leaf < n else len(edited)
            while place < goal:
                match = own.cut.match(edited, place)
                found.append(match[0])
                place = match.end()
            if place == goal:
                break
            last, leaf = border(last, leaf + 1)
        chars[first:leaf], tokens[first:leaf] = 0, 0
        chars[first], tokens[first] = place - begin, sum(own.counts(found))
        for k in range(first, min(leaf, n)):
            tree.replace(k, int(tokens[k]))
        again += len(found)
        i = last + 1
    return edited, chars, tokens, tree.total, again


def _lists(rows: list[np.ndarray]) -> pa.Array:
    return pa.array([r.astype(np.int32) for r in rows], pa.list_(pa.int32()))


def token_trees(text: str, ranks: str, pattern: str):
    """Struct column TREE with the leaves of a text's tree; null is the empty text."""
    table = Path(ranks).read_bytes()

    def grow(texts: pa.Array) -> pa.Array:
        own = counter(table, pattern)
        rows = [leaves(own, t) for t in pc.fill_null(texts, "").to_pylist()]
        return pa.StructArray.from_arrays([_lists([r[0] for r in rows]), _lists([r[1] for r in rows])],
                                          ["chars", "tokens"])

    return F.arrow_udf(grow, TREE)(F.col(text).cast("string"))


def edited_trees(text: str, tree: str, edits: str, ranks: str, pattern: str):
    """Struct column: the edited text, its tree, `n_tokens` and `n_again`, the pre-tokens that were
    encoded again."""
    table = Path(ranks).read_bytes()

    def edit(texts: pa.Array, trees: pa.Array, edit_lists: pa.Array) -> pa.Array:
        own = counter(table, pattern)
        rows = []
        for t, leaf, e in zip(pc.fill_null(texts, "").to_pylist(), trees.to_pylist(),
                              edit_lists.to_pylist()):
            rows.append(apply_edits(own, t, np.array(leaf["chars"], np.int64),
                                    np.array(leaf["tokens"], np.int64), e))
        return pa.StructArray.from_arrays([
            pa.array([r[0] for r in rows], pa.string()), _lists([r[1] for r in rows]),
            _lists([r[2] for r in rows]), pa.array([r[3] for r in rows], pa.int64()),
            pa.array([r[4] for r in rows], pa.int64())],
            ["text", "chars", "tokens", "n_tokens", "n_again"])

    return F.arrow_udf(edit, f"text string, {TREE}, n_tokens long, n_again long")(
        F.col(text).cast("string"), F.col(tree), F.col(edits).cast(EDITS))


def count_edited(docs: DataFrame, ranks: str, pattern: str, text: str = "text",
                 edits: str = "edits") -> DataFrame:
    """Struct `doc` (the input row), `before` (tree of the text) and `after` (edited text, tree,
    `n_tokens`, `n_again`).

    `edits` are (start, stop, text) in characters of the text before. Edits outside the text or
    overlapping an earlier one are left out, a null text of an edit deletes, null edits and null
    lists do nothing. A null text is empty. Repeated rows are counted each, no rows give no rows,
    and input columns stay inside `doc`, so their names cannot clash.
    """
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                      F.col(text).cast("string").alias("text"), F.col(edits).alias("edits"))
    grown = own.withColumn("before", token_trees("text", ranks, pattern))
    return grown.select("doc", "before",
                        edited_trees("text", "before", "edits", ranks, pattern).alias("after"))


# What the revision of the query masks, and by what.
MASKS = [(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "<email>"),
         (r"\+?[0-9][0-9 ().-]{6,}[0-9]", "<number>")]


def masking_edits(text: str):
    """Edits that mask e-mail addresses and long numbers."""
    import re

    email, number = (p for p, _ in MASKS)
    both, only_number = re.compile(f"({email})|({number})"), re.compile(f"(?!)()|({number})")

    def edits(text: str) -> list[dict]:
        # Without an @ there is no address, and no need to try one at every letter.
        found = both if "@" in text else only_number
        return [{"start": m.start(), "stop": m.end(), "text": MASKS[m.lastindex - 1][1]}
                for m in found.finditer(text)]

    def mask(texts: pa.Array) -> pa.Array:
        rows = [edits(t) for t in pc.fill_null(texts, "").to_pylist()]
        return pa.array(rows, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()),
                                                  ("text", pa.string())])))

    return F.arrow_udf(mask, EDITS)(F.col(text).cast("string"))


@query("op7_token_counts")
def op7(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_edited(docs.withColumn("edits", masking_edits("text")),
                           public_tokenizers.path("byte_bpe_50k.tiktoken"),
                           public_tokenizers.PATTERN)
    total = F.aggregate("before.tokens", F.lit(0).cast("long"), lambda a, x: a + x)
    return counted.select(
        "doc.doc_id", total.alias("n_tokens"), F.size("doc.edits").cast("long").alias("n_edits"),
        F.col("after.n_tokens").alias("n_tokens_edited"), F.col("after.n_again").alias("n_again"))
