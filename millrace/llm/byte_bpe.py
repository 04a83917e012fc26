"""Byte-level BPE encoding and decoding with the tiktoken library and a local file of ranks.

Long texts are cut at places where the pattern has a border whatever stands around it, so that no
call sees more than a segment; what the ids stand for is bytes, and decoding gives those.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import query, table

SEGMENT = 1 << 16    # characters that are encoded in one call, up to the next safe place
LONG_RUN = 1 << 12   # white space of so many characters is a segment of its own
# The characters of the Unicode property White_Space, which is what \s stands for.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SAFE = re.compile(f"[^{SPACE}](?=[{SPACE}])")


def segments(text: str, size: int = SEGMENT, run: int = LONG_RUN) -> Iterator[tuple[str, bool]]:
    """Cut a text at safe places: (segment, whether it is one pre-token for certain).

    A pre-token has white space at its front only, if it is not all white space, so there is always
    a border between another character and white space. A run of white space is one pre-token up
    to its last character, which may belong to what follows; only at the end of the text it is one
    as a whole.
    """
    if len(text) <= size:
        yield text, False
        return
    at = 0
    for gap in re.finditer(f"[{SPACE}]{{{run},}}", text):
        yield from _stretches(text, at, gap.start(), size)
        at = gap.end() - (gap.end() < len(text))
        yield text[gap.start():at], True
    yield from _stretches(text, at, len(text), size)


def _stretches(text: str, at: int, end: int, size: int) -> Iterator[tuple[str, bool]]:
    while end - at > size:
        found = _SAFE.search(text, at + size - 1, end)
        if not found:
            break
        yield text[at:found.end()], False
        at = found.end()
    if at < end:
        yield text[at:end], False


class Codec:
    """One vocabulary in a worker."""

    def __init__(self, ranks: bytes, pattern: str):
        import base64

        import tiktoken

        known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=known,
                                         special_tokens={})

    def encode(self, text: str, size: int = SEGMENT, run: int = LONG_RUN) -> np.ndarray:
        parts = [np.array(self.library._encode_single_piece(part) if whole
                          else self.library.encode_ordinary(part), np.int32)
                 for part, whole in segments(text, size, run)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that ids stand for. An id without a rank is an error."""
        return b"".join(self.library.decode_bytes(ids[i:i + SEGMENT].tolist())
                        for i in range(0, len(ids), SEGMENT))


@lru_cache(maxsize=2)
def codec(ranks: bytes, pattern: str) -> Codec:
    return Codec(ranks, pattern)


def _id_lists(rows: list[np.ndarray]) -> pa.Array:
    borders = np.fromiter(chain((0,), map(len, rows)), np.int64, len(rows) + 1).cumsum()
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(flat, pa.int32()))


def bpe_encode(text: str, ranks: str, pattern: str) -> Column:
    """Column of ids (array<int>) of a text; null is the empty text. The file `ranks` is read by
    the driver (under a megabyte) and sent with the tasks."""
    data = Path(ranks).read_bytes()

    def encode(texts: pa.Array) -> pa.Array:
        own = codec(data, pattern)
        return _id_lists([own.encode(t) for t in pc.fill_null(texts, "").to_pylist()])

    return F.arrow_udf(encode, "array<int>")(F.col(text).cast("string"))


def bpe_decode(ids: str, ranks: str, pattern: str) -> Column:
    """Column of the bytes (binary) that a list of ids stands for; they need not be UTF-8. A null
    list has no bytes."""
    data = Path(ranks).read_bytes()

    def decode(lists: pa.Array) -> pa.Array:
        own = codec(data, pattern)
        return pa.array([own.decode(np.asarray(row or (), np.int32)) for row in lists.to_pylist()],
                        pa.binary())

    return F.arrow_udf(decode, "binary")(F.col(ids).cast("array<int>"))


def encode_decode(text: str, ranks: str, pattern: str) -> Column:
    """Struct column of `ids` (array<int>) and `decoded` (binary), by one pass through Python."""
    data = Path(ranks).read_bytes()

    def both(texts: pa.Array) -> pa.Array:
        own = codec(data, pattern)
        ids = [own.encode(t) for t in pc.fill_null(texts, "").to_pylist()]
        return pa.StructArray.from_arrays(
            [_id_lists(ids), pa.array(map(own.decode, ids), pa.binary())], ["ids", "decoded"])

    return F.arrow_udf(both, "ids array<int>, decoded binary")(F.col(text).cast("string"))


def byte_bpe(docs: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """Struct `doc` (the input row), `ids` and `decoded` for every row.

    `pattern` is one in which a pre-token has white space at its front only, or is all white space.
    A null text is an empty one and has no ids. A very long text goes through the library in
    segments and takes memory in proportion to its ids. Repeated rows are encoded each, no rows
    give no rows, and input columns stay inside `doc`, so their names cannot clash.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       encode_decode(text, ranks, pattern).alias("p")
                       ).select("doc", "p.ids", "p.decoded")


@query("op13_byte_bpe")
def op13(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                     public_tokenizers.PATTERN)
    return coded.select(
        "doc.doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
