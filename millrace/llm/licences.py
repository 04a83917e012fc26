"""Licence scans: an Aho-Corasick automaton over words, and licence expressions.

One automaton holds the notice phrases and the identifier tag and runs over the text's words joined
by single spaces. Where it meets the tag, the expression behind it is read from the raw text,
brought into postfix order by the shunting-yard method and evaluated: `or` lets the reader choose,
`and` binds both sides, `with` grants an exception.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import query, table

# The phrases of the base with their labels, further notices, the tag, and how freely
# texts under a licence may be used, by the beginning of its label (the longest one counts).
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by",
        "mit license": "mit"}
NOTICES = {
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl",
    "mozilla public license": "mpl", "eclipse public license": "epl", "bsd license": "bsd",
    "isc license": "isc", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa", "cc by nc nd": "cc-by-nc-nd", "cc0": "cc0",
    "creative commons attribution": "cc-by", "creative commons zero": "cc0",
    "public domain": "public-domain", "all rights reserved": "reserved",
}
TAG = "spdx license identifier"
FREEDOM = {
    "0bsd": 1.0, "agpl": 0.2, "apache": 0.9, "bsd": 0.9, "cc-by": 0.8, "cc-by-nc": 0.3,
    "cc-by-nd": 0.2, "cc-by-nc-nd": 0.1, "cc-by-sa": 0.5, "cc0": 1.0, "epl": 0.5, "gpl": 0.3,
    "isc": 0.9, "lgpl": 0.4, "mit": 0.9, "mpl": 0.5, "public-domain": 1.0, "reserved": 0.0,
    "unlicense": 1.0, "zlib": 0.9,
}
EXCEPTION = 0.1  # what an exception adds
BINDING = {"or": 1, "and": 2, "with": 3}
RAW_TAG = re.compile(r"spdx-license-identifier[ \t]*:[ \t]*", re.IGNORECASE)
PART = re.compile(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
#: Lowers A-Z, and makes spaces of all ASCII but digits and letters.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
              for b in range(256))
FOUND = "n_words long, found array<struct<word:long,label:string,base:boolean>>, " \
        "expressions array<string>, score double"


@lru_cache(maxsize=4)
def automaton(phrases: tuple[tuple[str, str, bool], ...]):
    import ahocorasick

    made = ahocorasick.Automaton()
    for phrase, label, base in phrases:
        made.add_word(f" {phrase} ", (len(phrase) + 2, label, base))
    made.make_automaton()
    return made


def all_phrases() -> tuple[tuple[str, str, bool], ...]:
    return (*((p, label, True) for p, label in BASE.items()),
            *((p, label, False) for p, label in NOTICES.items()), (TAG, "", False))


def read_parts(text: str, start: int) -> list[str]:
    """The parts of the expression at `start`: as far as operands and operators take turns."""
    parts, wants_operand, depth = [], True, 0
    while match := PART.match(text, start):
        part = match[1]
        if part == ")":
            if wants_operand or not depth:
                break
            depth -= 1
        elif part == "(":
            if not wants_operand:
                break
            depth += 1
        elif part.lower() in BINDING:
            if wants_operand:
                break
            wants_operand = True
        elif wants_operand:
            wants_operand = False
        else:
            break
        parts.append(part)
        start = match.end()
    return parts


def postfix(parts: list[str]) -> list[str] | None:
    """Shunting-yard; None if an operand or a bracket is missing."""
    out, waiting, before = [], [], None
    for part in parts:
        low = part.lower()
        if low in BINDING:
            while waiting and waiting[-1] != "(" and BINDING[waiting[-1]] >= BINDING[low]:
                out.append(waiting.pop())
            waiting.append(low)
        elif part == "(":
            waiting.append(part)
        elif part == ")":
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        else:
            out.append(low)
        before = part
    if before is None or before == "(" or before.lower() in BINDING or "(" in waiting:
        return None
    return out + waiting[::-1]


def freedom(label: str) -> float:
    """By the longest known beginning of the label; nothing is known of others."""
    known = [name for name in FREEDOM if label == name or label.startswith(name + "-")]
    return FREEDOM[max(known, key=len)] if known else 0.0


def evaluate(order: list[str]) -> tuple[float, list[str]]:
    """How freely the text may be used, and the licences (and exceptions) named."""
    stack, labels = [], []
    for part in order:
        if part not in BINDING:
            stack.append(freedom(part))
            labels.append(part)
            continue
        right, left = stack.pop(), stack.pop()
        stack.append(max(left, right) if part == "or" else min(left, right) if part == "and"
                     else min(1.0, left + EXCEPTION))
    return stack[0], labels


def scan(text: bytes, phrases: tuple[tuple[str, str, bool], ...]) -> tuple:
    words = text.translate(WORDS).split()
    joined = " " + b" ".join(words).decode() + " "
    found, expressions, values, tagged = [], [], [], False
    at = place = 0
    for end, (length, label, base) in automaton(phrases).iter(joined):
        start = end + 1 - length
        if not label:
            tagged = True
            continue
        # Matches come by their ends, so a start can lie before the last one.
        place += joined.count(" ", at, start) if start >= at else -joined.count(" ", start, at)
        at = start
        found.append({"word": place, "label": label, "base": base})
        values.append(freedom(label))
    if tagged:
        raw = text.decode()
        for match in RAW_TAG.finditer(raw):
            parts = read_parts(raw, match.end())
            order = postfix(parts)
            if order:
                value, labels = evaluate(order)
                expressions.append(" ".join(parts))
                values.append(value)
                place = len(raw[:match.start()].encode().translate(WORDS).split())
                found += [{"word": place, "label": one, "base": False} for one in labels]
    return len(words), found, expressions, min(values, default=0.0)


def scan_column(text: str):
    """Struct column of FOUND; null is the empty text."""
    def scan_texts(texts: pa.Array) -> pa.Array:
        phrases = all_phrases()
        rows = [scan(t, phrases) for t in
                pc.fill_null(texts, "").cast(pa.large_binary()).to_pylist()]
        n, found, expressions, score = zip(*rows) if rows else ((), (), (), ())
        one = pa.struct([("word", pa.int64()), ("label", pa.string()), ("base", pa.bool_())])
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(found, pa.list_(one)),
             pa.array(expressions, pa.list_(pa.string())), pa.array(score, pa.float64())],
            ["n_words", "found", "expressions", "score"])

    return F.arrow_udf(scan_texts, FOUND)(F.col(text).cast("string"))


def scan_licences(docs: DataFrame, text: str = "text") -> DataFrame:
    """Struct `doc` (the input row), `n_words`, `found` (place in words, label, whether a phrase of
    the base), `expressions` and `score` for every row.

    The score is that of the least free finding, 0 without any: a text that says nothing grants
    nothing. An expression goes as far as operands and operators take turns; one that does not
    parse (an operand or a bracket is missing) is left out. Unknown names score 0. Null texts are
    empty. Repeated rows are scanned each, no rows give no rows, and input columns stay inside
    `doc`, so their names cannot clash. A very long text is scanned whole, its words in memory.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       scan_column(text).alias("s")).select(
        "doc", "s.n_words", "s.found", "s.expressions", "s.score")


def _labels(found) -> F.Column:
    return F.array_join(F.sort_array(F.array_distinct(F.transform(found, lambda x: x["label"]))),
                        ",")


@query("op6_licences")
def op6(spark, sf_dir):
    found = scan_licences(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("found", lambda x: x["base"])
    places = F.transform(base, lambda x: x["word"])
    return found.select(
        "doc.doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        _labels(base).alias("base_labels"), _labels(F.col("found")).alias("labels"), "score")
