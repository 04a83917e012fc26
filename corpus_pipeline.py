"""A corpus pipeline over `documents`: what fails the quality rules goes, one document of each group
of near copies stays, the rest is mixed to target weights, and the mix is encoded.

Every stage takes an empty table to an empty one and ignores other columns. A null text counts as an
empty one, which fails the quality rules. Repeated rows are copies: one of them stays. A very long
text is worked whole. A null source or language is a host or a leaf of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import materialize, set_up, table
from millrace.llm.mixing import WEIGHTS, corpus_levels, mix_sources
from millrace.llm.pieces import default_model, sentencepiece_encode
from millrace.llm.quality_rules import quality_rules
from millrace.llm.simhash import drop_near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality rules reject."""
    set_up(spark)
    return quality_rules(docs).where("kept").select("doc.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest id of each group of near copies (five-word shingles,
    similarity of 0.8 or more)."""
    set_up(spark)
    return drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Share all tokens anew by the weights of domain, language and source; a document that is read
    in two epochs comes twice."""
    set_up(spark)
    return mix_sources(docs, corpus_levels(), WEIGHTS).select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids (packed little-endian unsigned 32-bit numbers), and whether they decode to the text."""
    set_up(spark)
    coded = sentencepiece_encode(docs, default_model())
    said = F.translate(F.coalesce("doc.text", F.lit("")), "▁", " ")
    return coded.select("doc.doc_id", "doc.lang", "doc.source",
                        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                        (F.col("decoded") == said).alias("round_trip"))


STAGES = [("quality rules", quality), ("SimHash near-dedup", near_copies),
          ("mixing to target weights", mix), ("SentencePiece encoding", encode)]
#: The fingerprints are no SQL; tests/llm/test_pipeline.py has a plain version of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table, each written and read again before the next."""
    docs = table(set_up(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
