"""The queries of this package: importing the operators registers them."""

from millrace.llm import (  # noqa: F401
    byte_bpe, collocations, language_model, licences, mixing, pieces, quality_rules, resampling,
    sharding, simhash, token_counts, topk, urls,
)
from millrace.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
