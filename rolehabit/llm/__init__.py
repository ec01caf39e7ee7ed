"""Operators for preparing training data, and the queries that apply them."""

from rolehabit.llm import (  # noqa: F401
    collocations,
    forest,
    hard_negatives,
    licences,
    main_text,
    mixing,
    near_vectors,
    ngram_join,
    pii,
    quality,
    segmentation,
    sharding,
    token_counts,
)
from rolehabit.llm.common import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
