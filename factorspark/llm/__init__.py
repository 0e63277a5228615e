"""Operators for preparing training text; nothing else in the library imports this folder."""

from .common import ORACLES, QUERIES
from . import (  # noqa: F401
    chat_format, decontaminate, exact_dedup, filter_audit, hard_negatives, line_dedup, lm_score, ngram_join, packing,
    substring_dedup, token_counts, toxicity, warc)

__all__ = ["QUERIES", "ORACLES"]
