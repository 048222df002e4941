"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from geoincident.llm import (benchmark_index, chat_trees, collocations, conversation_repair, embedding_dedup, language_ppm,
                             line_alignment, lm_backoff, ngram_join, piece_encoding, secret_ownership, source_mixing, token_repair)

_MODULES = (embedding_dedup, ngram_join, language_ppm, source_mixing, token_repair, secret_ownership, lm_backoff,
            chat_trees, line_alignment, benchmark_index, piece_encoding, conversation_repair, collocations)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every ``opN_<name>`` function of the operator modules."""
    return {name: getattr(module, name) for module in _MODULES for name in vars(module)
            if name.startswith("op") and name[2:3].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {name: text for module in _MODULES for name, text in getattr(module, "SQL", {}).items()}
