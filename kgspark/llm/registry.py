"""Queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kgspark.llm import (
    op1_decontamination,
    op2_quality,
    op3_mixing,
    op4_pii,
    op5_ngram_join,
    op6_language_model,
    op7_chat,
    op8_line_dedup,
    op9_host_rules,
    op10_sharding,
    op11_token_counts,
    op12_phrases,
    op13_divergence,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination.query,
    "op2_quality": op2_quality.query,
    "op3_mixing": op3_mixing.query,
    "op4_pii": op4_pii.query,
    "op5_ngram_join": op5_ngram_join.query,
    "op6_language_model": op6_language_model.query,
    "op7_chat": op7_chat.query,
    "op8_line_dedup": op8_line_dedup.query,
    "op9_host_rules": op9_host_rules.query,
    "op10_sharding": op10_sharding.query,
    "op11_token_counts": op11_token_counts.query,
    "op12_phrases": op12_phrases.query,
    "op13_divergence": op13_divergence.query,
}

ORACLE_SQL: dict[str, str] = {"op7_chat": op7_chat.SQL, "op9_host_rules": op9_host_rules.SQL, "op12_phrases": op12_phrases.SQL, "op13_divergence": op13_divergence.SQL}
