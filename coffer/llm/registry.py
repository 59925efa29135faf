"""The corpus operators' queries and their SQL."""

from __future__ import annotations

from coffer.llm import (
    code_compression, embedding_whitening, exact_dedup, kd_sharding, license_scan, line_dedup, near_dedup, quality_ranking,
    repetition_rules, retrieval_packing, source_mixing, token_counts, toxicity_neighbours,
)

MODULES = (
    exact_dedup, near_dedup, kd_sharding, retrieval_packing, quality_ranking, toxicity_neighbours, line_dedup,
    source_mixing, repetition_rules, token_counts, license_scan, code_compression, embedding_whitening,
)


def queries() -> dict:
    return {name: f for module in MODULES for name, f in vars(module).items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in getattr(module, "SQL", {}).items()}
