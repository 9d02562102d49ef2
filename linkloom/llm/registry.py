"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from linkloom.llm import chunk_dedup, decontaminate, language_id, line_dedup, mixing, quality, secrets, simhash_dedup, suffix_dedup, voronoi_knn

_MODULES = (decontaminate, line_dedup, chunk_dedup, secrets, mixing, language_id, suffix_dedup, simhash_dedup, quality, voronoi_knn)


def queries() -> dict:
    return {name: f for m in _MODULES for name, f in vars(m).items() if name.startswith("op") and name[2:3].isdigit() and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _MODULES for k, v in getattr(m, "SQL", {}).items()}
