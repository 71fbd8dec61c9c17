"""The queries of this subpackage, and SQL where SQL can express them."""

from __future__ import annotations

from importlib import import_module

MODULES = ("jaccard", "decontaminate", "mixing", "pages", "quality", "language_model", "secrets", "token_counts", "sharding", "neighbours", "lloyd", "suffixes", "filter_audit")


def queries() -> dict:
    return {k: f for m in MODULES for k, f in import_module(f"loomline.llm.{m}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for m in MODULES for k, q in import_module(f"loomline.llm.{m}").ORACLE.items()}
