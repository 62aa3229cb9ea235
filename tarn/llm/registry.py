"""All queries of this package, by name, and their SQL."""

from __future__ import annotations

import importlib

#: Modules that hold QUERIES and SQL.
MODULES = ("secrets", "bpe", "media", "jaccard", "packing", "token_counts", "chat", "language", "suffixes", "quality", "manifest", "search", "licenses")


def _all(what: str) -> dict:
    return {k: v for m in MODULES for k, v in getattr(importlib.import_module(f"{__package__}.{m}"), what).items()}


def queries() -> dict:
    return _all("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _all("SQL")
