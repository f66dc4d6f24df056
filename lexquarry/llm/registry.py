"""Queries and SQL of this subpackage, collected for ``__spark_entry__.py``."""

from __future__ import annotations

from importlib import import_module

MODULES = ("secrets", "wavelet", "decontaminate", "html", "pieces", "warc", "jpeg", "toxicity", "neardup", "pii", "variants", "periodic", "adaptive")


def queries() -> dict:
    found: dict = {}
    for name in MODULES:
        found |= import_module(f"{__package__}.{name}").QUERIES
    return found


def oracle_sql() -> dict:
    found: dict = {}
    for name in MODULES:
        found |= getattr(import_module(f"{__package__}.{name}"), "ORACLE_SQL", {})
    return found
