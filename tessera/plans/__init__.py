"""Composed jobs. Each module exposes ``QUERIES`` (name → fn(spark, sf_dir))
and ``ORACLE`` (name → DuckDB SQL over the driver's tables)."""

from __future__ import annotations

import importlib

MODULES = ("kpi", "rtp", "quality", "reports", "reconcile", "config", "codecs", "corpus", "stages", "streams")


def registry() -> tuple[dict, dict]:
    queries: dict = {}
    oracle: dict = {}
    for name in MODULES:
        mod = importlib.import_module(f"{__name__}.{name}")
        dup = set(queries) & set(mod.QUERIES)
        if dup:
            raise ValueError(f"duplicate query names: {sorted(dup)}")
        queries.update(mod.QUERIES)
        oracle.update(mod.ORACLE)
    return queries, oracle
