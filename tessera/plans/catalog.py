"""The registry of queries (Spark) and their SQL oracles (DuckDB)."""

from __future__ import annotations

import importlib

_MODULES = ("grades_q", "text_q", "importer_q", "identity_q", "payroll_q", "library_q", "academics_q", "web_q", "sources_q", "streaming_q")


def _collect(attr: str) -> dict:
    out: dict = {}
    for m in _MODULES:
        mod = importlib.import_module(f"tessera.plans.{m}")
        for k, v in getattr(mod, attr).items():
            if k in out:
                raise ValueError(f"duplicate query name {k}")
            out[k] = v
    return out


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict:
    return _collect("ORACLE")
