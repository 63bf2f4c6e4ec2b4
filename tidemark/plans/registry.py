"""Collects every registered query and its oracle SQL."""

from __future__ import annotations

import importlib

MODULES = ["snapshot", "relational", "changes_quality", "privacy_logs", "ml_udf", "io_layout", "streams", "guards"]


def _modules():
    return [importlib.import_module(f"tidemark.plans.{m}") for m in MODULES]


def all_queries() -> dict:
    out = {}
    for m in _modules():
        out.update(m.QUERIES)
    return out


def all_sql() -> dict:
    out = {}
    for m in _modules():
        out.update(m.SQL)
    return out
