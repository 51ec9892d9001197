"""Registry of named queries: ``QUERIES[key](spark, sf_dir) -> DataFrame`` and
``ORACLE[key]`` = DuckDB SQL over the same tables (absent for rows-only checks)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

_MODULES = (
    "riskloom.plans.alerting",
    "riskloom.plans.metrics",
    "riskloom.plans.profiling",
    "riskloom.plans.rowfeatures",
    "riskloom.plans.fitted",
    "riskloom.plans.explaining",
    "riskloom.plans.readside",
    "riskloom.plans.screening",
    "riskloom.plans.derivation",
    "riskloom.plans.modeling",
    "riskloom.plans.anomalies",
    "riskloom.plans.reports",
    "riskloom.plans.documents",
    "riskloom.plans.chain",
)


def query(key: str, sql: str | None = None):
    """Register ``fn`` under ``key`` with its oracle SQL (None: rows-only check)."""

    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(m)
