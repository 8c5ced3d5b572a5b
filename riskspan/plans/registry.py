"""Driver query registry: Spark query per operator + DuckDB oracle text.

Each query reads the driver tables through the adapter views in
``fixtures`` (or the tables directly) and runs one operator or job of the
library over them; ``oracle`` holds an independent SQL text for DuckDB that
must give the same rows.  Column names match on both sides.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from riskspan.plans import (q_core, q_clean, q_cohorts, q_cvss, q_joins,  # noqa: F401
                                q_files, q_sources, q_stats)
