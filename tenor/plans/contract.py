"""Registered queries and their DuckDB oracles.

Every query reads the driver tables under ``sf_dir`` (through the bindings)
and returns a DataFrame whose column names equal its oracle's. Floating
outputs are rounded to 6 digits in both; decisions (thresholds) are taken on
unrounded values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# key -> why there is no SQL oracle (the driver then checks rows only)
NO_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, why_no_sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        else:
            NO_ORACLE[name] = why_no_sql or "not expressible in SQL"
        return fn
    return deco


def r6(col) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c, 6)


def load_all() -> None:
    """Import every module that registers queries."""
    from tenor.plans import queries_corpus, queries_scoring, queries_learn, queries_sources  # noqa: F401
    from tenor.streaming import queries_stream  # noqa: F401
