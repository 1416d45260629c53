"""Registered queries: each name maps to a Spark callable ``(spark, sf_dir) -> DataFrame``
and, where SQL can express it, the DuckDB oracle text over the driver's views.

Double columns are rounded to 6 decimals on both sides (engine-independent compare).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.expr import round_doubles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
HEADLINE: list[str] = []


def register(name: str, sql: str | None = None, headline: bool = False, rounding: bool = True):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return round_doubles(df) if rounding else df
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        if headline:
            HEADLINE.append(name)
        return fn
    return deco


def r6(expr: str, alias: str | None = None) -> str:
    """SQL: round a double expression to 6 decimals."""
    return f"round({expr}, 6) AS {alias or expr}"


def load_all() -> None:
    from . import (features, profile, prep, evaluation, scoring, monitoring, runs, sources, streams, training)  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
