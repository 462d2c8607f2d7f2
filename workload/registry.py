"""Where the query modules register their entries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its oracle SQL."""
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def rnd(value, digits: int = 6) -> Column:
    """Round for comparison; adding 0.0 turns a negative zero into zero."""
    c = F.col(value) if isinstance(value, str) else value
    return F.round(c, digits) + F.lit(0.0)


def srnd(value: str, digits: int = 6) -> str:
    """The same in SQL."""
    return f"(round({value}, {digits}) + 0.0)"
