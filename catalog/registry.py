"""Registration of queries with their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from haulmark.session import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF_TASK = "2001-06-15"
AS_OF_SCAN = "2024-01-20 00:00:00"


def query(name: str, oracle: str | None = None):
    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return keep


def with_hot_keys(name: str, fn, limit: int) -> None:
    """Register the query once more with keys of ``limit`` rows treated as hot, so that their path runs on test data."""
    query(f"{name}_hot", ORACLES[name])(lambda spark, sf: fn(spark, sf, hot=limit))


def workdir(spark: SparkSession) -> str:
    """A fresh folder below the shared folder of the session."""
    return new_folder(spark)
