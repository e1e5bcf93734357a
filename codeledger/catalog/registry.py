"""Named queries over the driver tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from codeledger.sources.tables import read_table, spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """``t.orders`` reads ``<sf_dir>/orders.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self._dir}/{name}.parquet")

    def wide(self, name: str) -> DataFrame:
        """A table for jobs heavy per row: at least one partition per core."""
        return spread(getattr(self, name))


def query(name: str, sql: str | None = None):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name``."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register
