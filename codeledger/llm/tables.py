"""Input tables, names of columns, and row counts that size a job."""

from __future__ import annotations

import os
from collections.abc import Callable
from math import ceil
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = "[^\\x20\\x09-\\x0D]+"
GAP = "[\\x20\\x09-\\x0D]+"


#: Rows of ids or limits that go to the other side of a join as a broadcast, 20 MB or so; more are joined by a shuffle.
BROADCAST_ROWS = 500_000
ROOT = str(Path(__file__).resolve().parents[2])


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver did.

    Without a shared installation, ship it with ``--py-files``.
    """
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts and 64 a row: one scan, one number to the driver."""
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 64)
    return docs.agg(size.alias("n")).first()["n"] or 0


def pieces(total: int, each: int) -> int:
    """How many pieces of about ``each`` make ``total``, at least one."""
    return max(1, ceil(total / each))


def aside(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with its columns but ``used`` under names that no operator takes, and a function that gives rows their own names back."""
    names = [c if c.lower() in used else f"_extra_{i}" for i, c in enumerate(docs.columns)]

    def back(rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(new).alias(old) for new, old in zip(names, docs.columns, strict=True)])

    return docs.toDF(*names), back


def small(written: DataFrame) -> DataFrame:
    """``written``, a stored table, to be broadcast if it has BROADCAST_ROWS rows or fewer."""
    return F.broadcast(written) if written.count() <= BROADCAST_ROWS else written


def with_fields(schema: T.StructType, new: T.StructType) -> T.StructType:
    """``schema`` with the fields of ``new`` at its end; a field of that name is replaced."""
    names = {f.name.lower() for f in new}
    return T.StructType([f for f in schema if f.name.lower() not in names] + list(new))
