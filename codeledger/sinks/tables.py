"""Parquet tables with keyed, repeatable writes whose cost is that of the batch.

A table is a row of immutable batches.  Every write adds one: its rows, the keys
it replaces, and last a commit mark.  A row is visible when its batch is
committed and no later batch replaces its key.  Nothing is rewritten, so a
write touches no other key, a failed write leaves the table as it was, and a
reader never sees half of one.  ``compact`` folds the batches into one.

One writer at a time; readers may run beside it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeledger.operators.keyed import insert_ignore

BATCH, SINCE = "_batch", "_since"
COMMIT = "label string, replaces boolean, first long"


class KeyedTable:
    """A table of batches; ``schema`` is Spark DDL with the column ``key``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str = "repo_id") -> None:
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key

    # --- reading ------------------------------------------------------------

    def read(self) -> DataFrame:
        """All visible rows, as of the commits there are now."""
        commits = self._commits()
        if not commits:
            return self._empty()
        first = max(c["first"] for c in commits)
        numbers = [c[BATCH] for c in commits if c[BATCH] >= first]
        rows = self._load("rows", f"{self.schema}, {BATCH} long").where(self._committed(numbers))
        replacing = [c[BATCH] for c in commits if c["replaces"] and c[BATCH] > first]
        if replacing:
            keys = self._load("keys", f"{self._key_ddl()}, {BATCH} long").where(self._committed(replacing))
            since = keys.groupBy(self.key).agg(F.max(BATCH).alias(SINCE)).withColumnRenamed(self.key, "_key")
            # every key once: the pointers are small beside the rows, and adaptive
            # execution broadcasts them or splits a key with very many rows
            joined = rows.join(since, F.col(self.key).eqNullSafe(F.col("_key")), "left")
            rows = joined.where(F.col(SINCE).isNull() | (F.col(BATCH) >= F.col(SINCE)))
        return rows.select(*self._empty().columns)

    def _load(self, part: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{part}")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], schema)

    def _committed(self, numbers: Sequence[int]):
        """Batches between the first and the last of ``numbers``, without those that failed."""
        known, low, high = set(numbers), min(numbers), max(numbers)
        condition = F.col(BATCH).between(low, high)
        failed = [n for n in range(low, high + 1) if n not in known]
        return condition & ~F.col(BATCH).isin(failed) if failed else condition

    def _commits(self) -> list:
        """One row per batch since the last compaction, on the driver."""
        rows = self._load("commits", f"{COMMIT}, {BATCH} long").collect()
        return sorted(rows, key=lambda c: c[BATCH])

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def _key_ddl(self) -> str:
        return f"{self.key} {self._empty().schema[self.key].dataType.simpleString()}"

    # --- writing ------------------------------------------------------------

    def _shape(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self._empty().schema])

    def _keys(self, rows: DataFrame) -> DataFrame:
        return rows.select(F.col(self.key).cast(self._empty().schema[self.key].dataType).alias(self.key)).distinct()

    def _done(self, label: str | None) -> bool:
        return label is not None and any(c["label"] == label for c in self._commits())

    def _next(self) -> int:
        return max((c[BATCH] for c in self._commits()), default=-1) + 1

    def _put(self, part: str, number: int, rows: DataFrame) -> DataFrame:
        path = f"{self.path}/{part}/{BATCH}={number}"
        rows.write.mode("overwrite").parquet(path)  # a failed attempt's files go
        return self.spark.read.schema(rows.schema).parquet(path)

    def _commit(self, number: int, label: str | None, replaces: bool, first: int) -> None:
        mark = self.spark.createDataFrame([(label or uuid.uuid4().hex, replaces, first)], COMMIT)
        self._put("commits", number, mark.coalesce(1))

    def _first(self) -> int:
        return max((c["first"] for c in self._commits()), default=0)

    def replace(
        self, new: DataFrame, processed: DataFrame | None = None, on_empty: str = "clear", label: str | None = None
    ) -> None:
        """Replace all rows of the processed keys by ``new``.

        ``on_empty="clear"`` also empties processed keys without a new row,
        ``"keep"`` leaves those as they were.  A key of ``new`` is always
        replaced, processed or not.  ``new`` is computed once.  A ``label`` that is
        committed already makes the call do nothing, so a repeated batch is safe.
        """
        if on_empty not in ("clear", "keep"):
            raise ValueError("on_empty is 'clear' or 'keep'")
        if self._done(label):
            return
        number = self._next()
        keys = self._keys(self._put("rows", number, self._shape(new)))
        if on_empty == "clear" and processed is not None:
            keys = keys.union(self._keys(processed)).distinct()
        self._put("keys", number, keys)
        self._commit(number, label, True, self._first())

    def upsert(self, new: DataFrame, label: str | None = None) -> None:
        self.replace(new, on_empty="keep", label=label)

    def append(self, rows: DataFrame, label: str | None = None) -> None:
        if self._done(label):
            return
        number = self._next()
        self._put("rows", number, self._shape(rows))
        self._commit(number, label, False, self._first())

    def insert_ignore(self, new: DataFrame, unique: Sequence[str], null_safe: bool = False, label: str | None = None) -> None:
        """Append the rows whose unique key is not stored yet; ``unique`` holds the table key."""
        if self.key not in unique:
            raise ValueError(f"the unique key must include {self.key}")
        if self._done(label):
            return
        existing = self.read().select(*unique)
        fresh = insert_ignore(self._empty(), self._shape(new), unique, null_safe)
        if null_safe:
            old = existing.select(*[F.col(c).alias(f"_{c}") for c in unique])
            same = F.lit(True)
            for c in unique:
                same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
            fresh = fresh.join(old, same, "left_anti")
        else:
            fresh = fresh.join(existing, list(unique), "left_anti")
        self.append(fresh.select(*self._empty().columns), label)

    def compact(self) -> None:
        """Write the visible rows as one batch that stands for all before it.

        Earlier batches stay on disk, unread, until ``path`` is cleaned by its owner.
        """
        number = self._next()
        self._put("rows", number, self.read())
        self._commit(number, None, False, number)


class DerivedTable:
    """A table recomputed as a whole: versions in folders, and a mark for the current one."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _versions(self) -> list[str]:
        try:
            rows = self.spark.read.schema("version string, number long").parquet(f"{self.path}/current").collect()
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return []
        return [r["version"] for r in sorted(rows, key=lambda r: r["number"])]

    def refresh(self, df: DataFrame) -> None:
        """Write ``df`` beside the versions there are; readers see it when it is whole."""
        version, known = uuid.uuid4().hex, self._versions()
        df.write.parquet(f"{self.path}/versions/{version}")
        mark = self.spark.createDataFrame([(version, len(known))], "version string, number long")
        mark.coalesce(1).write.mode("append").parquet(f"{self.path}/current")

    def read(self) -> DataFrame:
        versions = self._versions()
        if not versions:
            raise FileNotFoundError(f"{self.path} has no version yet")
        return self.spark.read.parquet(f"{self.path}/versions/{versions[-1]}")
