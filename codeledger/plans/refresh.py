"""Refresh of derived tables by change propagation: what has changed is recomputed, the rest is carried over."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeledger.session import checkpointed
from codeledger.sinks.tables import DerivedTable

STATE, REFRESH = "_state", "_refresh"


def input_states(inputs: Mapping[str, DataFrame], key: str = "repo_id") -> DataFrame:
    """(key, _state): a digest of all rows that the inputs hold of a key; rows of a null key are left out.

    Only hashes are shuffled, summed up before they are: the order of rows does not count, how often a row comes does.
    """
    hashed = [
        df.where(F.col(key).isNotNull()).select(key, F.xxhash64(F.lit(name), *sorted(df.columns)).cast("decimal(38,0)").alias("h"))
        for name, df in inputs.items()
    ]
    summed = reduce(DataFrame.union, hashed).groupBy(key).agg(F.sum("h").alias("s"), F.count(F.lit(1)).alias("n"))
    return summed.select(key, F.xxhash64("s", "n").alias(STATE))


@dataclass
class IncrementalTable:
    """A derived table with a row or more per key, built from inputs that share the key.

    ``build`` must compute the rows of a key from the inputs' rows of that key.  ``table`` keeps the versions;
    stored rows carry the state of their inputs and the number of the refresh that computed them.
    """

    table: DerivedTable
    build: Callable[[Mapping[str, DataFrame]], DataFrame]
    key: str = "repo_id"

    def refresh(self, inputs: Mapping[str, DataFrame]) -> int:
        """Bring the table up to date; returns how many keys were recomputed.

        Inputs are read once for their states.  The changed keys are written, so that the joins which keep
        them in the inputs, and drop them from the rows before, are planned with their number: few are broadcast, and the
        inputs' other rows stay where they are.
        """
        before = self._stored()
        states = input_states(inputs, self.key)
        number = 0
        if before is None:
            changed = states.select(self.key, F.lit(True).alias("_there"), STATE)
        else:
            number = (before.agg(F.max("_last")).first()[0] or 0) + 1
            old = before.select(F.col(self.key).alias("_key"), F.col(STATE).alias("_old")).distinct()
            both = states.join(old, F.col(self.key) == F.col("_key"), "full_outer").where(~F.col(STATE).eqNullSafe(F.col("_old")))
            changed = both.select(F.coalesce(self.key, "_key").alias(self.key), F.col(STATE).isNotNull().alias("_there"), STATE)
        changed = checkpointed(changed)
        there = changed.where("_there").select(self.key, STATE)
        keys = there.select(self.key)
        rows = self.build({name: df.join(keys, self.key, "left_semi") for name, df in inputs.items()})
        rows = rows.join(there, self.key).withColumn(REFRESH, F.lit(number))
        if before is not None:
            kept = before.drop("_last").join(changed.select(self.key), self.key, "left_anti")
            rows = rows.unionByName(kept.select(*rows.columns))
        self.table.refresh(rows.withColumn("_last", F.lit(number)))
        return keys.count()

    def _stored(self) -> DataFrame | None:
        try:
            return self.table.read()
        except FileNotFoundError:
            return None

    def read(self, with_refresh: bool = False) -> DataFrame:
        """The rows; ``with_refresh`` adds ``_refresh``, the number from 0 of the refresh that computed each."""
        return self.table.read().drop(STATE, "_last", *([] if with_refresh else [REFRESH]))
