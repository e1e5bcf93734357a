"""Keyed merges: what a table holds after new rows arrive."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeledger.operators.lists import keep_first


def replace_by_key(
    existing: DataFrame,
    new: DataFrame,
    processed: DataFrame | None = None,
    on_empty: str = "clear",
    key: str = "repo_id",
) -> DataFrame:
    """All rows of a replaced key go, the new ones come.

    ``on_empty="clear"`` replaces every key in ``processed``, also those with no
    new row; ``"keep"`` replaces only keys that have new rows.
    """
    if on_empty not in ("clear", "keep"):
        raise ValueError("on_empty is 'clear' or 'keep'")
    source = new if on_empty == "keep" or processed is None else processed
    replaced = source.select(key).distinct()
    return existing.join(replaced, key, "left_anti").unionByName(new.select(*existing.columns))


def insert_ignore(
    existing: DataFrame, new: DataFrame, key: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """``existing`` plus the new rows whose unique key is not there yet.

    As in SQL a NULL in the key never equals anything, so such rows are always
    added; ``null_safe`` treats NULLs as equal.
    """
    new = new.select(*existing.columns)
    rest = [c for c in new.columns if c not in key]
    if null_safe:
        fresh = _first_of_key(new, key, rest)
        old = existing.select(*[F.col(k).alias(f"_{k}") for k in key])
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
        return existing.unionByName(fresh.join(old, same, "left_anti"))
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    keyed = _first_of_key(new.where(~has_null), key, rest)
    fresh = keyed.join(existing.select(*key), list(key), "left_anti").select(*existing.columns)
    return existing.unionByName(fresh).unionByName(new.where(has_null))


def _first_of_key(rows: DataFrame, key: Sequence[str], rest: Sequence[str]) -> DataFrame:
    return keep_first(rows, list(key), list(rest)) if rest else rows.distinct()


def upsert(existing: DataFrame, new: DataFrame, key: str = "repo_id") -> DataFrame:
    """New rows win over the rows of the same key."""
    return replace_by_key(existing, new, on_empty="keep", key=key)


def last_writer_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row by ``order`` per key, as repeated assignment to a mapping keeps."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
    return best.select(*keys, *[F.col("_last").getField(c).alias(c) for c in rest]).select(*rows.columns)
