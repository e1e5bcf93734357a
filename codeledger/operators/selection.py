"""Choosing repositories: payload filter, projection, ordering, batches, pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codeledger.functions.patterns import literal_map
from codeledger.functions.scalars import language_is
from codeledger.session import checkpointed

# The columns a payload may filter on.
FILTER_COLUMNS = [
    "repo_id",
    "host_name",
    "activity_status",
    "status",
    "tc",
    "main_language",
    "classification_label",
    "app_id",
    "number_of_contributors",
]


def _like_pattern(value: str) -> str:
    """A LIKE pattern whose backslashes only escape what Spark lets them escape."""
    out, i = [], 0
    while i < len(value):
        if value[i] == "\\" and i + 1 < len(value):
            nxt = value[i + 1]
            out.append("\\" + nxt if nxt in "%_\\" else nxt)
            i += 2
        else:
            out.append(value[i])
            i += 1
    return "".join(out)


def payload_condition(payload: Mapping) -> Column:
    """The predicate a selection payload stands for.

    Accepts ``{...}`` or ``{"payload": {...}}``.  Text lists match any case,
    other lists match as they are, ``repo_id`` matches its first value as a
    substring (``%`` and ``_`` are wildcards).  Unknown keys are ignored.
    """
    if not isinstance(payload, Mapping):
        raise ValueError("Input must be a dictionary.")
    filters = payload["payload"] if "payload" in payload else payload
    if not isinstance(filters, Mapping) or not filters:
        raise ValueError("The provided payload does not contain any filter values.")

    conditions = []
    for name in FILTER_COLUMNS:
        if name not in filters:
            continue
        values = filters[name]
        values = [values] if isinstance(values, str) else list(values or [])
        values = [v for v in values if v is not None]
        if not values:
            raise ValueError(f"Filter for '{name}' cannot be empty.")
        texts = [isinstance(v, str) for v in values]
        if name == "repo_id":
            wanted = _like_pattern(f"%{values[0]}%".lower())
            conditions.append(F.lower(name).like(wanted))
        elif all(texts):
            conditions.append(F.lower(name).isin([v.lower() for v in values]))
        elif any(texts):
            raise ValueError(f"Filter for '{name}' mixes text and other values.")
        else:
            conditions.append(F.col(name).isin(values))
    if not conditions:
        raise ValueError("No valid filters provided. Query would select all rows.")
    return reduce(lambda a, b: a & b, conditions)


def select_repositories(combined: DataFrame, payload: Mapping, ordered: bool = True) -> DataFrame:
    """Distinct repositories of ``combined_repo_metrics`` that match the payload."""
    rows = (
        combined.where(payload_condition(payload))
        .select(
            "repo_id",
            "status",
            "clone_url_ssh",
            F.col("updated_at").alias("updated_on"),
            *[c for c in FILTER_COLUMNS if c not in ("repo_id", "status")],
        )
        .distinct()
    )
    return rows.orderBy("repo_id") if ordered else rows


def number_rows(df: DataFrame, key: str = "repo_id") -> DataFrame:
    """Adds ``row_no``, 1.. in ``key`` order, without a single-task window.

    Rows are range-partitioned and sorted, and written with their partition and
    place to the checkpoint folder, so both stay fixed; each partition then
    starts at the sum of the sizes before it (one row per partition travels to
    the offset window).  ``key`` should be unique, as ``repo_id`` is in the
    inventory.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(parts, key).sortWithinPartitions(key)
    written = checkpointed(ordered.withColumn("_place", F.monotonically_increasing_id()))
    placed = written.select(
        *df.columns,
        F.shiftright("_place", 33).alias("_part"),
        F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)).alias("_index"),
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    # at most one row per partition of `ordered`
    return placed.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + F.col("_index") + 1).alias("row_no")
    )


def number_batches(df: DataFrame, batch_size: int, key: str = "repo_id") -> DataFrame:
    """Adds ``batch_no``: consecutive chunks of ``batch_size`` in ``key`` order, from 1."""
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    numbered = number_rows(df, key)
    batch = F.floor((F.col("row_no") - 1) / F.lit(batch_size)) + 1
    return numbered.select(*df.columns, batch.cast("bigint").alias("batch_no"))


def page(df: DataFrame, offset: int, limit: int, key: str = "repo_id") -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in ``key`` order; ``key`` should be unique.

    Only keys are numbered; rows are joined to the keys of the page, at any depth.
    """
    numbered = number_rows(df.select(key), key)
    wanted = numbered.where((F.col("row_no") > offset) & (F.col("row_no") <= offset + limit)).select(key)
    return df.join(wanted, key, "left_semi")


def main_languages(languages: DataFrame, order: Sequence[str] = ("language",)) -> DataFrame:
    """The language with the highest share per repository; ties go to ``order``.

    Only the best row of each partition is shuffled (partial aggregation).
    """
    rank = F.struct((-F.col("percent_usage")).alias("neg"), *order)
    best = F.min_by(F.struct("language", "percent_usage"), rank).alias("best")
    return (
        languages.groupBy("repo_id")
        .agg(best)
        .select("repo_id", F.col("best.language").alias("main_language"), "best.percent_usage")
    )


def languages_by_share(languages: DataFrame) -> DataFrame:
    return languages.orderBy("repo_id", F.desc("percent_usage"), "language")


def gate_by_language(
    repos: DataFrame,
    main_language: DataFrame,
    required: str | list[str],
    exact_top: Sequence[str] | None = None,
    top_language: DataFrame | None = None,
) -> DataFrame:
    """Repositories whose main language is one of ``required`` (any case).

    ``exact_top`` adds the second gate of the Go and JavaScript stages: the top
    language in ``top_language`` must be one of these, with exact spelling.
    """
    wanted = main_language.where(language_is(F.col("main_language"), required))
    kept = repos.join(wanted.select("repo_id"), "repo_id", "left_semi")
    if exact_top is None:
        return kept
    top = main_language if top_language is None else top_language
    exact = top.where(F.col("main_language").isin(list(exact_top)))
    return kept.join(exact.select("repo_id"), "repo_id", "left_semi")


def repository_rulesets(
    languages: DataFrame, ruleset_map: Mapping[str, str], available: Sequence[str] | None = None
) -> DataFrame:
    """Rulesets per repository: detected languages looked up in ``ruleset_map``.

    Unmapped languages and rulesets missing from ``available`` are skipped; a
    repository left with none has no row.  The map is a literal in the plan, and
    distinct pairs are formed before any list, so a list is no longer than it.
    """
    entries = [(k.lower(), v) for k, v in ruleset_map.items() if available is None or v in available]
    if not entries:
        return languages.select("repo_id").limit(0).withColumn("rulesets", F.lit(None).cast("array<string>"))
    table = literal_map(entries)
    found = (
        languages.select("repo_id", table[F.lower("language")].alias("path"))
        .where(F.col("path").isNotNull())
        .distinct()
    )
    return found.groupBy("repo_id").agg(F.array_sort(F.collect_list("path")).alias("rulesets"))

