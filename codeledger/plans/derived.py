"""Derived tables: combined repository metrics and component mapping."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeledger.functions.scalars import size_class
from codeledger.operators.selection import main_languages, number_batches, select_repositories


def combined_repo_metrics(
    inventory: DataFrame, metrics: DataFrame, languages: DataFrame, cloc: DataFrame
) -> DataFrame:
    """Inventory with git metrics, main language and size class; one row per repository."""
    loc = cloc.groupBy("repo_id").agg(F.sum("code").alias("_loc"))
    return (
        inventory.join(metrics.drop("updated_at"), "repo_id", "left")
        .join(main_languages(languages).select("repo_id", "main_language"), "repo_id", "left")
        .join(loc, "repo_id", "left")
        .select(
            "repo_id",
            "host_name",
            "activity_status",
            "status",
            "tc",
            "main_language",
            size_class(F.col("repo_size_bytes"), F.col("_loc")).alias("classification_label"),
            "app_id",
            F.col("number_of_contributors").cast("int").alias("number_of_contributors"),
            "clone_url_ssh",
            F.col("updated_on").alias("updated_at"),
        )
    )


def with_inventory_columns(selected: DataFrame, inventory: DataFrame) -> DataFrame:
    """Selected repositories with the inventory columns the selection lacks."""
    missing = [c for c in inventory.columns if c not in selected.columns]
    return selected.join(inventory.select("repo_id", *missing), "repo_id")


def fetch_repositories(
    combined: DataFrame, inventory: DataFrame, payload: Mapping, batch_size: int = 1000
) -> DataFrame:
    """Inventory rows of the repositories a payload selects, numbered in batches.

    ``batch_no`` counts from 1 in ``repo_id`` order, ``batch_size`` rows each:
    the pages a reader would fetch one by one, as one distributed table.
    """
    selected = select_repositories(combined, payload, ordered=False)
    full = with_inventory_columns(selected, inventory).select(*inventory.columns)
    return number_batches(full, batch_size)


def component_repositories(components: DataFrame, inventory: DataFrame) -> DataFrame:
    """Components with the repository of the same project key and slug."""
    repos = inventory.select("project_key", "repo_slug", "repo_id", "repo_name", "app_id", "host_name")
    return components.join(repos, ["project_key", "repo_slug"])
