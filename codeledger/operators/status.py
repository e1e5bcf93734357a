"""Run status from the execution log, and the inventory update it leads to."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeledger.functions.scalars import as_timestamp


def rollup_status(log: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """(run_id, repo_id, status, comment) per run and repository.

    ``PROCESSING`` rows do not count.  Without other rows the status is ERROR;
    any FAILURE wins; all SUCCESS is SUCCESS; anything else is UNKNOWN.
    ``targets`` (run_id, repo_id) adds repositories that left no log row.
    """
    counted = F.col("status") != "PROCESSING"
    seen = log.groupBy("run_id", "repo_id").agg(
        F.count_if(counted).alias("n"),
        F.count_if(F.col("status") == "FAILURE").alias("failed"),
        F.count_if(F.col("status") == "SUCCESS").alias("succeeded"),
    )
    if targets is not None:
        wanted = targets.select("run_id", "repo_id").distinct()
        seen = wanted.join(seen, ["run_id", "repo_id"], "left").na.fill(0, ["n", "failed", "succeeded"])
    passed = (F.col("failed") == 0) & (F.col("succeeded") == F.col("n"))
    return status_of(seen, F.col("n") == 0, F.col("failed") > 0, passed)


def status_of(seen: DataFrame, none: Column, failed: Column, passed: Column) -> DataFrame:
    """(run_id, repo_id, status, comment) from whether no row counts, one failed, all succeeded."""
    status = F.when(none, "ERROR").when(failed, "FAILURE").when(passed, "SUCCESS").otherwise("UNKNOWN")
    comment = F.when(none, "No analysis records.").when(passed, "All steps completed.")
    return seen.select("run_id", "repo_id", status.alias("status"), comment.alias("comment"))


def update_inventory_status(
    inventory: DataFrame, rollup: DataFrame, updated_on: datetime | str | Column
) -> DataFrame:
    """Inventory with the statuses of one run; a missing comment keeps the old one."""
    new = rollup.select(
        "repo_id", F.col("status").alias("_status"), F.col("comment").alias("_comment"), F.lit(True).alias("_hit")
    )
    joined = inventory.join(new, "repo_id", "left")
    changed = {
        "status": F.when(F.col("_hit"), F.col("_status")).otherwise(F.col("status")),
        "comment": F.coalesce("_comment", "comment"),
        "updated_on": F.when(F.col("_hit"), as_timestamp(updated_on)).otherwise(F.col("updated_on")),
    }
    return joined.select(*[changed.get(c, F.col(c)).alias(c) for c in inventory.columns])


def execution_log_rows(
    outcomes: DataFrame,
    method_name: str,
    stage: str | Column,
    run_id: str,
    executed_at: datetime | str | Column,
) -> DataFrame:
    """Log rows for (repo_id, message, error, duration); an error makes a FAILURE."""
    stage = stage if isinstance(stage, Column) else F.lit(stage)
    failed = F.col("error").isNotNull()
    return outcomes.select(
        F.lit(method_name).alias("method_name"),
        stage.alias("stage"),
        F.lit(run_id).alias("run_id"),
        "repo_id",
        F.when(failed, "FAILURE").otherwise("SUCCESS").alias("status"),
        F.coalesce("error", "message").alias("message"),
        as_timestamp(executed_at).alias("execution_time"),
        F.col("duration").cast("double").alias("duration"),
    )
