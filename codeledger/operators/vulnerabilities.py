"""Two vulnerability sources merged, deduplicated and measured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeledger.functions.scalars import percent_of
from codeledger.operators.lists import keep_first


def combined_vulnerabilities(
    grype: DataFrame, trivy: DataFrame, normalize_severity: bool = False
) -> DataFrame:
    """Both sources in one shape; Trivy rows without a package are left out."""

    def severity(c: Column) -> Column:
        return F.initcap(c) if normalize_severity else c

    first = grype.select(
        "repo_id",
        "package",
        "version",
        severity(F.col("severity")).alias("severity"),
        F.col("fix_versions").alias("fix_version"),
        F.lit("Grype").alias("source"),
    )
    second = trivy.where(F.coalesce("pkg_name", F.lit("")) != "").select(
        "repo_id",
        F.col("pkg_name").alias("package"),
        F.col("installed_version").alias("version"),
        severity(F.col("severity")).alias("severity"),
        F.col("fixed_version").alias("fix_version"),
        F.lit("Trivy").alias("source"),
    )
    return first.unionByName(second)


def deduplicated_vulnerabilities(combined: DataFrame) -> DataFrame:
    """One row per package, version and severity of a repository; Grype is preferred.

    "Grype" sorts before "Trivy", and the fix version settles ties.
    """
    return keep_first(combined, ["repo_id", "package", "version", "severity"], ["source", "fix_version"])


def vulnerability_metrics(deduplicated: DataFrame, dependency_counts: DataFrame) -> DataFrame:
    """Critical count and vulnerable share per repository.

    ``dependency_counts`` holds (repo_id, n_items); the share may exceed 100.
    """
    found = deduplicated.groupBy("repo_id").agg(
        F.count(F.lit(1)).alias("vulnerability_count"),
        F.count_if(F.col("severity") == "Critical").alias("critical_count"),
    )
    deps = dependency_counts.select("repo_id", F.col("n_items").alias("_deps"))
    share = percent_of(F.col("vulnerability_count"), F.coalesce("_deps", F.lit(0)))
    return found.join(deps, "repo_id", "left").select(
        "repo_id", "vulnerability_count", "critical_count", share.alias("vulnerable_percent")
    )
