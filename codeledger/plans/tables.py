"""Whole tables from raw inputs: build tools and categorised dependencies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeledger.functions.scalars import basename, is_gradle_file
from codeledger.operators import build_tools as b
from codeledger.operators import sbom
from codeledger.operators.dependencies import categorize_dependencies, sbom_dependencies
from codeledger.operators.reports import syft_artifacts
from codeledger.operators.selection import gate_by_language
from codeledger.session import checkpointed
from codeledger.sources.rules import CategoryRule

# Main languages a stage accepts, and the spelling its second gate needs.
STAGE_LANGUAGES = {
    "gradle": (["java"], None),
    "maven": (["java"], None),
    "go": (["go"], ["Go"]),
    "js": (["JavaScript", "TypeScript"], ["JavaScript", "TypeScript"]),
    "python": (["Python", "Jupyter Notebook"], None),
}

# Files the detectors read, and files of which only the name counts.
_READ_NAMES = [
    "pom.xml",
    "maven-wrapper.properties",
    "jvm.config",
    "package.json",
    "go.mod",
    ".go-version",
    "Gopkg.lock",
    "glide.yaml",
    "poetry.lock",
    "pyproject.toml",
    "Pipfile.lock",
    "Pipfile",
    "setup.py",
]
_NAMED_ONLY = [
    "yarn.lock",
    "pnpm-lock.yaml",
    "package-lock.json",
    "Gopkg.toml",
    "vendor.json",
    "setup.cfg",
    "hatch.toml",
    "requirements.txt",
]


def build_file_subset(repo_files: DataFrame) -> DataFrame:
    """The few files the build-tool detectors look at; contents only where they read them."""
    path = F.col("path")
    name = basename(path)
    is_read = name.isin(_READ_NAMES) | is_gradle_file(path)
    wanted = is_read | name.isin(_NAMED_ONLY) | path.endswith(".go")
    content = F.when(is_read, F.col("content")).alias("content")
    return repo_files.where(wanted).select("repo_id", "path", "size", content)


def build_tools_table(
    repo_files: DataFrame, main_language: DataFrame, top_language: DataFrame | None = None
) -> DataFrame:
    """New ``build_tools`` rows of all stages, each behind its language gate.

    The corpus is scanned once: the manifests, a tiny part of it, are written to
    the checkpoint folder and the detectors read that.  Gates are applied to the
    detected rows, which are small, not to the files.
    """
    files = checkpointed(build_file_subset(repo_files))
    columns = ["repo_id", "tool", "tool_version", "runtime_version"]
    detected = {
        "gradle": b.gradle_versions(files).where(F.col("error").isNull()),
        "maven": b.maven_projects(files),
        "go": b.go_tools(files),
        "js": b.js_tools(files),
        "python": b.python_tools(files),
    }
    stages = []
    for stage, rows in detected.items():
        required, exact = STAGE_LANGUAGES[stage]
        stages.append(gate_by_language(rows.select(*columns), main_language, required, exact, top_language))
    return reduce(DataFrame.unionByName, stages)


def build_tool_failures(repo_files: DataFrame) -> DataFrame:
    """(repo_id, message, error, duration) of detections that failed, for ``execution_log_rows``."""
    failed = b.gradle_versions(build_file_subset(repo_files)).where(F.col("error").isNotNull())
    return failed.select("repo_id", F.lit(None).cast("string").alias("message"), "error", F.lit(0.0).alias("duration"))


def merged_artifacts(syft_reports: DataFrame, repo_files: DataFrame) -> DataFrame:
    """SBOM artifacts with those of unlocked Gradle modules; only for scanned repositories."""
    gradle = sbom.gradle_artifacts(sbom.gradle_dependencies(sbom.gradle_build_files(repo_files)))
    scanned = syft_reports.select("repo_id").distinct()
    return sbom.merge_artifacts(syft_artifacts(syft_reports), gradle.join(scanned, "repo_id", "left_semi"))


def dependency_table(
    syft_reports: DataFrame, repo_files: DataFrame, rules: Sequence[CategoryRule]
) -> DataFrame:
    """``syft_dependencies`` rows (with their order ``ord``) of merged artifact lists."""
    merged = merged_artifacts(syft_reports, repo_files)
    return categorize_dependencies(sbom_dependencies(merged, sbom.MERGED_ORDER), rules)
