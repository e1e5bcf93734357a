"""Incremental ingest: new report files to tables, one micro-batch at a time."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from codeledger import schemas
from codeledger.functions.patterns import literal_map
from codeledger.operators import reports as r
from codeledger.operators.dependencies import syft_dependencies
from codeledger.operators.status import execution_log_rows
from codeledger.plans.tables import dependency_table
from codeledger.session import checkpointed, ensure_checkpoint_dir
from codeledger.sinks.tables import KeyedTable
from codeledger.sources.reports import report_columns
from codeledger.sources.rules import CategoryRule


@dataclass(frozen=True)
class Target:
    """Where a tool's rows go and what an empty result does to older rows."""

    table: str
    schema: str
    parse: Callable[[DataFrame], DataFrame]
    on_empty: str


def _languages(reports: DataFrame) -> DataFrame:
    return r.parse_enry(reports).withColumn("analysis_date", F.lit(None).cast("timestamp"))


TARGETS = {
    "cloc": Target("cloc_metrics", schemas.CLOC_METRICS, r.parse_cloc, "clear"),
    "lizard": Target("lizard_summary", schemas.LIZARD_SUMMARY, r.parse_lizard, "keep"),
    "enry": Target("languages", schemas.LANGUAGES, _languages, "clear"),
    "trivy": Target("trivy_vulnerability", schemas.TRIVY_VULNERABILITY, r.parse_trivy, "clear"),
    "grype": Target("grype_results", schemas.GRYPE_RESULTS, r.parse_grype, "keep"),
    "xeol": Target("xeol_results", schemas.XEOL_RESULTS, r.parse_xeol, "keep"),
    "semgrep": Target("semgrep_results", schemas.SEMGREP_RESULTS, r.parse_semgrep, "clear"),
    "checkov": Target("checkov_summary", schemas.CHECKOV_SUMMARY, r.parse_checkov, "keep"),
}


REPORT_TIME = "repo_id string, modified timestamp"


@dataclass
class ReportIngest:
    """Writes batches of reports to the keyed tables under ``tables_root``.

    With ``repo_files`` the dependencies are those of the SBOM merged with the
    Gradle build files of the same repositories.
    """

    spark: SparkSession
    tables_root: str
    rules: Sequence[CategoryRule] = field(default_factory=tuple)
    run_name: str = "ingest"
    repo_files: DataFrame | None = None

    def _dependencies(self, reports: DataFrame) -> DataFrame:
        if self.repo_files is None:
            return syft_dependencies(reports, self.rules)
        scanned = reports.select("repo_id").distinct()
        return dependency_table(reports, self.repo_files.join(scanned, "repo_id", "left_semi"), self.rules)

    def _target(self, tool: str) -> Target | None:
        if tool == "syft":
            return Target("syft_dependencies", schemas.SYFT_DEPENDENCIES, self._dependencies, "keep")
        return TARGETS.get(tool)

    def table(self, tool: str) -> KeyedTable:
        target = self._target(tool)
        return KeyedTable(self.spark, f"{self.tables_root.rstrip('/')}/{target.table}", target.schema)

    def log(self) -> KeyedTable:
        """The execution log; a repeated batch is logged once."""
        return KeyedTable(self.spark, f"{self.tables_root.rstrip('/')}/analysis_execution_log", schemas.EXECUTION_LOG)

    def newest(self, tool: str) -> KeyedTable:
        """When the report that ``tool``'s table holds of a repository was written."""
        return KeyedTable(self.spark, f"{self.tables_root.rstrip('/')}/report_times/{tool}", REPORT_TIME)

    def write_batch(self, reports: DataFrame, batch_id: int = 0) -> None:
        """Parse and store one batch of (repo_id, tool, body[, modified]), and log it.

        The batch is reduced and written once, in a folder per tool, and every table reads its own part.  A report
        that is older than the one stored, by ``modified``, changes nothing and is logged as such; of equal times, and
        without times, the later batch counts.  Each table gets the batch once, under its run's name: writing the same
        batch again adds nothing.  The cost is that of the batch, not of the tables, but for the times of
        the reports before it.
        """
        run_id = f"{self.run_name}-{batch_id}"
        known = [*TARGETS, "syft"]
        written = _by_tool(newest_reports(reports.where(F.col("tool").isin(known))))
        tools = sorted(row[0] for row in written.select("tool").distinct().collect())
        seconds, outcomes = {}, []
        for tool in tools:
            start = time.perf_counter()
            target = self._target(tool)
            of_tool = written.where(F.col("tool") == tool)
            late = self._late(tool, of_tool)
            fresh = of_tool.where("error is null")
            if late is not None:
                fresh = fresh.join(late, "repo_id", "left_anti")
            self.table(tool).replace(target.parse(fresh), fresh.select("repo_id"), target.on_empty, run_id)
            # last, so that a batch that broke off before is not taken for a late one
            self.newest(tool).upsert(fresh.select("repo_id", "modified"), run_id)
            seconds[tool] = time.perf_counter() - start
            message = F.lit("stored")
            told = of_tool.select("repo_id", "tool", "error")
            if late is not None:
                told = told.join(late.withColumn("_late", F.lit(True)), "repo_id", "left")
                message = F.when(F.col("_late"), "older than the stored report").otherwise(message)
            outcomes.append(told.select("repo_id", "tool", message.alias("message"), "error"))
        if not tools:
            return
        took = literal_map([(tool, str(s)) for tool, s in seconds.items()])[F.col("tool")].cast("double")
        rows = reduce(DataFrame.union, outcomes).withColumn("duration", took)
        self.log().append(execution_log_rows(rows, "ingest", F.col("tool"), run_id, F.current_timestamp()), run_id)

    def _late(self, tool: str, reports: DataFrame) -> DataFrame | None:
        """(repo_id) of readable reports older than the stored ones; None if there are none.

        Times alone are read and joined.  The ids are written, so that the join with the reports is planned with their size.
        """
        now = reports.where("error is null").select("repo_id", "modified")
        stored = self.newest(tool).read().withColumnRenamed("modified", "_stored")
        late = checkpointed(now.join(stored, "repo_id").where("modified < _stored or (modified is null and _stored is not null)").select("repo_id"))
        return None if late.isEmpty() else late

    def start(self, incoming: DataFrame, checkpoint: str) -> StreamingQuery:
        """Ingest everything ``incoming`` (a stream of reports) has not delivered yet, then stop."""
        return (
            incoming.writeStream.foreachBatch(self.write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def report_file_stream(spark: SparkSession, root: str, max_files: int = 10_000) -> DataFrame:
    """Report files under ``root`` as a stream of (repo_id, tool, body, modified, path)."""
    files = (
        spark.readStream.option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .text(root)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_modification_time").alias("modified"),
            F.col("value").alias("body"),
        )
    )
    return files.select(*report_columns(F.col("path")), "body", "modified", "path")


def report_table_stream(spark: SparkSession, path: str, max_files: int = 1_000) -> DataFrame:
    """A parquet folder of reports that jobs append to, as a stream."""
    schema = f"{schemas.REPORTS}, modified timestamp"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def _by_tool(reports: DataFrame) -> DataFrame:
    """``reports`` with ``error``, why one cannot be read, as a table in the shared folder with a part per tool."""
    path = f"{ensure_checkpoint_dir(reports.sparkSession).rstrip('/')}/codeledger-batch-{uuid.uuid4().hex}"
    told = reports.withColumn("error", r.unreadable_reason())
    told.write.partitionBy("tool").parquet(path)
    return told.sparkSession.read.schema(told.schema).parquet(path).select(*told.columns)


def newest_reports(reports: DataFrame) -> DataFrame:
    """One report per repository and tool: the newest, of equal times the last path, then the greatest body.

    An aggregate: copies are reduced before the shuffle.
    """
    time = F.col("modified").cast("timestamp") if "modified" in reports.columns else F.lit(None).cast("timestamp")
    path = ["path"] if "path" in reports.columns else []
    timed = reports.withColumn("modified", time)
    newest = F.max_by(F.struct("body", "modified"), F.struct("modified", *path, F.xxhash64("body"), F.col("body")))
    found = timed.groupBy("repo_id", "tool").agg(newest.alias("_newest"))
    return found.select("repo_id", "tool", "_newest.body", "_newest.modified")
