"""Run status as a stream: the execution log, aggregated as its rows arrive."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from codeledger import schemas
from codeledger.operators.status import status_of

FLAGS = "run_id string, repo_id string, counted boolean, failed boolean, unclear boolean"


def log_table_stream(spark: SparkSession, path: str, max_files: int = 1_000) -> DataFrame:
    """A parquet folder of execution-log rows that jobs append to, as a stream."""
    return spark.readStream.schema(schemas.EXECUTION_LOG).option("maxFilesPerTrigger", max_files).parquet(path)


def status_flags(log: DataFrame, delay: str = "1 day", span: str = "1 day") -> DataFrame:
    """(run_id, repo_id, counted, failed, unclear) of a log stream, per ``span`` of execution time.

    Three flags say all that a status needs: some row counts, some failed, some neither failed nor succeeded.  A
    row only ever raises flags, so rows that come twice, in any order, change nothing.  The state holds three booleans per
    run, repository and span, and lets go of spans that ended ``delay`` before the newest row; rows
    that come still later are dropped by the watermark.
    """
    counted = F.coalesce(F.col("status") != "PROCESSING", F.lit(False))
    flags = {
        "counted": counted,
        "failed": F.coalesce(F.col("status") == "FAILURE", F.lit(False)),
        "unclear": counted & ~F.col("status").isin("FAILURE", "SUCCESS"),
    }
    spans = log.withWatermark("execution_time", delay).groupBy(F.window("execution_time", span), "run_id", "repo_id")
    return spans.agg(*[F.bool_or(flag).alias(name) for name, flag in flags.items()]).drop("window")


@dataclass
class StatusStream:
    """Statuses kept under ``root``: each micro-batch adds the flags that it changed."""

    spark: SparkSession
    root: str
    delay: str = "1 day"
    span: str = "1 day"

    def start(self, log: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Take in what the log stream has not delivered yet, then stop; or as ``trigger`` says.

        In update mode only changed rows are written, in a folder per batch: a batch that is run again replaces its own.
        """

        def write(flags: DataFrame, batch: int) -> None:
            flags.write.mode("overwrite").parquet(f"{self.root.rstrip('/')}/batch={batch}")

        stream = status_flags(log, self.delay, self.span).writeStream.outputMode("update").foreachBatch(write)
        return stream.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()

    def flags(self) -> DataFrame:
        """(run_id, repo_id, counted, failed, unclear) so far; flags of spans and batches add up by OR."""
        try:
            rows = self.spark.read.schema(FLAGS).parquet(self.root)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            rows = self.spark.createDataFrame([], FLAGS)
        return rows.groupBy("run_id", "repo_id").agg(*[F.bool_or(c).alias(c) for c in ("counted", "failed", "unclear")])

    def rollup(self, targets: DataFrame | None = None) -> DataFrame:
        """The (run_id, repo_id, status, comment) of ``rollup_status`` for the rows taken in so far."""
        seen = self.flags()
        if targets is not None:
            wanted = targets.select("run_id", "repo_id").distinct()
            seen = wanted.join(seen, ["run_id", "repo_id"], "left").na.fill(False)

        def flag(name: str) -> Column:
            return F.col(name)

        return status_of(seen, ~flag("counted"), flag("failed"), flag("counted") & ~flag("failed") & ~flag("unclear"))
