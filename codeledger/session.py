"""Session construction and tables in the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "codeledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs assume: UTC, AQE with skew handling.

    On a cluster leave ``master`` empty and let spark-submit decide; AQE
    coalesces from a generous shuffle partition count.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # collect_list per repository: sort only when a task sees many keys;
        # memory stays bounded by the task's input split, not by this number
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "4096")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder; on a
    cluster a machine-local folder would lose data with its machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="codeledger-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` as a table written to the shared checkpoint folder.

    Cuts the lineage like ``DataFrame.checkpoint``, and survives lost executors
    the same way, but columnar: later jobs read only the columns they use, with
    known sizes.  Runs the job that computes ``df``.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/codeledger-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
