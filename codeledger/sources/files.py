"""File corpus scan: checked-out trees as ``repo_files`` rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_repo_files(spark: SparkSession, root: str, name_glob: str | None = None) -> DataFrame:
    """Every file under ``root/<repo id>/``, with paths relative to the repository.

    ``content`` is NULL for files that are not UTF-8.  Jobs that only need
    paths or sizes prune the content column, and then no file is opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    base = root.rstrip("/")
    tail = F.substring_index(F.col("path"), base + "/", -1)
    return reader.load(base).select(
        F.regexp_replace(F.url_decode(F.substring_index(tail, "/", 1)), "^repo_id=", "").alias("repo_id"),
        F.regexp_replace(tail, r"^[^/]*/", "").alias("path"),
        F.col("length").alias("size"),
        F.try_validate_utf8(F.col("content").cast("string")).alias("content"),
    )
