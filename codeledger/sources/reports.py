"""Report scans: one document per file, or one line per row."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import quote, unquote, urlsplit

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from codeledger.functions.scalars import strip

# <root>/<tool>/<url-encoded repo id>.<extension>, or the layout of a Spark
# write: <root>/tool=<tool>/repo_id=<repo id>/<any file>
_FILE_LAYOUT = r"/([^/]+)/([^/]+)\.[A-Za-z0-9]+$"
_PARTITION_LAYOUT = r"/tool=([^/]+)/repo_id=([^/]+)/[^/]+$"


#: Tasks a core that write report files.
FILE_TASKS = 4
#: What Spark's writer puts in a path for a null or empty value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def report_columns(path: Column) -> list[Column]:
    """repo id and tool as stated by a report's file path (a URL, so encoded once more)."""
    by_folder = path.rlike(_PARTITION_LAYOUT)

    def group(n: int) -> Column:
        return F.when(by_folder, F.regexp_extract(path, _PARTITION_LAYOUT, n)).otherwise(
            F.regexp_extract(path, _FILE_LAYOUT, n)
        )

    repo_id = F.url_decode(F.url_decode(group(2)))
    return [repo_id.alias("repo_id"), group(1).alias("tool")]


def read_reports(spark: SparkSession, root: str) -> DataFrame:
    """Reports under ``root/<tool>/<repo id>.json`` as (repo_id, tool, body)."""
    files = spark.read.option("recursiveFileLookup", "true").text(root, wholetext=True)
    named = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))
    return named.select(*report_columns(F.col("path")), "body")


def write_report_files(reports: DataFrame, root: str) -> None:
    """(repo_id, tool, body) as a file per report; several bodies of one report are its lines.

    Placing a file costs far more than its few bytes, and a folder for each doubles that.  On a file
    system that tasks can open themselves they write ``<root>/<tool>/<repo id>.json``, on any other
    Spark's writer makes the second layout.  All cores take part, however few splits the reports come in.
    """
    cores = reports.sparkSession.sparkContext.defaultParallelism
    dealt = reports.select("tool", "repo_id", "body").repartition(FILE_TASKS * cores, "tool", "repo_id")
    where = urlsplit(root)
    if where.scheme not in ("", "file"):
        dealt.write.partitionBy("tool", "repo_id").text(root)
        return
    folder, none = unquote(where.path) if where.scheme else root, NO_VALUE

    def place(rows: Iterator[Row]) -> None:
        def name(value: str | None) -> str:
            quoted = quote(value or none, safe="")
            # Spark reads no files whose names begin with these
            return f"%{ord(quoted[0]):02X}{quoted[1:]}" if quoted[0] in "._" else quoted

        for (tool, repo_id), same in groupby(rows, lambda r: (r["tool"], r["repo_id"])):
            at = os.path.join(folder, name(tool))
            os.makedirs(at, exist_ok=True)
            # a task that runs twice replaces its files whole; names with a dot are not read
            begun = os.path.join(at, f".{uuid.uuid4().hex}")
            with open(begun, "w", encoding="utf-8", newline="") as file:
                file.writelines(f"{r['body'] or ''}\n" for r in same)
            os.replace(begun, os.path.join(at, f"{name(repo_id)}.json"))

    os.makedirs(folder, exist_ok=True)
    dealt.sortWithinPartitions("tool", "repo_id").foreachPartition(place)


def report_lines(reports: DataFrame) -> DataFrame:
    """One row per line of a text report, with its position."""
    lines = F.split("body", r"\r?\n")
    return reports.select("repo_id", F.posexplode(lines).alias("line_no", "line"))


def language_lines(lines: DataFrame) -> DataFrame:
    """``"<percent> <language>"`` lines as (repo_id, line_no, percent_text, language)."""
    pattern = r"^\s*(\S+)\s+(.*\S)\s*$"
    return lines.where(F.col("line").rlike(pattern)).select(
        "repo_id",
        "line_no",
        F.regexp_extract("line", pattern, 1).alias("percent_text"),
        strip(F.regexp_extract("line", pattern, 2)).alias("language"),
    )
