"""Commit history and repository size metrics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codeledger.functions.scalars import (
    activity_status,
    as_timestamp,
    in_git_dir,
    is_recent,
    whole_days_between,
)
from codeledger.operators.lists import PART_ITEMS, list_parts

AsOf = datetime | str | Column


def commits_by_author(commits: DataFrame) -> DataFrame:
    return commits.groupBy("repo_id", "author_email").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("committed_at").alias("first"),
        F.max("committed_at").alias("last"),
    )


def top_contributors(by_author: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` busiest authors per repository.

    The rank filter becomes a group limit on both sides of the shuffle, so each
    task sends at most ``k`` rows per repository.
    """
    busiest = Window.partitionBy("repo_id").orderBy(F.desc("n"), F.asc("author_email"))
    return by_author.withColumn("rank", F.row_number().over(busiest)).where(F.col("rank") <= k)


def commit_stats(commits: DataFrame, as_of: AsOf) -> DataFrame:
    """Commit totals, contributors, activity and concentration per repository."""
    by_author = commits_by_author(commits)
    totals = by_author.groupBy("repo_id").agg(
        F.sum("n").alias("total_commits"),
        F.count(F.lit(1)).alias("number_of_contributors"),
        F.min("first").alias("first_commit_date"),
        F.max("last").alias("last_commit_date"),
        F.max("n").alias("top_contributor_commits"),
    )
    top3 = (
        top_contributors(by_author, 3)
        .groupBy("repo_id")
        .agg(
            F.sum("n").alias("commits_by_top_3_contributors"),
            F.min("first").alias("_first"),
            F.max("last").alias("_last"),
        )
    )
    # the top three are among all authors, so their dates change nothing; using
    # them keeps both branches alike, and they share one scan and one shuffle
    first = F.least("first_commit_date", "_first")
    last = F.greatest("last_commit_date", "_last")
    return totals.join(top3, "repo_id").select(
        "repo_id",
        "total_commits",
        "number_of_contributors",
        activity_status(last, as_of).alias("activity_status"),
        first.alias("first_commit_date"),
        last.alias("last_commit_date"),
        whole_days_between(as_timestamp(as_of), first).alias("repo_age_days"),
        "top_contributor_commits",
        "commits_by_top_3_contributors",
    )


def recent_commits(commits: DataFrame, as_of: AsOf) -> DataFrame:
    return commits.where(is_recent(F.col("committed_at"), as_of)).select("repo_id", "committed_at")


def recent_commit_dates(commits: DataFrame, as_of: AsOf, part_items: int = PART_ITEMS) -> DataFrame:
    """(repo_id, part, items) with the commit times of the last year (see ``list_parts``)."""
    return list_parts(recent_commits(commits, as_of), ["committed_at"], part_items)


def size_totals(repo_files: DataFrame) -> DataFrame:
    """Bytes of all files, bytes outside ``.git``, and files outside ``.git``."""
    tracked = ~in_git_dir(F.col("path"))
    return repo_files.groupBy("repo_id").agg(
        F.sum("size").alias("repo_size_bytes"),
        F.coalesce(F.sum(F.when(tracked, F.col("size"))), F.lit(0)).alias("code_size_bytes"),
        F.count_if(tracked).alias("file_count"),
    )


def branch_counts(branches: DataFrame) -> DataFrame:
    return branches.groupBy("repo_id").agg(F.count("ref").alias("active_branch_count"))


def repo_metrics(commits: DataFrame, repo_files: DataFrame, branches: DataFrame, as_of: AsOf) -> DataFrame:
    """The ``repo_metrics`` table, one row per repository that has commits.

    The dates of its recent commits are the ``recent_commits`` table.
    """
    return (
        commit_stats(commits, as_of)
        .join(size_totals(repo_files), "repo_id", "left")
        .join(branch_counts(branches), "repo_id", "left")
        .select(
            "repo_id",
            F.coalesce("repo_size_bytes", F.lit(0)).cast("double").alias("repo_size_bytes"),
            F.coalesce("code_size_bytes", F.lit(0)).cast("double").alias("code_size_bytes"),
            F.coalesce("file_count", F.lit(0)).cast("int").alias("file_count"),
            F.col("total_commits").cast("int").alias("total_commits"),
            F.col("number_of_contributors").cast("int").alias("number_of_contributors"),
            "activity_status",
            "last_commit_date",
            F.col("repo_age_days").cast("int").alias("repo_age_days"),
            F.coalesce("active_branch_count", F.lit(0)).cast("int").alias("active_branch_count"),
            F.col("top_contributor_commits").cast("int").alias("top_contributor_commits"),
            F.col("commits_by_top_3_contributors").cast("int").alias("commits_by_top_3_contributors"),
            as_timestamp(as_of).alias("updated_at"),
        )
    )
