"""Plan shapes that must hold at any size."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from codeledger import schemas
from codeledger.catalog import contents
from codeledger.catalog.registry import Tables
from codeledger.operators import history, sbom
from codeledger.operators.iac import iac_matches
from codeledger.operators.selection import select_repositories
from codeledger.sources.rules import IacRule

SF_DIR = "/root/testdata/sf0.001"
STORING = {"q_incremental_ingest", "q_keyed_table", "q_keyed_insert", "q_keyed_foreign_keys", "q_upsert_table", "q_refresh_table", "q_late_reports", "q_status_stream", "q_page_by_range", "q_incremental_refresh", "q_report_files", "q_file_corpus",
           "q_rule_files", "q_iac_rule_files", "q_jdk_file", "q_ruleset_file", "q_gradle_rules_file"} | {q for q in contract.queries() if q.startswith("op") or q == "pipeline"}


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - STORING))
def test_no_query_pairs_rows_without_a_key(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_selection_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "combined")
    spark.createDataFrame([], schemas.COMBINED_REPO_METRICS).write.parquet(path)
    plan = plan_of(select_repositories(spark.read.parquet(path), {"number_of_contributors": [1, 2]}))
    assert "PushedFilters: [In(number_of_contributors, [1,2])]" in plan


def test_top_contributors_limit_before_the_shuffle(spark):
    commits = spark.read.parquet(f"{SF_DIR}/orders.parquet").select(
        F.col("o_custkey").alias("repo_id"), F.col("o_orderpriority").alias("author_email"),
        F.col("o_orderdate").alias("committed_at"),
    )
    plan = plan_of(history.top_contributors(history.commits_by_author(commits)))
    assert "row_number(), 3, Partial" in plan


def _files(spark, tmp_path):
    path = str(tmp_path / "files")
    spark.createDataFrame([("r", "build.gradle", 1, "x")], schemas.REPO_FILES).write.parquet(path)
    return spark.read.parquet(path)


def test_iac_rules_need_no_shuffle(spark, tmp_path):
    rules = [IacRule(i, "c", "s", f"f{i}", (rf"\.x{i}$",), (f"y{i}",)) for i in range(50)]
    plan = plan_of(iac_matches(_files(spark, tmp_path), rules))
    assert "Exchange" not in plan and "Join" not in plan


def test_file_contents_are_not_shuffled(spark, tmp_path):
    from codeledger.operators import build_tools as b

    files = _files(spark, tmp_path)
    jobs = [b.gradle_versions, b.maven_projects, b.go_tools, b.js_tools, b.python_tools, sbom.gradle_build_files]
    for job in jobs:
        stack = [job(files)._jdf.queryExecution().executedPlan()]
        exchanges = 0
        while stack:
            node = stack.pop()
            if node.nodeName() == "AdaptiveSparkPlan":
                stack.append(node.initialPlan())
                continue
            if "Exchange" in node.nodeName():
                exchanges += 1
                assert "content#" not in node.output().mkString(","), job.__name__
            children = node.children()
            stack.extend(children.apply(i) for i in range(children.size()))
        assert exchanges > 0, job.__name__


def test_size_totals_do_not_read_contents(spark, tmp_path):
    plan = plan_of(history.size_totals(_files(spark, tmp_path)))
    assert "ReadSchema: struct<repo_id:string,path:string,size:bigint>" in plan


def test_gradle_files_are_read_by_all_cores(spark, tmp_path):
    parts = spark.range(4000).selectExpr("id p_partkey", "'a b' p_name", "'Brand#1' p_brand", "cast(id % 50 as int) p_size")
    parts.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    files = contents._gradle_files(Tables(spark, str(tmp_path)))
    by_task = [r["count"] for r in files.groupBy(F.spark_partition_id()).count().collect()]
    assert len(by_task) >= spark.sparkContext.defaultParallelism and sum(by_task) == 4000
    assert max(by_task) <= 2 * 4000 / len(by_task)
