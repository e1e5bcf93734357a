import datetime
import random

import pytest

from codeledger import schemas
from codeledger.operators.status import rollup_status, update_inventory_status
from codeledger.sinks.pages import paged
from codeledger.streaming.status import StatusStream, log_table_stream

from helpers import rows

STATES = ["SUCCESS", "SUCCESS", "SUCCESS", "FAILURE", "PROCESSING", "SKIPPED", None]


def log(spark, entries):
    full = [("m", "s", run, repo, status, "x", datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=h), 1.0) for run, repo, status, h in entries]
    return spark.createDataFrame(full, schemas.EXECUTION_LOG)


def taken_in(spark, tmp_path, deliveries, **options):
    incoming, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    statuses = StatusStream(spark, str(tmp_path / "status"), **options)
    for entries in deliveries:
        log(spark, entries).coalesce(1).write.mode("append").parquet(incoming)
        statuses.start(log_table_stream(spark, incoming), checkpoint).awaitTermination()
    return statuses


def test_stream_equals_rollup_shuffled_late_and_repeated(spark, tmp_path):
    numbers = random.Random(2)
    entries = [(f"run{numbers.randrange(2)}", f"r{numbers.randrange(9)}", numbers.choice(STATES), numbers.randrange(90)) for _ in range(60)]
    numbers.shuffle(entries)
    statuses = taken_in(spark, tmp_path, [entries[:30], entries[20:], entries[:9]], delay="30 days")
    targets = spark.createDataFrame([(run, f"r{i}") for run in ("run0", "run1", "run9") for i in range(10)], "run_id string, repo_id string")
    assert rows(statuses.rollup()) == rows(rollup_status(log(spark, entries)))
    assert rows(statuses.rollup(targets)) == rows(rollup_status(log(spark, entries), targets))


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    first = [("run", "a", "SUCCESS", 0), ("run", "b", "SUCCESS", 200)]
    statuses = taken_in(spark, tmp_path, [first, [("run", "b", "SUCCESS", 201)], [("run", "a", "FAILURE", 1), ("run", "b", "FAILURE", 199)]], delay="1 day")
    assert rows(statuses.rollup(), "repo_id", "status") == [("a", "SUCCESS"), ("b", "FAILURE")]


def test_no_rows_yet(spark, tmp_path):
    statuses = StatusStream(spark, str(tmp_path / "none"))
    assert statuses.rollup().count() == 0
    targets = spark.createDataFrame([("run", "a")], "run_id string, repo_id string")
    assert rows(statuses.rollup(targets)) == [("run", "a", "ERROR", "No analysis records.")]


def test_inventory_follows_the_stream(spark, tmp_path):
    statuses = taken_in(spark, tmp_path, [[("run", "a", "SUCCESS", 0)], [("run", "a", "SKIPPED", 1)]])
    inventory = spark.createDataFrame([("a", "old", "kept", None), ("b", "old", "own", None)], "repo_id string, status string, comment string, updated_on timestamp")
    found = update_inventory_status(inventory, statuses.rollup(), "2024-01-02 00:00:00")
    assert rows(found, "repo_id", "status", "comment") == [("a", "UNKNOWN", "kept"), ("b", "old", "own")]


@pytest.mark.parametrize("part_rows", [7, 40, 1_000])
def test_pages_by_range(spark, tmp_path, part_rows):
    keys = [f"r{i:04d}" for i in range(200)]
    table = spark.createDataFrame([(k, i, 9) for i, k in enumerate(keys)], "repo_id string, n int, rows int").repartition(5)
    stored = paged(table, str(tmp_path / "p"), part_rows=part_rows)
    for offset, limit in ((0, 10), (5, 50), (190, 30), (200, 5), (500, 5), (0, 0), (33, 1), (0, 1_000)):
        assert [r.repo_id for r in stored.page(offset, limit).collect()] == keys[offset : offset + limit], (offset, limit)
    assert stored.page(0, 3).columns == ["repo_id", "n", "rows"]


def test_a_deep_page_reads_no_more_files_than_the_first(spark, tmp_path):
    table = spark.range(20_000).withColumnRenamed("id", "repo_id")
    stored = paged(table, str(tmp_path / "p"), part_rows=500)

    first, deep = stored.page(0, 400), stored.page(19_000, 400)
    assert [r.repo_id for r in deep.collect()] == list(range(19_000, 19_400))
    assert max(len(first.inputFiles()), len(deep.inputFiles())) <= 3 < 40 <= len(spark.read.parquet(stored.path).inputFiles())


def test_pages_of_an_empty_table_and_null_keys(spark, tmp_path):
    empty = spark.createDataFrame([], "repo_id string")
    assert paged(empty, str(tmp_path / "e")).page(0, 5).count() == 0
    some = spark.createDataFrame([("b",), (None,), ("a",)], "repo_id string")
    assert [r.repo_id for r in paged(some, str(tmp_path / "n"), part_rows=1).page(0, 2).collect()] == [None, "a"]
