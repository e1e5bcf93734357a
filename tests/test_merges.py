import random

import pytest
from pyspark.sql import functions as F

from codeledger import schemas
from codeledger.operators import keyed, status
from codeledger.operators.lists import keep_first, list_parts, whole_lists
from codeledger.operators.vulnerabilities import combined_vulnerabilities, deduplicated_vulnerabilities, vulnerability_metrics
from codeledger.sinks.tables import DerivedTable, KeyedTable

from helpers import rows

KV = "repo_id string, v string"
KEY = schemas.UNIQUE_KEYS["build_tools"]


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


# --- status -----------------------------------------------------------------


def test_status_rollup(spark):
    states = {
        "ok": ["SUCCESS", "PROCESSING"], "bad": ["SUCCESS", "FAILURE"], "busy": ["PROCESSING"], "odd": ["SUCCESS", "OTHER"],
        "badodd": ["OTHER", "FAILURE"],
    }
    log = frame(spark, "run_id string, repo_id string, status string", *[("1", r, s) for r, ss in states.items() for s in ss])
    targets = frame(spark, "run_id string, repo_id string", ("1", "ok"), ("1", "silent"))
    assert rows(status.rollup_status(log)) == [
        ("1", "bad", "FAILURE", None), ("1", "badodd", "FAILURE", None), ("1", "busy", "ERROR", "No analysis records."),
        ("1", "odd", "UNKNOWN", None), ("1", "ok", "SUCCESS", "All steps completed."),
    ]
    assert rows(status.rollup_status(log, targets), "repo_id", "status") == [("ok", "SUCCESS"), ("silent", "ERROR")]


def test_inventory_update_keeps_comments(spark):
    inventory = frame(spark, "repo_id string, status string, comment string, updated_on timestamp",
                      ("bad", "S", "old", None), ("ok", "S", "old", None), ("else", "S", "old", None))
    rollup = frame(spark, "run_id string, repo_id string, status string, comment string",
                   ("1", "bad", "FAILURE", None), ("1", "ok", "SUCCESS", "All steps completed."))
    updated = status.update_inventory_status(inventory, rollup, "2025-01-01 00:00:00")
    found = rows(updated.withColumn("at", F.date_format("updated_on", "yyyy")), "repo_id", "status", "comment", "at")
    assert found == [("bad", "FAILURE", "old", "2025"), ("else", "S", "old", None), ("ok", "SUCCESS", "All steps completed.", "2025")]


# --- keyed merges -----------------------------------------------------------


def test_replace_by_key(spark):
    old = frame(spark, KV, ("a", "1"), ("a", "2"), ("b", "3"))
    new = frame(spark, KV, ("a", "9"))
    done = frame(spark, "repo_id string", ("a",), ("b",))
    assert rows(keyed.replace_by_key(old, new, done, "clear")) == [("a", "9")]
    assert rows(keyed.replace_by_key(old, new, done, "keep")) == [("a", "9"), ("b", "3")]
    twice = keyed.replace_by_key(keyed.replace_by_key(old, new, done), new, done)
    assert rows(twice) == [("a", "9")]
    with pytest.raises(ValueError):
        keyed.replace_by_key(old, new, done, "other")


PIP, MAVEN = ("r", "pip", None, None), ("r", "maven", "3", "17")


def test_insert_ignore(spark):
    none = frame(spark, schemas.BUILD_TOOLS)
    new = frame(spark, schemas.BUILD_TOOLS, PIP, MAVEN, MAVEN)
    once = keyed.insert_ignore(none, new, KEY)
    assert rows(keyed.insert_ignore(once, new, KEY)) == [MAVEN, PIP, PIP]
    safe = keyed.insert_ignore(none, new, KEY, null_safe=True)
    assert rows(keyed.insert_ignore(safe, new, KEY, null_safe=True)) == [MAVEN, PIP]


def test_insert_ignore_keeps_one_row_per_key(spark):
    key = schemas.UNIQUE_KEYS["dependencies"]
    old = frame(spark, schemas.DEPENDENCIES, ("r", "n", "1", "old", None, None))
    new = frame(spark, schemas.DEPENDENCIES, ("r", "n", "1", "new", None, None), ("r", "m", "1", "b", None, None),
                ("r", "m", "1", "a", None, None))
    assert rows(keyed.insert_ignore(old, new, key), "name", "package_type") == [("m", "a"), ("n", "old")]


def test_upsert_and_last_writer(spark):
    old = frame(spark, KV, ("a", "1"), ("b", "2"))
    assert rows(keyed.upsert(old, frame(spark, KV, ("b", "9"), ("c", "3")))) == [("a", "1"), ("b", "9"), ("c", "3")]
    writes = frame(spark, "k string, pos int, v string", ("x", 1, "a"), ("x", 3, "c"), ("x", 2, "b"), ("y", 1, None))
    assert rows(keyed.last_writer_wins(writes, ["k"], ["pos"])) == [("x", 3, "c"), ("y", 1, None)]


def test_keep_first_treats_null_keys_as_equal(spark):
    df = frame(spark, "k string, o int, v string", (None, 2, "b"), (None, 1, "a"), ("x", 5, None), ("x", 6, "z"))
    assert rows(keep_first(df, ["k"], ["o"])) == [(None, 1, "a"), ("x", 5, None)]


# --- the parquet table ------------------------------------------------------


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "t"), KV)


def test_table_replace(spark, table):
    assert table.read().count() == 0
    table.append(frame(spark, KV, *[(f"r{i % 20}", str(i)) for i in range(100)]))
    new = frame(spark, KV, ("r1", "new"))
    done = frame(spark, "repo_id string", ("r1",), ("r2",), ("unknown",))
    for _ in range(2):
        table.replace(new, done, "clear")
        found = rows(table.read())
        assert [r for r in found if r[0] in ("r1", "r2")] == [("r1", "new")]
        assert len(found) == 91
    table.replace(new.limit(0), done, "keep")
    assert len(rows(table.read())) == 91


def test_table_clears_buckets_that_become_empty(spark, table):
    table.append(frame(spark, KV, ("a", "1"), ("a", "2")))
    table.replace(frame(spark, KV), frame(spark, "repo_id string", ("a",)), "clear")
    assert rows(table.read()) == []
    table.upsert(frame(spark, KV, ("a", "3")))
    assert rows(table.read()) == [("a", "3")]


def test_keys_outside_the_processed_ones_and_other_types(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), KV)
    table.append(frame(spark, KV, *[(str(i), "old") for i in range(200)]))
    table.replace(frame(spark, KV, ("1", "a"), ("new", "b")), frame(spark, "repo_id string", ("1",)))
    assert len(rows(table.read())) == 201
    numbers = KeyedTable(spark, str(tmp_path / "n"), "repo_id bigint, v string")
    numbers.append(frame(spark, "repo_id bigint, v string", *[(i, "old") for i in range(200)]))
    numbers.replace(frame(spark, "repo_id bigint, v string"), frame(spark, "repo_id int", (1,), (None,)))
    assert len(rows(numbers.read())) == 199


def test_a_failed_write_is_not_seen_and_a_label_counts_once(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), KV)
    table.append(frame(spark, KV, ("a", "1")), label="first")
    broken = frame(spark, KV, ("a", "x")).select("repo_id", F.raise_error(F.lit("stop")).cast("string").alias("v"))
    with pytest.raises(Exception):
        table.replace(broken)
    assert rows(table.read()) == [("a", "1")]
    table.append(frame(spark, KV, ("a", "2")), label="first")
    assert rows(table.read()) == [("a", "1")]
    table.replace(frame(spark, KV, ("a", "3"), ("b", "4")))
    table.compact()
    table.append(frame(spark, KV, ("b", "5")))
    assert rows(table.read()) == [("a", "3"), ("b", "4"), ("b", "5")]
    table.replace(frame(spark, KV), frame(spark, "repo_id string", ("b",)))
    assert rows(table.read()) == [("a", "3")]


def test_null_keys_are_replaced_as_one_key(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), KV)
    table.append(frame(spark, KV, (None, "1"), ("a", "2")))
    table.replace(frame(spark, KV, (None, "3")))
    assert rows(table.read()) == [(None, "3"), ("a", "2")]


def test_derived_table_versions(spark, tmp_path):
    table = DerivedTable(spark, str(tmp_path / "d"))
    with pytest.raises(FileNotFoundError):
        table.read()
    for n in (3, 2):
        table.refresh(spark.range(n))
        assert table.read().count() == n
    with pytest.raises(Exception):
        table.refresh(spark.range(5).select(F.raise_error(F.lit("stop"))))
    assert table.read().count() == 2


def test_table_insert_ignore(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "tools"), schemas.BUILD_TOOLS)
    new = frame(spark, schemas.BUILD_TOOLS, PIP, MAVEN)
    for _ in range(2):
        table.insert_ignore(new, KEY)
    assert rows(table.read()) == [MAVEN, PIP, PIP]
    table.insert_ignore(new, KEY, null_safe=True)
    assert rows(table.read()) == [MAVEN, PIP, PIP]
    with pytest.raises(ValueError):
        table.insert_ignore(new, ["tool"])


# --- vulnerabilities --------------------------------------------------------


def _vulnerabilities(spark, grype, trivy):
    g = frame(spark, "repo_id string, package string, version string, severity string, fix_versions string", *grype)
    t = frame(spark, "repo_id string, pkg_name string, installed_version string, severity string, fixed_version string", *trivy)
    return g, t


def test_vulnerability_dedup_and_metrics(spark):
    g, t = _vulnerabilities(
        spark,
        [("r", "p", "1", "Critical", "2")],
        [("r", "p", "1", "CRITICAL", "2"), ("r", "p", "1", "Critical", "3"), ("r", None, "1", "High", ""), ("r", "", "1", "High", "")],
    )
    kept = deduplicated_vulnerabilities(combined_vulnerabilities(g, t))
    assert rows(kept, "severity", "source") == [("CRITICAL", "Trivy"), ("Critical", "Grype")]
    deps = frame(spark, "repo_id string, n_items bigint", ("r", 4))
    assert rows(vulnerability_metrics(kept, deps)) == [("r", 2, 1, 50.0)]
    assert rows(vulnerability_metrics(kept, deps.limit(0))) == [("r", 2, 1, 200.0)]
    same = deduplicated_vulnerabilities(combined_vulnerabilities(g, t, normalize_severity=True))
    assert rows(same, "severity", "source") == [("Critical", "Grype")]


def test_dedup_does_not_depend_on_row_order(spark):
    rng = random.Random(1)
    grype = [("r", f"p{rng.randrange(5)}", rng.choice(["1", None]), rng.choice(["Low", "High"]), str(rng.randrange(9))) for _ in range(80)]
    trivy = [("r", f"p{rng.randrange(5)}", rng.choice(["1", None]), rng.choice(["Low", "High"]), str(rng.randrange(9))) for _ in range(80)]
    results = []
    for seed in (1, 2, 3):
        random.Random(seed).shuffle(grype)
        random.Random(seed).shuffle(trivy)
        g, t = _vulnerabilities(spark, grype, trivy)
        combined = combined_vulnerabilities(g.repartition(seed), t.repartition(seed + 1))
        results.append(rows(deduplicated_vulnerabilities(combined)))
    assert results[0] == results[1] == results[2]
    keys = [r[:4] for r in results[0]]
    assert len(keys) == len(set(keys))


# --- bounded lists ----------------------------------------------------------


def test_one_repository_with_most_rows_comes_in_parts(spark):
    data = [("hot", "same")] * 700 + [("hot", str(i)) for i in range(1000)] + [("cold", "x"), ("cold", "x"), ("cold", None)]
    df = frame(spark, KV, *data)
    parts = list_parts(df, ["v"], 100)
    assert max(len(p["items"]) for p in parts.collect()) <= 100
    assert parts.where("repo_id = 'hot'").count() > 20
    found = {r["repo_id"]: r["all"] for r in whole_lists(parts, "all").collect()}
    order = lambda v: (v is not None, v or "")
    assert {k: sorted(v, key=order) for k, v in found.items()} == {
        key: sorted((v for k, v in data if k == key), key=order) for key in ("hot", "cold")
    }
    assert list_parts(df.limit(0), ["v"]).count() == 0


def test_lists_keep_their_order_without_an_interpreted_comparator(spark):
    """Nulls last in a list, first within an item; copies side by side; both sorts are compiled."""
    df = spark.createDataFrame([("r", v) for v in ("b", None, "a", "b", None)], "repo_id string, v string")
    parts = list_parts(df, ["v"], 2)
    assert whole_lists(parts, "all").first()["all"] == ["a", "b", "b", None, None]
    pairs = spark.createDataFrame([("r", "a", 2), ("r", None, 1), ("r", "a", None)], "repo_id string, v string, n int")
    listed = whole_lists(list_parts(pairs, ["v", "n"]), "all").first()["all"]
    assert [tuple(x) for x in listed] == [(None, 1), ("a", None), ("a", 2)]
    assert "array_sort" not in whole_lists(parts, "all")._jdf.queryExecution().optimizedPlan().toString()
