import pytest
from pyspark.sql import functions as F

from codeledger import schemas
from codeledger.operators import history, selection
from codeledger.operators.lists import whole_lists
from codeledger.sources.rules import ruleset_map_from_ini

from helpers import rows


@pytest.fixture
def combined(spark):
    data = [
        ("AB/one", "github.com", "ACTIVE", "NEW", "t1", "Python", "Small", "a", 5, "u1", None),
        ("xab/two", "GitHub.com", "active", "NEW", "t1", "Java", "Tiny", "b", 5, "u2", None),
        ("zz/three", "gitlab.com", "INACTIVE", "OLD", "t2", "Go", "Tiny", "c", 7, "u3", None),
        ("zz/three", "gitlab.com", "INACTIVE", "OLD", "t2", "Go", "Tiny", "c", 7, "u3", None),
    ]
    return spark.createDataFrame(data, schemas.COMBINED_REPO_METRICS)


def ids(df):
    return [r["repo_id"] for r in df.collect()]


def test_text_matches_any_case_and_numbers_match_as_they_are(combined):
    payload = {"payload": {"host_name": ["GITHUB.com"], "number_of_contributors": [5]}}
    assert ids(selection.select_repositories(combined, payload)) == ["AB/one", "xab/two"]


def test_repo_id_is_a_substring_of_the_first_value(combined):
    assert ids(selection.select_repositories(combined, {"repo_id": ["ab", "zz"]})) == ["AB/one", "xab/two"]
    assert ids(selection.select_repositories(combined, {"repo_id": ["z_/%ee"]})) == ["zz/three"]
    assert ids(selection.select_repositories(combined, {"repo_id": ["a\\b"]})) == ["AB/one", "xab/two"]


def test_rows_are_distinct_and_projected(combined):
    df = selection.select_repositories(combined, {"tc": ["T2"], "ignored": [1]})
    assert df.count() == 1
    assert df.columns == [
        "repo_id", "status", "clone_url_ssh", "updated_on", "host_name", "activity_status", "tc",
        "main_language", "classification_label", "app_id", "number_of_contributors",
    ]


def test_null_values_are_dropped_from_a_filter(combined):
    assert ids(selection.select_repositories(combined, {"host_name": [None, "gitlab.com"]})) == ["zz/three"]


@pytest.mark.parametrize(
    "payload", [{}, {"x": [1]}, {"tc": []}, {"payload": {}}, [], "text", {"tc": [None]}, {"app_id": ["a", 1]}]
)
def test_useless_payloads_are_errors(spark, payload):
    with pytest.raises(ValueError):
        selection.payload_condition(payload)


def test_batches_follow_key_order(spark):
    df = spark.createDataFrame([(f"r{i:04d}",) for i in range(1003)], "repo_id string").repartition(7)
    found = {r["repo_id"]: r["batch_no"] for r in selection.number_batches(df, 100).collect()}
    assert found == {f"r{i:04d}": i // 100 + 1 for i in range(1003)}


def test_row_numbers_are_dense(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 100003).alias("k"))
    found = [tuple(r) for r in selection.number_rows(df, "k").collect()]
    assert sorted(found) == [(k, i + 1) for i, k in enumerate(sorted(k for k, _ in found))]


def test_pages(spark):
    df = spark.range(300).select((299 - F.col("id")).alias("k"), F.lit("v").alias("v"))
    assert rows(selection.page(df, 120, 40, "k")) == [(k, "v") for k in sorted(range(120, 160), key=str)]
    assert selection.page(df, 300, 40, "k").count() == 0


def test_main_language_and_gates(spark):
    shares = spark.createDataFrame(
        [("a", "Java", 60.0), ("a", "Go", 40.0), ("b", "go", 90.0), ("c", "Go", 50.0), ("c", "C", 50.0)],
        "repo_id string, language string, percent_usage double",
    )
    main = selection.main_languages(shares)
    assert rows(main, "repo_id", "main_language") == [("a", "Java"), ("b", "go"), ("c", "C")]
    repos = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "repo_id string")
    assert rows(selection.gate_by_language(repos, main, " GO ")) == [("b",)]
    assert rows(selection.gate_by_language(repos, main, ["go", "c"], exact_top=["Go", "C"])) == [("c",)]


def test_rulesets(spark):
    mapping = ruleset_map_from_ini("[java]\npath=java\n[c++]\npath=0xdea\n[nopath]\nother=1\n")
    assert mapping == {"java": "java", "c++": "0xdea"}
    detected = spark.createDataFrame(
        [("a", "Java"), ("a", "C++"), ("a", "java"), ("b", "COBOL")], "repo_id string, language string"
    )
    assert rows(selection.repository_rulesets(detected, mapping)) == [("a", ["0xdea", "java"])]
    assert rows(selection.repository_rulesets(detected, mapping, available=["java"])) == [("a", ["java"])]
    assert rows(selection.repository_rulesets(detected, mapping, available=[])) == []


def _commits(spark, counts):
    data = [("r", author, f"2024-01-{i % 28 + 1:02d} 00:00:00") for author, n in counts.items() for i in range(n)]
    return spark.createDataFrame(data, "repo_id string, author_email string, t string").select(
        "repo_id", "author_email", F.col("t").cast("timestamp").alias("committed_at")
    )


def test_contributor_concentration(spark):
    stats = history.commit_stats(_commits(spark, {"a": 5, "b": 3, "c": 2, "d": 1}), "2025-01-01 00:00:00").first()
    assert (stats["total_commits"], stats["number_of_contributors"]) == (11, 4)
    assert (stats["top_contributor_commits"], stats["commits_by_top_3_contributors"]) == (5, 10)
    assert stats["repo_age_days"] == 366


def test_recent_dates_come_whole_also_when_long(spark):
    commits = _commits(spark, {"a": 40, "b": 25})
    dates = sorted(r["committed_at"] for r in commits.collect())
    for size in (2_000, 10):
        parts = history.recent_commit_dates(commits, "2024-06-01 00:00:00", size)
        assert whole_lists(parts, "dates").first()["dates"] == dates
    assert parts.count() > 4
