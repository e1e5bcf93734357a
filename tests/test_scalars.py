import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from codeledger.functions import scalars as s


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "size, loc, label",
    [
        (None, None, "Empty/Minimal"),
        (2e6, 99, "Docs/Data"),
        (999_999, 100, "Tiny"),
        (1e6, 100, "Small"),
        (1e7, 100, "Medium"),
        (1e8, 100, "Large"),
        (1e9, 100, "Massive"),
    ],
)
def test_size_class(spark, size, loc, label):
    size_col = F.lit(size).cast("double")
    assert one(spark, s.size_class(size_col, F.lit(loc).cast("int"))) == label


@pytest.mark.parametrize(
    "url, host, ssh, error",
    [
        ("https://github.com/o/r", "github.com", "git@github.com:o/r.git", None),
        ("https://github.com/o/r.git", "github.com", "git@github.com:o/r.git", None),
        ("https://github.com/o", "github.com", None, "URL not recognized as a valid GitHub URL: https://github.com/o"),
        ("https://b.x/scm/key/r.git", "b.x", "ssh://git@b.x:7999/key/r.git", None),
        ("https://g.x/a/b/c/r.git", "g.x", "git@g.x:a/b/c/r.git", None),
        ("https://g.x/r", "g.x", None, "URL not recognized as a valid GitLab URL: https://g.x/r"),
        ("ssh://git@b.x/r", "anything", "ssh://git@b.x/r", None),
        ("git@h:o/r", "anything", "git@h:o/r", None),
        ("http://h/r", "h", None, "Unsupported URL format: http://h/r"),
        ("https://h/r", "h", None, "Unsupported host_name 'h' for URL: https://h/r"),
        ("git@h:o/r", "", None, "repo.host_name is required"),
        ("git@h:o/r", None, None, "repo.host_name is required"),
    ],
)
def test_ssh_clone_url(spark, url, host, ssh, error):
    found = one(spark, s.ssh_clone_url(F.lit(url), F.lit(host).cast("string"), "b.x", "g.x"))
    assert (found["url"], found["error"]) == (ssh, error)


@pytest.mark.parametrize(
    "last, status",
    [("2024-01-01", "INACTIVE"), ("2023-12-31", "INACTIVE"), ("2024-01-02", "ACTIVE"), ("2025-06-01", "ACTIVE")],
)
def test_activity_status(spark, last, status):
    last_commit = F.lit(last).cast("timestamp")
    assert one(spark, s.activity_status(last_commit, "2025-01-01 00:00:00")) == status


def test_whole_days_round_towards_the_past(spark):
    def days(later, earlier):
        return one(spark, s.whole_days_between(s.as_timestamp(later), s.as_timestamp(earlier)))

    assert days("2025-01-02 00:00:00", "2025-01-01 00:00:00") == 1
    assert days("2025-01-01 23:59:59", "2025-01-01 00:00:00") == 0
    assert days("2025-01-01 00:00:00", "2025-01-01 00:00:01") == -1


def test_python_round_equals_python(spark):
    rng = random.Random(7)
    values = [2.675, 1.005, 0.125, 0.375, -0.125, 2.5, 1e9 + 0.005, 0.0]
    values += [rng.uniform(-1e4, 1e4) for _ in range(500)] + [rng.randrange(4000) / 8 for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for v, rounded in df.select("v", s.python_round(F.col("v"), 2)).collect():
        assert rounded == round(v, 2), v


def test_iso_timestamp_shows_the_fraction_only_when_there_is_one(spark):
    assert one(spark, s.iso_timestamp(F.lit("2024-03-01 04:05:06").cast("timestamp"))) == "2024-03-01T04:05:06"
    with_micros = F.lit("2024-03-01 04:05:06.000120").cast("timestamp")
    assert one(spark, s.iso_timestamp(with_micros)) == "2024-03-01T04:05:06.000120"


def test_runtime_labels(spark):
    expected = {
        "gradle": "Java", "Maven": "Java", "npm": "Node.js", "Yarn": "Node.js", "Poetry": "Python",
        "Pipenv": "Python", "pip": "Python", "go": "Go", "Go Modules": "Unknown", "pnpm": "Unknown",
        "Setuptools": "Unknown", "Hatch": "Unknown", None: "Unknown", "": "Unknown",
    }
    df = spark.createDataFrame([(k,) for k in expected], "tool string")
    found = {r["tool"]: r["x"] for r in df.select("tool", s.runtime_label(F.col("tool")).alias("x")).collect()}
    assert found == expected


def test_package_coordinate(spark):
    def coordinate(g, a, n):
        return one(spark, s.package_coordinate(*[F.lit(x).cast("string") for x in (g, a, n)]))

    assert coordinate("g", "a", "n") == "g:a"
    assert coordinate("", "a", "n") == "n"
    assert coordinate("g", None, None) == "Unknown"


def test_paths(spark):
    def at(fn, path, *args):
        return one(spark, fn(F.lit(path), *args))

    assert at(s.dirname, "a/b/c.txt") == "a/b"
    assert at(s.dirname, "c.txt") == ""
    assert at(s.basename, "a/b/c.txt") == "c.txt"
    assert at(s.in_excluded_dir, "a/build/c.gradle", s.VERSION_SCAN_EXCLUDED_DIRS)
    assert not at(s.in_excluded_dir, "a/bin/c.gradle", s.VERSION_SCAN_EXCLUDED_DIRS)
    assert at(s.in_excluded_dir, "a/bin/c.gradle", s.BUILD_SCAN_EXCLUDED_DIRS)
    assert not at(s.in_excluded_dir, "buildings/c.gradle", s.BUILD_SCAN_EXCLUDED_DIRS)
    assert at(s.is_gradle_file, "x/gradle/wrapper/gradle-wrapper.properties")
    assert not at(s.is_gradle_file, "wrapper/gradle-wrapper.properties")
    assert at(s.is_gradle_file, "x/settings.gradle.kts")
    assert at(s.in_git_dir, "x/.git/HEAD") and at(s.in_git_dir, ".git/HEAD")
    assert not at(s.in_git_dir, ".gitignore") and not at(s.in_git_dir, "x/.git")


def test_purl_and_artifact_key(spark):
    none = F.lit(None).cast("string")
    g, a = F.lit("g"), F.lit("a")
    assert one(spark, s.maven_purl(g, a, F.lit("1"))) == "pkg:maven/g/a@1"
    assert one(spark, s.maven_purl(g, a, none)) == "pkg:maven/g/a"
    assert one(spark, s.artifact_key(F.lit("p"), g, a)) == "p"
    assert one(spark, s.artifact_key(F.lit(""), g, a)) == "g@a"
    assert one(spark, s.artifact_key(none, g, none)) == "g@None"


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet="0123456789.%-+e ab", max_size=8))
def test_percent_text_never_fails(spark, text):
    value = one(spark, s.percent_text(F.lit(text)))
    try:
        expected = float(text.strip("%")) if text.strip("%").strip() == text.strip("%") else None
    except ValueError:
        expected = None
    assert value == expected
