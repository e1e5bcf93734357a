import datetime
import json
import time

import pytest

from codeledger.sources.files import read_repo_files
from codeledger.sources.rules import CategoryRule
from codeledger.operators.dependencies import infer_build_tool
from codeledger.operators.reports import report_errors
from codeledger.streaming.ingest import ReportIngest, newest_reports, report_file_stream, report_table_stream

from helpers import repo_files, reports, rows


def trivy(*ids):
    return json.dumps({"Results": [{"Target": "t", "Vulnerabilities": [{"VulnerabilityID": i, "Severity": "LOW"} for i in ids]}]})


def test_files_arrive_in_two_runs(spark, tmp_path):
    root, checkpoint = tmp_path / "reports", str(tmp_path / "checkpoint")
    for tool in ("trivy", "syft", "unknown"):
        (root / tool).mkdir(parents=True)
    (root / "trivy" / "org%2Fa.json").write_text(trivy("CVE-1", "CVE-2"))
    (root / "trivy" / "b.json").write_text(trivy("CVE-3"))
    (root / "syft" / "b.json").write_text('{"artifacts":[{"name":"kafka","version":"1","type":"python"}]}')
    (root / "unknown" / "b.json").write_text("whatever")
    rules = [CategoryRule("python", 0, "kafka", "Msg", "Q", "K")]
    ingest = ReportIngest(spark, str(tmp_path / "tables"), rules)

    def run():
        ingest.start(report_file_stream(spark, str(root)), checkpoint).awaitTermination()
        return rows(ingest.table("trivy").read(), "repo_id", "vulnerability_id")

    assert run() == [("b", "CVE-3"), ("org/a", "CVE-1"), ("org/a", "CVE-2")]
    assert rows(ingest.table("syft").read(), "package_name", "category") == [("kafka", "Msg")]
    time.sleep(1.1)
    later = root / "later" / "trivy"
    later.mkdir(parents=True)
    (later / "org%2Fa.json").write_text(trivy("CVE-9"))
    (later / "b.json").write_text("{broken")
    assert run() == [("b", "CVE-3"), ("org/a", "CVE-9")]
    assert run() == [("b", "CVE-3"), ("org/a", "CVE-9")]
    found = rows(ingest.log().read(), "run_id", "repo_id", "stage", "status", "message")
    assert found == [
        ("ingest-0", "b", "syft", "SUCCESS", "stored"), ("ingest-0", "b", "trivy", "SUCCESS", "stored"),
        ("ingest-0", "org/a", "trivy", "SUCCESS", "stored"), ("ingest-1", "b", "trivy", "FAILURE", "not valid JSON"),
        ("ingest-1", "org/a", "trivy", "SUCCESS", "stored"),
    ]


def test_repeated_batches_change_nothing(spark, tmp_path):
    ingest = ReportIngest(spark, str(tmp_path / "tables"))
    enry = reports(spark, "enry", "70%\tJava\n30%\tGo", "100% C")
    for _ in range(2):  # the same batch, then the same reports in a later one
        ingest.write_batch(enry)
        ingest.write_batch(enry, 1)
        assert rows(ingest.table("enry").read(), "repo_id", "language", "percent_usage") == [
            ("r0", "Go", 30.0), ("r0", "Java", 70.0), ("r1", "C", 100.0),
        ]


def test_empty_results_clear_or_keep(spark, tmp_path):
    ingest = ReportIngest(spark, str(tmp_path / "tables"))
    ingest.write_batch(reports(spark, "trivy", trivy("CVE-1")), 0)
    ingest.write_batch(reports(spark, "grype", '{"matches":[{"vulnerability":{"id":"CVE-1"}}]}'), 1)
    ingest.write_batch(reports(spark, "trivy", trivy()), 2)
    ingest.write_batch(reports(spark, "grype", '{"matches":[]}'), 3)
    assert ingest.table("trivy").read().count() == 0
    assert rows(ingest.table("grype").read(), "cve") == [("CVE-1",)]


def test_wrong_shapes_keep_older_rows(spark, tmp_path):
    ingest = ReportIngest(spark, str(tmp_path / "tables"))
    ingest.write_batch(reports(spark, "trivy", trivy("CVE-1")), 0)
    ingest.write_batch(reports(spark, "cloc", '{"C": {"nFiles": 1, "blank": 2, "comment": 3, "code": 4}}'), 0)
    wrong = {
        "trivy": ['{"Results": {}}', "[]", '{"Results": [1]}'],
        "cloc": ["[1,2]", '{"C": {"nFiles": "3", "blank": 1, "comment": 1, "code": 1}}', '{"C": 5}'],
        "grype": ['{"matches": "x"}', "7"],
        "syft": ['{"artifacts": {"a": 1}}'],
        "checkov": ["[1]", '"text"'],
    }
    for tool, bodies in wrong.items():
        found = report_errors(reports(spark, tool, *bodies)).collect()
        assert [r["reason"] for r in found] == ["unexpected shape"] * len(bodies), tool
    ingest.write_batch(reports(spark, "trivy", '{"Results": {}}'), 1)
    ingest.write_batch(reports(spark, "cloc", "[1,2]"), 2)
    assert rows(ingest.table("trivy").read(), "vulnerability_id") == [("CVE-1",)]
    assert rows(ingest.table("cloc").read(), "code") == [(4,)]
    fine = {"trivy": ["{}", '{"Results": null}'], "cloc": ['{"header": {"x": 1}, "SUM": {}}'], "checkov": ['{"passed": 1}', '[{"check_type": "x"}]']}
    for tool, bodies in fine.items():
        assert report_errors(reports(spark, tool, *bodies)).count() == 0, tool


def test_one_of_equal_reports_counts(spark, tmp_path):
    bodies = [trivy("CVE-1"), trivy("CVE-2"), trivy("CVE-2")]
    same = spark.createDataFrame([("r", "trivy", b, 7) for b in bodies], "repo_id string, tool string, body string, modified int")
    assert newest_reports(same).count() == 1
    assert newest_reports(same.drop("modified")).count() == 1
    ingest = ReportIngest(spark, str(tmp_path / "tables"))
    ingest.write_batch(same)
    assert ingest.table("trivy").read().count() == 1


TIMED = "repo_id string, tool string, body string, modified timestamp"


def timed(spark, *entries):
    rows = [(repo, tool, body, day and datetime.datetime(2024, 1, day)) for repo, tool, body, day in entries]
    return spark.createDataFrame(rows, TIMED)


def test_late_reports_change_nothing(spark, tmp_path):
    ingest = ReportIngest(spark, str(tmp_path / "tables"))
    match = '{"matches":[{"vulnerability":{"id":"%s"}}]}'
    ingest.write_batch(timed(spark, ("a", "trivy", trivy("A5"), 5), ("b", "trivy", trivy("B2"), 2), ("a", "grype", match % "G1", 1), ("n", "trivy", trivy("N0"), None)), 0)
    late = timed(spark, ("a", "trivy", trivy("A1"), 1), ("b", "trivy", trivy("B3"), 3), ("a", "grype", match % "G2", 2), ("n", "trivy", trivy("N1"), None), ("c", "trivy", trivy("C1"), 1))
    for _ in range(2):  # delivered twice
        ingest.write_batch(late, 1)
    # an unreadable report does not make an older one late; of equal times the later batch counts; no time comes before any
    ingest.write_batch(timed(spark, ("c", "trivy", "{broken", 9), ("a", "trivy", trivy("A5b"), 5)), 2)
    ingest.write_batch(timed(spark, ("c", "trivy", trivy("C4"), 4), ("b", "trivy", trivy("B0"), None)), 3)
    assert rows(ingest.table("trivy").read(), "repo_id", "vulnerability_id") == [("a", "A5b"), ("b", "B3"), ("c", "C4"), ("n", "N1")]
    assert rows(ingest.table("grype").read(), "cve") == [("G2",)]
    log = rows(ingest.log().read().where("message <> 'stored'"), "run_id", "repo_id", "stage", "status", "message")
    assert log == [
        ("ingest-1", "a", "trivy", "SUCCESS", "older than the stored report"),
        ("ingest-2", "c", "trivy", "FAILURE", "not valid JSON"),
        ("ingest-3", "b", "trivy", "SUCCESS", "older than the stored report"),
    ]


def test_a_batch_that_broke_off_is_no_late_one(spark, tmp_path, monkeypatch):
    ingest = ReportIngest(spark, str(tmp_path / "tables"))
    batch = timed(spark, ("a", "trivy", trivy("A5"), 5), ("a", "grype", '{"matches":[{"vulnerability":{"id":"G"}}]}', 5))
    real = ReportIngest.table

    def fails(self, tool):
        if tool == "trivy":
            raise OSError("lost")
        return real(self, tool)

    monkeypatch.setattr(ReportIngest, "table", fails)
    with pytest.raises(OSError):
        ingest.write_batch(batch, 0)
    monkeypatch.setattr(ReportIngest, "table", real)
    ingest.write_batch(batch, 0)
    assert rows(ingest.table("trivy").read(), "vulnerability_id") == [("A5",)]
    assert rows(ingest.table("grype").read(), "cve") == [("G",)]


def test_bodies_are_scanned_once_for_all_tools(spark, tmp_path):
    bodies = {
        "cloc": '{"C": {"nFiles": 1, "blank": 2, "comment": 3, "code": 4}}', "lizard": "1,2,3,4,5,6,7,8,9,10,11", "enry": "100% C",
        "trivy": trivy("T"), "grype": '{"matches": []}', "xeol": '{"matches": []}', "semgrep": '{"results": []}',
        "checkov": '{"passed": 1}', "syft": '{"artifacts": []}',
    }
    path = str(tmp_path / "incoming")
    timed(spark, *((f"r{i}", tool, body, 1) for tool, body in bodies.items() for i in range(20))).write.parquet(path)
    ingest = ReportIngest(spark, str(tmp_path / "tables"))
    run = ingest.start(report_table_stream(spark, path), str(tmp_path / "checkpoint"))
    run.awaitTermination()
    # a source that is scanned again for a sink counts its rows again
    assert sum(p.numInputRows for p in run.recentProgress) == 180
    assert ingest.log().read().count() == 180


def test_merged_dependencies_and_their_order(spark, tmp_path):
    """The first package by lower-case name decides the build tool, also after it was stored."""
    body = json.dumps({"artifacts": [{"name": "Zlib", "version": "1", "type": "python"}, {"name": "axios", "version": "1", "type": "npm"}]})
    files = repo_files(spark, ("build.gradle", "dependencies { implementation 'g:a:1' }", "r0"))
    ingest = ReportIngest(spark, str(tmp_path / "tables"), repo_files=files)
    ingest.write_batch(reports(spark, "syft", body))
    stored = ingest.table("syft").read()
    assert {"Zlib", "axios"} <= {r["package_name"] for r in stored.collect()}
    assert rows(infer_build_tool(stored), "build_tool") == [("node",)]


def test_file_corpus(spark, tmp_path):
    (tmp_path / "org%2Fa" / "src").mkdir(parents=True)
    (tmp_path / "b").mkdir()
    (tmp_path / "org%2Fa" / "src" / "x y.txt").write_text("é\n")
    (tmp_path / "b" / "bin").write_bytes(b"\xff\xfe\x00")
    found = read_repo_files(spark, str(tmp_path))
    assert rows(found) == [("b", "bin", 3, None), ("org/a", "src/x y.txt", 3, "é\n")]
