import json

from codeledger.operators import reports as r
from codeledger.operators.dependencies import sbom_dependencies
from codeledger.operators.reports import syft_artifacts
from codeledger.plans.profile import loc_totals
from codeledger.sources import reports as sources
from codeledger.sources.reports import read_reports

from helpers import reports, rows


def test_cloc(spark):
    body = (
        '{"header":{"n_files":3,"cloc_version":"1.9"},"Python":{"nFiles":2,"blank":5,"comment":3,"code":40},'
        '"YAML":{"nFiles":1,"blank":0,"comment":1,"code":9},"SUM":{"nFiles":3,"blank":5,"comment":4,"code":49}}'
    )
    parsed = r.parse_cloc(reports(spark, "cloc", body))
    assert rows(parsed) == [("r0", "Python", 2, 5, 3, 40), ("r0", "YAML", 1, 0, 1, 9)]
    assert rows(loc_totals(parsed)) == [("r0", 49, 5, 4)]


LIZARD = (
    '10,2,50,1,12,"f@1-12@./a.py","./a.py","f","f( a )",1,12\n'
    '20,4,90,1,22,"g@1-22@./a.py","./a.py","g","g( a )",1,22\n'
    '30,9,99,2,33,"h@1-33@./a.py","./a.py","h","h( a , b )",1,33\n'
)


def test_lizard(spark):
    given = reports(spark, "lizard", LIZARD, "no functions", LIZARD.replace("20,", "x,", 1))
    assert rows(r.parse_lizard(given)) == [("r0", 30, 3.0, 140, 2, 6)]
    assert rows(r.parse_lizard(given, strict=False)) == [("r0", 60, 5.0, 239, 3, 15)]
    from codeledger.sources.reports import report_lines

    assert rows(r.complexity_errors(report_lines(given))) == [("r2",)]


def test_enry(spark):
    given = reports(spark, "enry", "70.50%\tJava\n29.25%\tJava Server Pages\nabc\tBad\n12%\n\n 1e1%  Go  \r\n")
    assert rows(r.parse_enry(given), "language", "percent_usage") == [
        ("Go", 10.0), ("Java", 70.5), ("Java Server Pages", 29.25),
    ]


def test_trivy(spark):
    body = json.dumps(
        {
            "Results": [
                {
                    "Target": "pom.xml", "Class": "lang-pkgs", "Type": "pom",
                    "Vulnerabilities": [
                        {"VulnerabilityID": "CVE-1", "PkgName": "a:b", "InstalledVersion": "1",
                         "FixedVersion": "2", "Severity": "CRITICAL"}
                    ],
                },
                {"Target": "Dockerfile", "Class": "config", "Type": "dockerfile"},
                {"Target": "x", "Vulnerabilities": None},
            ]
        }
    )
    assert rows(r.parse_trivy(reports(spark, "trivy", body, "{}"))) == [
        ("r0", "pom.xml", "lang-pkgs", "pom", "CVE-1", "a:b", "1", "2", "CRITICAL", None, None)
    ]


def test_grype(spark):
    body = json.dumps(
        {
            "matches": [
                {
                    "vulnerability": {"id": "CVE-1", "severity": "Critical", "fix": {"versions": ["2", "3"], "state": "fixed"}},
                    "artifact": {
                        "name": "b", "version": "1", "language": "java",
                        "metadata": {"pomGroupID": "a", "pomArtifactID": "b"}, "locations": [{"path": "/x.jar"}],
                    },
                },
                {"vulnerability": {}, "artifact": {"name": "z", "locations": []}},
            ]
        }
    )
    none = "No description provided"
    assert rows(r.parse_grype(reports(spark, "grype", body, '{"matches":[]}'))) == [
        ("r0", "CVE-1", none, "Critical", "java", "a:b", "1", "2, 3", "fixed", "/x.jar", None),
        ("r0", "No CVE", none, "UNKNOWN", "Unknown", "z", "Unknown", "", "not fixed", "N/A", None),
    ]


def test_xeol(spark):
    body = (
        '{"matches":[{"Cycle":{"ProductName":"Node.js","ReleaseCycle":"14","Eol":"2023-04-30",'
        '"LatestRelease":"14.21.3"},"artifact":{"name":"node","version":"14.0.0","type":"binary"}},'
        '{"Cycle":{"Eol":true},"artifact":{}}]}'
    )
    u = "Unknown"
    assert rows(r.parse_xeol(reports(spark, "xeol", body))) == [
        ("r0", "Node.js", u, "14", "2023-04-30", "14.21.3", u, u, "node", "14.0.0", "binary", "N/A", u),
        ("r0", u, u, u, "true", u, u, u, u, u, u, "N/A", u),
    ]


def test_semgrep(spark):
    body = json.dumps(
        {
            "results": [
                {
                    "check_id": "r1", "path": "a.py", "start": {"line": 3}, "end": {"line": 4},
                    "extra": {
                        "severity": "ERROR", "message": "m",
                        "metadata": {"category": "security", "cwe": ["CWE-1", "CWE-2"], "technology": ["flask"]},
                    },
                },
                {
                    "check_id": "r2", "path": "b.py", "start": {"line": 1}, "end": {"line": 1},
                    "extra": {"severity": "INFO", "message": "n", "metadata": {"cwe": "CWE-9"}},
                },
            ]
        }
    )
    assert rows(r.parse_semgrep(reports(spark, "semgrep", body))) == [
        ("r0", "a.py", 3, 4, "r1", "ERROR", "m", "security", "", "flask", "CWE-1, CWE-2", "", "", ""),
        ("r0", "b.py", 1, 1, "r2", "INFO", "n", "", "", "", "CWE-9", "", "", ""),
    ]


CHECKS = [
    '[{"check_type":"terraform","summary":{"passed":1,"failed":2}},{"check_type":"kubernetes","summary":{"passed":4}}]',
    ' {"check_type":"dockerfile","summary":{"passed":3,"failed":0,"skipped":1}}',
    '{"passed":0,"failed":0,"skipped":0,"parsing_errors":0,"resource_count":0}',
    "{}",
    "[ ]",
    "{nope",
]


def test_checkov_shapes(spark):
    columns = ["repo_id", "check_type", "passed", "failed", "skipped"]
    given = reports(spark, "checkov", *CHECKS)
    assert rows(r.parse_checkov(given), *columns) == [
        ("r0", "kubernetes", 4, 0, 0),
        ("r0", "terraform", 1, 2, 0),
        ("r1", "dockerfile", 3, 0, 1),
        ("r2", "no-checks", 0, 0, 0),
    ]
    last = r.parse_checkov(given, last_only=True)
    assert rows(last, "repo_id", "check_type")[0] == ("r0", "kubernetes") and last.count() == 3
    assert rows(r.report_errors(given), "repo_id", "reason") == [
        ("r3", "empty output"), ("r4", "empty output"), ("r5", "not valid JSON"),
    ]
    assert rows(r.valid_reports(given), "repo_id") == [("r0",), ("r1",), ("r2",)]


def test_syft_keeps_the_first_copy(spark):
    body = json.dumps(
        {
            "artifacts": [
                {"name": "requests", "version": "2.31", "type": "python", "language": "python",
                 "licenses": [{"value": "Apache-2.0"}, {}], "locations": [{"path": "/requirements.txt"}]},
                {"name": "requests", "version": "2.31", "type": "python", "locations": [{"path": "/b.txt"}]},
                {"name": "core", "version": "6.1", "type": "java-archive",
                 "metadata": {"pomProperties": {"groupId": "org.x", "artifactId": "core"}}},
                {},
            ]
        }
    )
    deps = sbom_dependencies(syft_artifacts(reports(spark, "syft", body))).drop("ord")
    assert rows(deps) == [
        ("r0", "Unknown", "Unknown", "Unknown", "", "", "Unknown"),
        ("r0", "org.x:core", "6.1", "java-archive", "", "", "Unknown"),
        ("r0", "requests", "2.31", "python", "Apache-2.0, Unknown", "/requirements.txt", "python"),
    ]


def test_report_files(spark, tmp_path):
    folder = tmp_path / "trivy"
    folder.mkdir()
    (folder / "org%2Frepo one.json").write_text('{\n "Results": []\n}')
    found = read_reports(spark, str(tmp_path)).collect()
    assert [tuple(x) for x in found] == [("org/repo one", "trivy", '{\n "Results": []\n}')]


def test_report_files_are_written_by_all_tasks(spark, tmp_path):
    ids = [f"r{i}" for i in range(300)] + ["a/b c+d%41", "_x", ".y", "=", "é", None]
    given = [("trivy", i, f'{{"id": "{i}"}}') for i in ids] + [("trivy", "r1", "again"), ("grype", "r1", None)]
    df = spark.createDataFrame(given, "tool string, repo_id string, body string").coalesce(1)
    sources.write_report_files(df, f"{tmp_path}/made")
    found = {(r.tool, r.repo_id): sorted(r.body.split("\n")) for r in sources.read_reports(spark, f"{tmp_path}/made").collect()}
    want = {("trivy", i or "__HIVE_DEFAULT_PARTITION__"): ["", f'{{"id": "{i}"}}'] for i in ids}
    assert found == {**want, ("trivy", "r1"): ["", "again", '{"id": "r1"}'], ("grype", "r1"): ["", ""]}
    # no folder for each report
    assert sorted(p.name for p in (tmp_path / "made").iterdir()) == ["grype", "trivy"]
    assert len([p for p in (tmp_path / "made" / "trivy").iterdir() if p.is_file()]) == len(ids)
