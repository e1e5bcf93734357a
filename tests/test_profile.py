import json

import pytest

from codeledger import schemas
from codeledger.plans import derived
from codeledger.plans import profile as p

from helpers import rows

TABLES = {
    "inventory": schemas.INVENTORY,
    "repo_metrics": schemas.REPO_METRICS,
    "lizard_summary": schemas.LIZARD_SUMMARY,
    "languages": schemas.LANGUAGES,
    "cloc_metrics": schemas.CLOC_METRICS,
    "syft_dependencies": schemas.SYFT_DEPENDENCIES,
    "build_tools": schemas.BUILD_TOOLS,
    "grype_results": schemas.GRYPE_RESULTS,
    "trivy_vulnerability": schemas.TRIVY_VULNERABILITY,
    "xeol_results": schemas.XEOL_RESULTS,
    "semgrep_results": schemas.SEMGREP_RESULTS,
    "iac_components": schemas.IAC_COMPONENTS,
    "recent_commits": schemas.RECENT_COMMITS,
}


@pytest.fixture
def tables(spark):
    from datetime import datetime

    at, commit = datetime(2025, 1, 1), datetime(2024, 12, 31, 8, 0, 0, 500)
    data = {
        "inventory": [
            ("r1", "One", "K", "one", "app", "github.com", None, "tc", "git@x", "https://x", "", None, at),
            ("r2", "Two", "K", "two", None, "github.com", None, None, None, None, "NEW", None, at),
            ("no-metrics", "N", "K", "n", None, None, None, None, None, None, None, None, at),
        ],
        "repo_metrics": [
            ("r1", 2_675_000.0, 125_000.0, 7, 11, 4, "ACTIVE", commit, 730, 2, 5, 10, at),
            ("r2", 10.0, 0.0, 0, 1, 1, None, None, 0, 0, None, None, at),
            ("no-inventory", 1.0, 1.0, 1, 1, 1, "ACTIVE", commit, 1, 1, 1, 1, at),
        ],
        "lizard_summary": [("r1", 30, 2.675, 140, 2, 6)],
        "languages": [("r1", "Java", 50.004, at), ("r1", "Go", 49.996, at), ("r1", "C", 50.001, at)],
        "cloc_metrics": [("r1", "Java", 1, 5, 4, 90), ("r1", "C", 1, 1, 1, 10)],
        "syft_dependencies": [
            ("r1", "b", "1", "npm", "MIT", "/p", "js", "UI", "x", " React ", ("b", 0, None, 1)),
            ("r1", "a", "2", "python", "", "", "py", "Other", "", "", ("a", 0, None, 2)),
            ("r1", "c", "2", "python", "", "", "py", "UI", "x", "React", ("c", 0, None, 0)),
        ],
        "build_tools": [("r1", "gradle", "8", "17"), ("r1", "Go Modules", None, "1.21"), ("r1", "pip", None, None)],
        "grype_results": [("r1", "CVE", "d", "Critical", "js", "b", "1", "2", "fixed", "/p", None)],
        "trivy_vulnerability": [
            ("r1", "t", None, None, "CVE", "b", "1", "3", "Critical", None, None),
            ("r1", "t", None, None, "CVE", "b", "1", "3", "CRITICAL", None, None),
            ("r1", "t", None, None, "CVE", None, "1", "3", "LOW", None, None),
        ],
        "xeol_results": [("r1", "N", "u", "14", "2023-04-30", "14.2", "u", "u", "node", "14.0", "binary", "N/A", "u")],
        "semgrep_results": [("r1", "a.py", 3, 4, "rule", "ERROR", "m", "security", "", "flask", "CWE", "L", "H", "M")],
        "iac_components": [
            ("r1", "one", "One", "Dockerfile", "Container Platform", "Image", "Dockerfile", at),
            ("r1", "one", "One", "x", "Container Platform", "Image", "Dockerfile", at),
        ],
        "recent_commits": [("r1", commit), ("r1", at), ("no-inventory", at)],
    }
    return p.ProfileTables(**{n: spark.createDataFrame(data[n], schema) for n, schema in TABLES.items()})


FULL = {
    "Repo ID": "r1", "Repo Name": "One", "Status": "Unknown", "VCS Hostname": "github.com", "App ID": "app", "TC": "tc",
    "Last Updated": "2025-01-01T00:00:00", "Clone URL SSH": "git@x", "Browse URL": "https://x",
    "Repo Size (MB)": round(2_675_000.0 / 1_000_000, 2), "Code Size (MB)": round(0.125, 2), "File Count": 7,
    "Total Commits": 11, "Contributors": 4, "Activity Status": "ACTIVE",
    "Last Commit Date": "2024-12-31T08:00:00.000500", "Repo Age (Years)": 2.0, "Active Branch Count": 2,
    "Top Contributor Commits": 5, "Commits by Top 3 Contributors": 10,
    "Recent Commit Dates": ["2025-01-01T00:00:00", "2024-12-31T08:00:00.000500"],
    "Language Percentages": {"C": 50.0, "Go": 50.0, "Java": 50.0}, "Main Language": "C",
    "Other Languages": ["Go", "Java"], "Total NLOC": 30, "Avg Cyclomatic Complexity": 2.67, "Total Tokens": 140,
    "Total Functions": 2, "Total Cyclomatic Complexity": 6, "Lines of Code": 100, "Blank Lines": 6, "Comment Lines": 5,
    "total_loc": 100, "Classification Label": "Small",
    "Dependencies": [
        {"name": "a", "version": "2", "package_type": "python", "language": "py", "locations": "", "licenses": "",
         "category": "Other", "sub_category": "", "framework": ""},
        {"name": "b", "version": "1", "package_type": "npm", "language": "js", "locations": "/p", "licenses": "MIT",
         "category": "UI", "sub_category": "x", "framework": " React "},
        {"name": "c", "version": "2", "package_type": "python", "language": "py", "locations": "", "licenses": "",
         "category": "UI", "sub_category": "x", "framework": "React"},
    ],
    "Total Dependencies": 3, "Frameworks": ["React"], "Build Tool": "python",
    "Runtime Version": "Java:17, Python:Unknown, Unknown:1.21",
    "Vulnerabilities": [
        {"package": "b", "version": "1", "severity": "CRITICAL", "fix_version": "3", "source": "Trivy"},
        {"package": "b", "version": "1", "severity": "Critical", "fix_version": "2", "source": "Grype"},
    ],
    "Critical Vuln Count": 1, "Vulnerable Dependencies %": round(2 / 3 * 100, 2),
    "EOL Results": [{"artifact_name": "node", "artifact_version": "14.0", "eol_date": "2023-04-30", "latest_release": "14.2"}],
    "EOL Packages Found": 1,
    "Semgrep Findings": [{"path": "a.py", "rule_id": "rule", "severity": "ERROR", "category": "security",
                          "subcategory": "", "likelihood": "L", "impact": "H", "confidence": "M"}],
    "Modernization Signals": {"Dockerfile": True, "CI/CD Pipeline": False, "IaC Config": True},
    "IaC Frameworks": ["Dockerfile"],
}


def test_documents(tables):
    profiles = p.build_profiles(tables)
    documents = {r["repo_id"]: json.loads(r["profile_json"]) for r in p.profile_documents(profiles).collect()}
    assert set(documents) == {"r1", "r2"}
    assert documents["r1"] == FULL
    assert list(documents["r1"]) == list(FULL)
    bare = documents["r2"]
    assert (bare["Status"], bare["Activity Status"], bare["Last Commit Date"]) == ("NEW", "Unknown", None)
    assert (bare["Language Percentages"], bare["Main Language"], bare["Other Languages"]) == ({}, None, [])
    assert (bare["Build Tool"], bare["Runtime Version"], bare["Classification Label"]) == ("Unknown", None, "Empty/Minimal")
    assert (bare["Vulnerabilities"], bare["Critical Vuln Count"], bare["Vulnerable Dependencies %"]) == ([], 0, 0.0)
    assert bare["Top Contributor Commits"] == 0 and bare["Recent Commit Dates"] == []
    assert bare["Modernization Signals"] == {"Dockerfile": False, "CI/CD Pipeline": False, "IaC Config": False}
    assert all(bare[k] == 0 for k in ("Total NLOC", "Avg Cyclomatic Complexity", "Lines of Code", "EOL Packages Found"))


def test_rejects(tables):
    assert rows(p.profile_rejects(tables)) == [
        ("no-inventory", "Missing repository or metrics for no-inventory"),
        ("no-metrics", "Missing repository or metrics for no-metrics"),
    ]


def test_layout_and_documents_do_not_depend_on_the_size_of_parts(spark, tables):
    whole = {r["repo_id"]: r["profile"] for r in p.assembled(p.build_profiles(tables)).collect()}
    profiles = p.build_profiles(tables, part_items=1)
    assert {r["repo_id"]: r["profile"] for r in p.assembled(profiles).collect()} == whole
    one = p.profile_documents(profiles, spark.createDataFrame([("r1",)], "repo_id string")).collect()
    assert [json.loads(r["profile_json"]) for r in one] == [FULL]
    assert "Dependencies" not in profiles.scalars.schema["profile"].dataType.names
    found = {}
    for r in p.section_rows(profiles).collect():
        for entry in json.loads(r["items_json"]):
            found.setdefault((r["repo_id"], r["section"]), []).extend([entry["item"]] * entry["copies"])
    assert sorted(d["name"] for d in found["r1", "Dependencies"]) == ["a", "b", "c"]
    assert sorted(found["r1", "Runtime Version"]) == ["Java:17", "Python:Unknown", "Unknown:1.21"]
    assert {k[0] for k in found} == {"r1"}


def test_a_repository_with_most_rows(spark, tables):
    from dataclasses import replace
    from datetime import datetime

    hot = spark.range(9000).selectExpr("'r2' as repo_id", "timestamp_seconds(id % 100) as committed_at")
    profiles = p.build_profiles(replace(tables, recent_commits=tables.recent_commits.unionByName(hot)), part_items=10)
    parts = profiles.sections["Recent Commit Dates"].where("repo_id = 'r2'").collect()
    assert sum(i["copies"] for r in parts for i in r["items"]) == 9000 and max(len(r["items"]) for r in parts) <= 20
    document = p.assembled(profiles, spark.createDataFrame([("r2",)], "repo_id string")).first()["profile"]
    assert len(document["Recent Commit Dates"]) == 9000
    assert document["Recent Commit Dates"][0] == datetime(1970, 1, 1, 0, 1, 39).isoformat()


def test_cached_documents_are_replaced(spark, tables, tmp_path):
    from codeledger.sinks.tables import KeyedTable

    cache = KeyedTable(spark, str(tmp_path / "cache"), schemas.PROFILE_CACHE)
    profiles = p.build_profiles(tables)
    for _ in range(2):
        p.cache_profiles(profiles, cache)
    assert rows(cache.read(), "repo_id") == [("r1",), ("r2",)]


def test_language_order_decides_ties_and_the_last_duplicate_counts(spark):
    data = [("r", "Go", 10.0, 0), ("r", "Java", 50.0, 1), ("r", "C", 50.0, 2), ("r", "Go", 50.001, 3)]
    shares = spark.createDataFrame(data, "repo_id string, language string, percent_usage double, line_no int")
    found = p.language_section(shares, "line_no").first()
    assert found["shares"] == {"Go": 50.0, "Java": 50.0, "C": 50.0}
    assert found["main"] == "Go" and found["others"] == ["Java", "C"]


def test_derived_tables(spark, tables):
    combined = derived.combined_repo_metrics(tables.inventory, tables.repo_metrics, tables.languages, tables.cloc_metrics)
    assert combined.columns == [f.split()[0] for f in schemas.COMBINED_REPO_METRICS.split(", ")]
    assert rows(combined, "repo_id", "main_language", "classification_label", "number_of_contributors") == [
        ("no-metrics", None, "Empty/Minimal", None), ("r1", "Java", "Small", 4), ("r2", None, "Empty/Minimal", 1),
    ]
    selected = combined.select("repo_id", "status")
    full = derived.with_inventory_columns(selected, tables.inventory)
    assert rows(full, "repo_id", "repo_slug") == [("no-metrics", "n"), ("r1", "one"), ("r2", "two")]
    components = spark.createDataFrame([("K", "two", 5)], "project_key string, repo_slug string, component_id int")
    assert rows(derived.component_repositories(components, tables.inventory), "component_id", "repo_id") == [(5, "r2")]
