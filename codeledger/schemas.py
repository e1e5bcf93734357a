"""Table and report schemas as Spark DDL."""

from __future__ import annotations

INVENTORY = (
    "repo_id string, repo_name string, project_key string, repo_slug string, app_id string, "
    "host_name string, tc_cluster string, tc string, clone_url_ssh string, browse_url string, "
    "status string, comment string, updated_on timestamp"
)
COMBINED_REPO_METRICS = (
    "repo_id string, host_name string, activity_status string, status string, tc string, "
    "main_language string, classification_label string, app_id string, "
    "number_of_contributors int, clone_url_ssh string, updated_at timestamp"
)
COMMITS = "repo_id string, author_email string, committed_at timestamp"
BRANCHES = "repo_id string, ref string"
REPO_FILES = "repo_id string, path string, size bigint, content string"
REPORTS = "repo_id string, tool string, body string"
LANGUAGES = "repo_id string, language string, percent_usage double, analysis_date timestamp"
REPO_METRICS = (
    "repo_id string, repo_size_bytes double, code_size_bytes double, file_count int, "
    "total_commits int, number_of_contributors int, activity_status string, "
    "last_commit_date timestamp, repo_age_days int, active_branch_count int, "
    "top_contributor_commits int, commits_by_top_3_contributors int, updated_at timestamp"
)
RECENT_COMMITS = "repo_id string, committed_at timestamp"
LIZARD_SUMMARY = (
    "repo_id string, total_nloc int, avg_ccn double, total_token_count int, "
    "function_count int, total_ccn int"
)
CLOC_METRICS = "repo_id string, language string, files int, blank int, comment int, code int"
GRYPE_RESULTS = (
    "repo_id string, cve string, description string, severity string, language string, "
    "package string, version string, fix_versions string, fix_state string, file_path string, "
    "cvss string"
)
TRIVY_VULNERABILITY = (
    "repo_id string, target string, resource_class string, resource_type string, "
    "vulnerability_id string, pkg_name string, installed_version string, fixed_version string, "
    "severity string, primary_url string, description string"
)
XEOL_RESULTS = (
    "repo_id string, product_name string, product_permalink string, release_cycle string, "
    "eol_date string, latest_release string, latest_release_date string, release_date string, "
    "artifact_name string, artifact_version string, artifact_type string, file_path string, "
    "language string"
)
SEMGREP_RESULTS = (
    "repo_id string, path string, start_line int, end_line int, rule_id string, "
    "severity string, message string, category string, subcategory string, technology string, "
    "cwe string, likelihood string, impact string, confidence string"
)
CHECKOV_SUMMARY = (
    "repo_id string, check_type string, passed int, failed int, skipped int, "
    "resource_count int, parsing_errors int"
)
SYFT_DEPENDENCIES = (
    "repo_id string, package_name string, version string, package_type string, "
    "licenses string, locations string, language string, category string, "
    "sub_category string, framework string, "
    "ord struct<name_key: string, source_ord: int, path: string, pos: int>"
)
DEPENDENCIES = (
    "repo_id string, name string, version string, package_type string, category string, "
    "sub_category string"
)
BUILD_TOOLS = "repo_id string, tool string, tool_version string, runtime_version string"
IAC_COMPONENTS = (
    "repo_id string, repo_slug string, repo_name string, file_path string, category string, "
    "subcategory string, framework string, scan_timestamp timestamp"
)
COMPONENT_MAPPING = (
    "component_id int, component_name string, tc string, mapping_type string, "
    "instance_url string, tool_type string, name string, identifier string, web_url string, "
    "project_key string, repo_slug string"
)
EXECUTION_LOG = (
    "method_name string, stage string, run_id string, repo_id string, status string, "
    "message string, execution_time timestamp, duration double"
)
PROFILE_CACHE = "repo_id string, profile_json string"

# Natural keys of the tables the sinks write.
UNIQUE_KEYS = {
    "dependencies": ["repo_id", "name", "version"],
    "build_tools": ["repo_id", "tool", "tool_version", "runtime_version"],
}

# Report bodies.  ``_corrupt_record`` is filled by from_json for malformed text.
CLOC_REPORT = "map<string, struct<nFiles: int, blank: int, comment: int, code: int>>"
TRIVY_REPORT = (
    "struct<Results: array<struct<Target: string, Class: string, Type: string, "
    "Vulnerabilities: array<struct<VulnerabilityID: string, PkgName: string, "
    "InstalledVersion: string, FixedVersion: string, Severity: string, PrimaryURL: string, "
    "Description: string>>>>, _corrupt_record: string>"
)
GRYPE_REPORT = (
    "struct<matches: array<struct<"
    "vulnerability: struct<id: string, description: string, severity: string, "
    "fix: struct<versions: array<string>, state: string>>, "
    "artifact: struct<name: string, version: string, language: string, "
    "metadata: struct<pomGroupID: string, pomArtifactID: string>, "
    "locations: array<struct<path: string>>>>>, _corrupt_record: string>"
)
XEOL_REPORT = (
    "struct<matches: array<struct<"
    "Cycle: struct<ProductName: string, ProductPermalink: string, ReleaseCycle: string, "
    "Eol: string, LatestRelease: string, LatestReleaseDate: string, ReleaseDate: string>, "
    "artifact: struct<name: string, version: string, type: string, language: string, "
    "locations: array<struct<path: string>>>>>, _corrupt_record: string>"
)
# cwe, technology and subcategory may be text or a list: read as raw JSON text.
SEMGREP_REPORT = (
    "struct<results: array<struct<check_id: string, path: string, "
    "start: struct<line: int>, `end`: struct<line: int>, "
    "extra: struct<severity: string, message: string, metadata: struct<"
    "category: string, subcategory: string, technology: string, cwe: string, "
    "likelihood: string, impact: string, confidence: string>>>>, _corrupt_record: string>"
)
_CHECK_COUNTS = (
    "passed: int, failed: int, skipped: int, parsing_errors: int, resource_count: int"
)
CHECKOV_REPORT = (
    f"array<struct<check_type: string, summary: struct<{_CHECK_COUNTS}>, {_CHECK_COUNTS}>>"
)
ARTIFACT = (
    "struct<name: string, version: string, type: string, language: string, purl: string, "
    "licenses: array<struct<value: string>>, locations: array<struct<path: string>>, "
    "metadata: struct<pomProperties: struct<groupId: string, artifactId: string>>>"
)
SYFT_REPORT = f"struct<artifacts: array<{ARTIFACT}>, _corrupt_record: string>"
LIZARD_ROW = (
    "nloc int, ccn int, token_count int, param int, function_length int, location string, "
    "file_name string, function_name string, long_name string, start_line int, end_line int"
)
