"""Scanner reports (repo_id, body) to typed rows, one function per report kind.

Each is a map-side job: ``from_json`` with an explicit schema, then ``explode``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeledger import schemas
from codeledger.functions.scalars import (
    first_path,
    joined_field,
    or_default,
    package_coordinate,
    percent_text,
    text_or_list,
)
from codeledger.sources.reports import language_lines, report_lines


def _json(schema: str) -> Column:
    return F.from_json("body", schema)


def parse_cloc(reports: DataFrame) -> DataFrame:
    """Lines per language; the ``header`` and ``SUM`` entries are not languages."""
    entries = reports.select("repo_id", F.explode(_json(schemas.CLOC_REPORT)).alias("language", "m"))
    return entries.where(~F.col("language").isin("header", "SUM")).select(
        "repo_id",
        "language",
        F.col("m.nFiles").alias("files"),
        F.col("m.blank").alias("blank"),
        F.col("m.comment").alias("comment"),
        F.col("m.code").alias("code"),
    )


def complexity_rows(lines: DataFrame, strict: bool = True) -> DataFrame:
    """(repo_id, nloc, ccn, tokens, bad) per function line of a complexity report.

    ``strict`` keeps lines with exactly ten commas, which loses functions whose
    quoted signature holds commas; ``strict=False`` reads real CSV quoting.
    """
    if strict:
        kept = lines.where(F.regexp_count("line", F.lit(",")) == 10)
        fields = F.split("line", ",", 4)
        raw = [F.btrim(fields[i], F.lit('"')) for i in range(3)]
    else:
        text_row = ", ".join(f"c{i} string" for i in range(11))
        row = F.from_csv("line", text_row)
        kept = lines.where(F.regexp_count("line", F.lit(",")) >= 10).withColumn("_row", row)
        kept = kept.where(F.col("_row.c10").isNotNull())
        raw = [F.col(f"_row.c{i}") for i in range(3)]
    numbers = [r.try_cast("int") for r in raw]
    bad = numbers[0].isNull() | numbers[1].isNull() | numbers[2].isNull()
    return kept.select(
        "repo_id",
        numbers[0].alias("nloc"),
        numbers[1].alias("ccn"),
        numbers[2].alias("tokens"),
        bad.alias("bad"),
    )


def _complexity_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("repo_id").agg(
        F.sum("nloc").alias("total_nloc"),
        F.sum("ccn").alias("total_ccn"),
        F.sum("tokens").alias("total_token_count"),
        F.count(F.lit(1)).alias("function_count"),
        F.bool_or("bad").alias("bad"),
    )


def complexity_summary(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Totals per repository; none for a report without a valid or with a bad line."""
    totals = _complexity_totals(complexity_rows(lines, strict)).where(~F.col("bad"))
    return totals.select(
        "repo_id",
        "total_nloc",
        (F.col("total_ccn") / F.col("function_count")).alias("avg_ccn"),
        "total_token_count",
        "function_count",
        "total_ccn",
    )


def complexity_errors(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Repositories whose report holds a line that is not numeric where it must be."""
    return _complexity_totals(complexity_rows(lines, strict)).where("bad").select("repo_id")


def parse_lizard(reports: DataFrame, strict: bool = True) -> DataFrame:
    return complexity_summary(report_lines(reports), strict)


def parse_enry(reports: DataFrame) -> DataFrame:
    """Language shares; lines whose percentage is not a number are skipped."""
    return enry_rows(report_lines(reports))


def enry_rows(lines: DataFrame) -> DataFrame:
    return (
        language_lines(lines)
        .select("repo_id", "line_no", "language", percent_text(F.col("percent_text")).alias("percent_usage"))
        .where(F.col("percent_usage").isNotNull())
    )


def parse_trivy(reports: DataFrame) -> DataFrame:
    """``Results`` x ``Vulnerabilities``; a result without vulnerabilities has no row."""
    results = reports.select("repo_id", F.explode(_json(schemas.TRIVY_REPORT)["Results"]).alias("r"))
    found = results.select("repo_id", "r.Target", "r.Class", "r.Type", F.explode("r.Vulnerabilities").alias("v"))
    return found.select(
        "repo_id",
        F.col("Target").alias("target"),
        F.col("Class").alias("resource_class"),
        F.col("Type").alias("resource_type"),
        F.col("v.VulnerabilityID").alias("vulnerability_id"),
        F.col("v.PkgName").alias("pkg_name"),
        F.col("v.InstalledVersion").alias("installed_version"),
        F.col("v.FixedVersion").alias("fixed_version"),
        F.col("v.Severity").alias("severity"),
        F.col("v.PrimaryURL").alias("primary_url"),
        F.col("v.Description").alias("description"),
    )


def parse_grype(reports: DataFrame) -> DataFrame:
    matches = reports.select("repo_id", F.explode(_json(schemas.GRYPE_REPORT)["matches"]).alias("m"))
    vuln, art = F.col("m.vulnerability"), F.col("m.artifact")
    meta = art.getField("metadata")
    return matches.select(
        "repo_id",
        or_default(vuln.getField("id"), "No CVE").alias("cve"),
        or_default(vuln.getField("description"), "No description provided").alias("description"),
        or_default(vuln.getField("severity"), "UNKNOWN").alias("severity"),
        or_default(art.getField("language"), "Unknown").alias("language"),
        package_coordinate(
            meta.getField("pomGroupID"), meta.getField("pomArtifactID"), art.getField("name")
        ).alias("package"),
        or_default(art.getField("version"), "Unknown").alias("version"),
        F.coalesce(F.array_join(vuln.getField("fix").getField("versions"), ", "), F.lit("")).alias(
            "fix_versions"
        ),
        or_default(vuln.getField("fix").getField("state"), "not fixed").alias("fix_state"),
        first_path(art.getField("locations")).alias("file_path"),
        F.lit(None).cast("string").alias("cvss"),
    )


def parse_xeol(reports: DataFrame) -> DataFrame:
    matches = reports.select("repo_id", F.explode(_json(schemas.XEOL_REPORT)["matches"]).alias("m"))
    cycle, art = F.col("m.Cycle"), F.col("m.artifact")

    def known(holder: Column, field: str) -> Column:
        return or_default(holder.getField(field), "Unknown")

    return matches.select(
        "repo_id",
        known(cycle, "ProductName").alias("product_name"),
        known(cycle, "ProductPermalink").alias("product_permalink"),
        known(cycle, "ReleaseCycle").alias("release_cycle"),
        known(cycle, "Eol").alias("eol_date"),
        known(cycle, "LatestRelease").alias("latest_release"),
        known(cycle, "LatestReleaseDate").alias("latest_release_date"),
        known(cycle, "ReleaseDate").alias("release_date"),
        known(art, "name").alias("artifact_name"),
        known(art, "version").alias("artifact_version"),
        known(art, "type").alias("artifact_type"),
        first_path(art.getField("locations")).alias("file_path"),
        known(art, "language").alias("language"),
    )


def parse_semgrep(reports: DataFrame) -> DataFrame:
    results = reports.select("repo_id", F.explode(_json(schemas.SEMGREP_REPORT)["results"]).alias("r"))
    extra = F.col("r.extra")
    meta = extra.getField("metadata")

    def text(field: str) -> Column:
        return or_default(meta.getField(field), "").alias(field)

    def listed(field: str) -> Column:
        return text_or_list(meta.getField(field)).alias(field)

    return results.select(
        "repo_id",
        F.col("r.path").alias("path"),
        F.col("r.start.line").alias("start_line"),
        F.col("r.end.line").alias("end_line"),
        F.col("r.check_id").alias("rule_id"),
        extra.getField("severity").alias("severity"),
        extra.getField("message").alias("message"),
        text("category"),
        listed("subcategory"),
        listed("technology"),
        listed("cwe"),
        text("likelihood"),
        text("impact"),
        text("confidence"),
    )


def _checkov_entries(reports: DataFrame) -> DataFrame:
    text = F.btrim("body", F.lit(" \t\r\n"))
    as_list = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    is_empty = text.rlike(r"^(\[\s*\]|\{\s*\}|)$")
    entries = F.from_json(F.when(~is_empty, as_list), schemas.CHECKOV_REPORT)
    return reports.select("repo_id", F.posexplode(entries).alias("pos", "e")).where(F.col("e").isNotNull())


def parse_checkov(reports: DataFrame, last_only: bool = False) -> DataFrame:
    """Check summaries from a list of checks, one check, or a bare summary.

    ``last_only`` keeps just the last check of a list, as a writer that
    replaces the repository's rows for each check would.
    """
    entries = _checkov_entries(reports)
    if last_only:
        entries = entries.groupBy("repo_id").agg(F.max_by("e", "pos").alias("e"))

    def count(field: str) -> Column:
        nested = F.col("e.summary").getField(field)
        return F.coalesce(nested, F.col("e").getField(field), F.lit(0)).alias(field)

    return entries.select(
        "repo_id",
        or_default(F.col("e.check_type"), "no-checks").alias("check_type"),
        *[count(f) for f in ("passed", "failed", "skipped", "resource_count", "parsing_errors")],
    )


def syft_artifacts(reports: DataFrame) -> DataFrame:
    """``artifacts`` of each SBOM with their position: (repo_id, pos, a)."""
    return reports.select("repo_id", F.posexplode(_json(schemas.SYFT_REPORT)["artifacts"]).alias("pos", "a"))


def artifact_columns() -> list[Column]:
    """Dependency columns of an artifact struct ``a``."""
    a = F.col("a")
    pom = a.getField("metadata").getField("pomProperties")
    return [
        package_coordinate(pom.getField("groupId"), pom.getField("artifactId"), a.getField("name")).alias(
            "package_name"
        ),
        or_default(a.getField("version"), "Unknown").alias("version"),
        or_default(a.getField("type"), "Unknown").alias("package_type"),
        joined_field(a.getField("licenses"), "value").alias("licenses"),
        joined_field(a.getField("locations"), "path").alias("locations"),
        or_default(a.getField("language"), "Unknown").alias("language"),
    ]


def finding_counts(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy("repo_id", *by).agg(F.count(F.lit(1)).alias("n_findings"))


def is_json(body: Column) -> Column:
    return F.try_parse_json(body).isNotNull()


# The field of each JSON report that holds its list.
REPORT_LISTS = {
    "trivy": "Results",
    "grype": "matches",
    "xeol": "matches",
    "semgrep": "results",
    "syft": "artifacts",
}


def _has_other_shape() -> Column:
    """Whether a JSON report is not built as its tool builds it."""
    parsed = F.try_parse_json("body")
    is_object = F.try_variant_get(parsed, "$", "map<string, variant>").isNotNull()
    counts = F.filter(F.map_entries(_json(schemas.CLOC_REPORT)), lambda e: ~e["key"].isin("header", "SUM"))
    uncounted = F.exists(
        counts,
        lambda e: F.coalesce(
            e["value"]["nFiles"].isNull()
            | e["value"]["blank"].isNull()
            | e["value"]["comment"].isNull()
            | e["value"]["code"].isNull(),
            F.lit(True),
        ),
    )
    wrong = F.when(F.col("tool") == "cloc", ~is_object | F.coalesce(uncounted, F.lit(True)))
    for tool, name in REPORT_LISTS.items():
        # a missing or null list is an empty one
        given = F.try_variant_get(parsed, f"$.{name}", "string").isNotNull()
        entries = F.try_variant_get(parsed, f"$.{name}", "array<variant>")
        objects = F.forall(entries, lambda e: F.try_variant_get(e, "$", "map<string, variant>").isNotNull())
        wrong = wrong.when(F.col("tool") == tool, ~is_object | (given & ~F.coalesce(objects, F.lit(False))))
    checks = F.try_variant_get(parsed, "$", "array<variant>")
    all_objects = F.forall(checks, lambda e: F.try_variant_get(e, "$", "map<string, variant>").isNotNull())
    wrong = wrong.when(F.col("tool") == "checkov", ~is_object & ~F.coalesce(all_objects, F.lit(False)))
    return F.coalesce(wrong, F.lit(False))


def unreadable_reason() -> Column:
    """Why a report (tool, body) cannot be read, NULL when it can."""
    body = F.btrim("body", F.lit(" \t\r\n"))
    is_text = F.col("tool").isin("lizard", "enry")
    empty_check = (F.col("tool") == "checkov") & body.rlike(r"^(\[\s*\]|\{\s*\})$")
    return (
        F.when(~is_text & ~is_json(body), "not valid JSON")
        .when(empty_check, "empty output")
        .when(_has_other_shape(), "unexpected shape")
    )


def report_errors(reports: DataFrame) -> DataFrame:
    """(repo_id, tool, reason) of reports that cannot be read; their old rows should stay."""
    reasons = reports.select("repo_id", "tool", unreadable_reason().alias("reason"))
    return reasons.where(F.col("reason").isNotNull())


def valid_reports(reports: DataFrame) -> DataFrame:
    return reports.where(unreadable_reason().isNull())
