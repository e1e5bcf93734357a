"""The repository profile: every table folded into one nested document per repository.

Each table is aggregated to one row per repository first, then the rows are
joined on ``repo_id``, so the joins carry no duplicates and share one
partitioning.  A profile row holds scalars, counts and sets that are bounded by a
vocabulary.  Every list section is a table of parts, at any length (see
``codeledger.operators.lists``); ``assembled`` makes nested documents of the
repositories that are asked for.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeledger.functions.scalars import (
    iso_timestamp,
    megabytes,
    non_empty,
    or_default,
    percent_of,
    python_round,
    size_class,
    strip,
    years,
)
from codeledger.operators.dependencies import build_tool_vote, runtime_entries
from codeledger.operators.iac import signal_flags
from codeledger.operators.lists import PART_ITEMS, list_parts, whole_lists
from codeledger.operators.vulnerabilities import combined_vulnerabilities, deduplicated_vulnerabilities
from codeledger.session import checkpointed
from codeledger.sinks.tables import KeyedTable

# Element fields of the list sections.
DEPENDENCY_FIELDS = [
    ("package_name", "name"),
    ("version", "version"),
    ("package_type", "package_type"),
    ("language", "language"),
    ("locations", "locations"),
    ("licenses", "licenses"),
    ("category", "category"),
    ("sub_category", "sub_category"),
    ("framework", "framework"),
]
VULNERABILITY_FIELDS = ["package", "version", "severity", "fix_version", "source"]
EOL_FIELDS = ["artifact_name", "artifact_version", "eol_date", "latest_release"]
SEMGREP_FIELDS = [
    "path",
    "rule_id",
    "severity",
    "category",
    "subcategory",
    "likelihood",
    "impact",
    "confidence",
]


@dataclass
class ProfileTables:
    """The tables a profile is built from, in the shapes of ``codeledger.schemas``."""

    inventory: DataFrame
    repo_metrics: DataFrame
    lizard_summary: DataFrame
    languages: DataFrame
    cloc_metrics: DataFrame
    syft_dependencies: DataFrame
    build_tools: DataFrame
    grype_results: DataFrame
    trivy_vulnerability: DataFrame
    xeol_results: DataFrame
    semgrep_results: DataFrame
    iac_components: DataFrame
    recent_commits: DataFrame


@dataclass
class Profiles:
    """``scalars`` (repo_id, profile) and, for each list section, its parts (repo_id, part, items)."""

    scalars: DataFrame
    sections: dict[str, DataFrame]


def profile_rejects(tables: ProfileTables) -> DataFrame:
    """(repo_id, error) of repositories without inventory or without metrics."""
    inventory = tables.inventory.select("repo_id", F.lit(True).alias("_i"))
    metrics = tables.repo_metrics.select("repo_id", F.lit(True).alias("_m"))
    both = inventory.join(metrics, "repo_id", "full")
    missing = F.col("_i").isNull() | F.col("_m").isNull()
    text = F.concat(F.lit("Missing repository or metrics for "), F.col("repo_id"))
    return both.where(missing).select("repo_id", text.alias("error"))


# --- sections, one row per repository ---------------------------------------


def basic_section(inventory: DataFrame, metrics: DataFrame) -> DataFrame:
    """Inventory joined with metrics, and the basic fields as ``basic``."""
    i, m = inventory.alias("i"), metrics.alias("m")
    fields = {
        "Repo ID": F.col("i.repo_id"),
        "Repo Name": F.col("i.repo_name"),
        "Status": F.coalesce(non_empty(F.col("i.status")), F.lit("Unknown")),
        "VCS Hostname": F.col("i.host_name"),
        "App ID": F.col("i.app_id"),
        "TC": F.col("i.tc"),
        "Last Updated": iso_timestamp(F.col("i.updated_on")),
        "Clone URL SSH": F.col("i.clone_url_ssh"),
        "Browse URL": F.col("i.browse_url"),
        "Repo Size (MB)": megabytes(F.col("m.repo_size_bytes")),
        "Code Size (MB)": megabytes(F.col("m.code_size_bytes")),
        "File Count": F.col("m.file_count"),
        "Total Commits": F.col("m.total_commits"),
        "Contributors": F.col("m.number_of_contributors"),
        "Activity Status": F.coalesce(non_empty(F.col("m.activity_status")), F.lit("Unknown")),
        "Last Commit Date": iso_timestamp(F.col("m.last_commit_date")),
        "Repo Age (Years)": years(F.col("m.repo_age_days")),
        "Active Branch Count": F.col("m.active_branch_count"),
        "Top Contributor Commits": or_default(F.col("m.top_contributor_commits"), 0),
        "Commits by Top 3 Contributors": or_default(F.col("m.commits_by_top_3_contributors"), 0),
    }
    return i.join(m, "repo_id").select(
        F.col("repo_id"),
        F.col("m.repo_size_bytes").alias("_size"),
        F.struct(*[e.alias(n) for n, e in fields.items()]).alias("basic"),
    )


def language_section(languages: DataFrame, order: str | None = None) -> DataFrame:
    """Share per language, the main language and the others.

    Of a language listed twice the last share counts.  The highest rounded
    share is the main language; ties go to the first listed (``order``), or to
    the first by name without an order column.  Distinct languages are formed
    before the list, which is thereby as short as the vocabulary.
    """
    place = F.col(order) if order else F.lit(0)
    single = languages.groupBy("repo_id", "language").agg(
        F.max_by("percent_usage", F.struct(place, F.col("percent_usage"))).alias("percent"),
        F.min(place).alias("place"),
    )
    entry = F.struct("place", "language", python_round(F.col("percent"), 2).alias("percent"))
    listed = single.groupBy("repo_id").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    best = F.element_at(
        F.array_sort(
            F.transform("e", lambda x: F.struct(-x["percent"], x["place"], x["language"].alias("language")))
        ),
        1,
    )["language"]
    shares = F.map_from_entries(F.transform("e", lambda x: F.struct(x["language"], x["percent"])))
    names = F.transform("e", lambda x: x["language"])
    return listed.select("repo_id", shares.alias("shares"), best.alias("main"), names.alias("names")).select(
        "repo_id",
        "shares",
        "main",
        F.filter("names", lambda x: x != F.col("main")).alias("others"),
    )


def loc_totals(cloc: DataFrame) -> DataFrame:
    return cloc.groupBy("repo_id").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("code", "blank", "comment")]
    )


def dependency_section(deps: DataFrame, order: Sequence[str]) -> DataFrame:
    framework = non_empty(strip(F.col("framework")))
    return deps.groupBy("repo_id").agg(
        F.count(F.lit(1)).alias("n_dependencies"),
        # as long as the rule vocabulary at most
        F.array_sort(F.collect_set(framework)).alias("frameworks"),
        build_tool_vote(order).alias("build_tool"),
    )


def security_section(vulnerabilities: DataFrame) -> DataFrame:
    return vulnerabilities.groupBy("repo_id").agg(
        F.count(F.lit(1)).alias("n_vulnerabilities"),
        F.count_if(F.col("severity") == "Critical").alias("n_critical"),
    )


def eol_section(eol: DataFrame) -> DataFrame:
    return eol.groupBy("repo_id").agg(F.count(F.lit(1)).alias("n_eol"))


def runtime_versions(build_tools: DataFrame) -> DataFrame:
    """(repo_id, runtime_version): the entries of every repository, sorted and joined."""
    parts = list_parts(runtime_entries(build_tools), ["entry"])
    text = F.array_join("entries", ", ").alias("runtime_version")
    return whole_lists(parts, "entries").select("repo_id", text)


def iac_section(components: DataFrame) -> DataFrame:
    frameworks = F.array_sort(F.collect_set(non_empty(F.col("framework"))))
    # flags and set ask for distinct values only, and those are few
    kinds = components.select("repo_id", "framework", "category").distinct()
    return kinds.groupBy("repo_id").agg(frameworks.alias("iac_frameworks"), *signal_flags())


# --- assembly ---------------------------------------------------------------

# The field of a document that each list section follows.
LIST_PLACES = {
    "Recent Commit Dates": "Commits by Top 3 Contributors",
    "Dependencies": "Classification Label",
    "Runtime Version": "Build Tool",
    "Vulnerabilities": "Build Tool",
    "EOL Results": "Vulnerable Dependencies %",
    "Semgrep Findings": "EOL Packages Found",
}


def _list_sources(tables: ProfileTables, vulnerabilities: DataFrame) -> dict[str, tuple[DataFrame, list]]:
    return {
        "Recent Commit Dates": (tables.recent_commits, ["committed_at"]),
        "Dependencies": (tables.syft_dependencies, [F.col(c).alias(n) for c, n in DEPENDENCY_FIELDS]),
        "Runtime Version": (runtime_entries(tables.build_tools), ["entry"]),
        "Vulnerabilities": (vulnerabilities, VULNERABILITY_FIELDS),
        "EOL Results": (tables.xeol_results, EOL_FIELDS),
        "Semgrep Findings": (tables.semgrep_results, SEMGREP_FIELDS),
    }


def build_profiles(
    tables: ProfileTables,
    part_items: int = PART_ITEMS,
    language_order: str | None = None,
    dependency_order: Sequence[str] | None = None,
) -> Profiles:
    """The profiles of all repositories with inventory and metrics, in one layout at every size.

    ``dependency_order`` decides which dependency names the build tool first: the stored ``ord`` of
    the SBOM, or name and version where a table has none.
    """
    if dependency_order is None:
        dependency_order = ["ord"] if "ord" in tables.syft_dependencies.columns else ["package_name", "version"]
    # written once: the counts and the list would each sort all findings for their first rows
    vulnerabilities = checkpointed(
        deduplicated_vulnerabilities(combined_vulnerabilities(tables.grype_results, tables.trivy_vulnerability))
    )
    lizard = tables.lizard_summary.select("repo_id", F.struct(F.col("*")).alias("lizard"))
    joined = (
        basic_section(tables.inventory, tables.repo_metrics)
        .join(language_section(tables.languages, language_order), "repo_id", "left")
        .join(lizard, "repo_id", "left")
        .join(loc_totals(tables.cloc_metrics), "repo_id", "left")
        .join(dependency_section(tables.syft_dependencies, dependency_order), "repo_id", "left")
        .join(security_section(vulnerabilities), "repo_id", "left")
        .join(eol_section(tables.xeol_results), "repo_id", "left")
        .join(iac_section(tables.iac_components), "repo_id", "left")
    )
    # only for repositories that have a document
    known = tables.inventory.join(tables.repo_metrics, "repo_id", "left_semi").select("repo_id")
    sections = {
        name: list_parts(rows.join(known, "repo_id", "left_semi"), items, part_items)
        for name, (rows, items) in _list_sources(tables, vulnerabilities).items()
    }
    return Profiles(joined.select("repo_id", F.struct(*_profile_fields()).alias("profile")), sections)


def section_rows(profiles: Profiles) -> DataFrame:
    """(repo_id, section, part, items_json) of all list sections; items are (item, copies)."""
    rows = [
        parts.select("repo_id", F.lit(name).alias("section"), "part", F.to_json("items").alias("items_json"))
        for name, parts in profiles.sections.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def assembled(profiles: Profiles, repos: DataFrame | None = None) -> DataFrame:
    """(repo_id, profile) with every list in its place, for the repositories in ``repos`` (all without).

    A nested document holds its lists whole, so it is as long as its repository.
    """

    def chosen(rows: DataFrame) -> DataFrame:
        return rows if repos is None else rows.join(repos.select("repo_id").distinct(), "repo_id", "left_semi")

    rows = chosen(profiles.scalars)
    lists = {}
    for number, (name, parts) in enumerate(profiles.sections.items()):
        rows = rows.join(whole_lists(chosen(parts), f"_list{number}"), "repo_id", "left")
        lists[name] = F.coalesce(F.col(f"_list{number}"), F.array())
    lists["Recent Commit Dates"] = F.transform(F.reverse(lists["Recent Commit Dates"]), iso_timestamp)
    runtime = lists["Runtime Version"]
    lists["Runtime Version"] = F.when(F.size(runtime) > 0, F.array_join(runtime, ", "))
    fields: list[Column] = []
    for name in rows.schema["profile"].dataType.names:
        fields.append(F.col("profile").getField(name).alias(name))
        fields += [lists[after].alias(after) for after, before in LIST_PLACES.items() if before == name]
    return rows.select("repo_id", F.struct(*fields).alias("profile"))


def _profile_fields() -> list[Column]:
    """All fields but the lists, in document order."""

    def zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    def lizard(field: str) -> Column:
        return F.when(F.col("lizard").isNull(), F.lit(0)).otherwise(F.col("lizard").getField(field))

    def listed(name: str) -> Column:
        return F.coalesce(F.col(name), F.array())

    no_shares = F.create_map().cast("map<string, double>")
    loc = zero("code")
    avg = python_round(F.coalesce(F.col("lizard.avg_ccn"), F.lit(0.0)), 2)
    share = percent_of(zero("n_vulnerabilities"), zero("n_dependencies"))
    flags = F.struct(
        F.coalesce("dockerfile", F.lit(False)).alias("Dockerfile"),
        F.coalesce("cicd_pipeline", F.lit(False)).alias("CI/CD Pipeline"),
        F.coalesce("iac_config", F.lit(False)).alias("IaC Config"),
    )
    fields = {
        "Language Percentages": F.coalesce(F.col("shares"), no_shares),
        "Main Language": F.col("main"),
        "Other Languages": listed("others"),
        "Total NLOC": lizard("total_nloc"),
        "Avg Cyclomatic Complexity": avg,
        "Total Tokens": lizard("total_token_count"),
        "Total Functions": lizard("function_count"),
        "Total Cyclomatic Complexity": lizard("total_ccn"),
        "Lines of Code": loc,
        "Blank Lines": zero("blank"),
        "Comment Lines": zero("comment"),
        "total_loc": loc,
        "Classification Label": size_class(F.col("_size"), loc),
        "Total Dependencies": zero("n_dependencies"),
        "Frameworks": listed("frameworks"),
        "Build Tool": F.coalesce(F.col("build_tool"), F.lit("Unknown")),
        "Critical Vuln Count": zero("n_critical"),
        "Vulnerable Dependencies %": share,
        "EOL Packages Found": zero("n_eol"),
        "Modernization Signals": flags,
        "IaC Frameworks": listed("iac_frameworks"),
    }
    return [F.col("basic.*"), *[e.alias(n) for n, e in fields.items()]]


def profile_documents(profiles: Profiles, repos: DataFrame | None = None) -> DataFrame:
    """The ``profile_cache`` rows: (repo_id, profile_json)."""
    text = F.to_json("profile", {"ignoreNullFields": "false"})
    return assembled(profiles, repos).select("repo_id", text.alias("profile_json"))


def cache_profiles(profiles: Profiles, cache: KeyedTable) -> None:
    """Store the documents, replacing those of the same repositories."""
    cache.upsert(profile_documents(profiles))
