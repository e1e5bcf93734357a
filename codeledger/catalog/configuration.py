"""Rule and lookup files: written from a table to the shared folder, loaded, and applied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeledger.catalog.contents import _JDK_VALUES, files
from codeledger.catalog.portfolio import _LANGUAGES_SQL, languages, text
from codeledger.catalog.registry import Tables, query
from codeledger.catalog.scanners import named
from codeledger.catalog.storage import folder
from codeledger.operators import build_tools as b
from codeledger.operators import reports as r
from codeledger.operators import selection
from codeledger.operators.dependencies import categorize_dependencies
from codeledger.operators.iac import iac_matches
from codeledger.operators.status import execution_log_rows
from codeledger.plans.tables import build_tool_failures
from codeledger.sources import rules as R


def _tree(t: Tables, holder: Column) -> DataFrame:
    """One rule document: a category per region, a subcategory per nation, ``holder`` under it."""
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    sub = named(name=F.col("n_name"), frameworks=F.array(holder))
    rows = nations.groupBy("r_regionkey", "r_name").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", sub.alias("s")))).alias("s"))
    category = named(name=F.col("r_name"), subcategories=F.transform("s", lambda x: x["s"]))
    found = rows.agg(F.array_sort(F.collect_list(F.struct("r_regionkey", category.alias("c")))).alias("c"))
    return found.select(F.transform("c", lambda x: x["c"]).alias("categories"))


def _stored(t: Tables, documents: DataFrame, name: str, sub: str = "") -> str:
    """The folder with one JSON file."""
    root = folder(t, name)
    documents.coalesce(1).write.json(f"{root}/{sub}".rstrip("/"))
    return root


_FIRST_SQL = """
  select p_partkey, r_name, n_name, row_number() over (partition by p_partkey order by n_regionkey, n_nationkey) place
  from part join nation on contains(lower(p_type || p_name), lower(n_name[1:2]))
    join region on n_regionkey = r_regionkey"""


@query(
    "q_rule_files",
    f"""select p_partkey::varchar repo_id, coalesce(r_name, 'Other') category, coalesce(n_name, '') sub_category,
               coalesce('F-' || n_name, '') framework
        from part left join (select * from ({_FIRST_SQL}) where place = 1) using (p_partkey)""",
)
def q_rule_files(t: Tables) -> DataFrame:
    """Category rules from files: the first of 25 patterns that a package name holds."""
    framework = named(name=F.concat(F.lit("F-"), "n_name"), patterns=F.array(F.substring("n_name", 1, 2)))
    root = _stored(t, _tree(t, framework), "rules", "python")
    rules = R.load_all_category_rules_of(t.spark, root, ["python"])
    name = F.concat("p_type", "p_name").alias("package_name")
    deps = t.part.select(text("p_partkey").alias("repo_id"), F.lit("Python").alias("package_type"), name)
    return categorize_dependencies(deps, rules).select("repo_id", "category", "sub_category", "framework")


@query(
    "q_iac_rule_files",
    """select distinct p_partkey::varchar repo_id, r_name category, n_name subcategory
       from part join nation on p_size % 25 = n_nationkey join region on n_regionkey = r_regionkey""",
)
def q_iac_rule_files(t: Tables) -> DataFrame:
    """Infrastructure rules from files, a file name each."""
    pattern = F.concat(F.lit("^nation-"), text("n_nationkey"), F.lit(r"\.tf$"))
    framework = named(name=F.col("n_name"), file_patterns=F.array(pattern), content_patterns=F.array().cast("array<string>"))
    rules = R.load_iac_rules(t.spark, _stored(t, _tree(t, framework), "iac"))
    path = F.concat(F.lit("nation-"), (F.col("p_size") % 25).cast("string"), F.lit(".tf"))
    files = t.part.select(
        text("p_partkey").alias("repo_id"), path.alias("path"), F.lit(1).cast("bigint").alias("size"), F.lit("x").alias("content")
    )
    return iac_matches(files, rules).select("repo_id", "category", "subcategory").distinct()


@query(
    "q_jdk_file",
    """select p_partkey::varchar repo_id, coalesce('jdk-' || n_name, 'JDK version unknown') jdk
       from part left join nation on p_size % 50 = n_nationkey""",
)
def q_jdk_file(t: Tables) -> DataFrame:
    """A version-to-JDK file, loaded and looked up."""
    entry = F.struct(F.concat(text("n_nationkey"), F.lit(".0")), F.concat(F.lit("jdk-"), "n_name"))
    table = t.nation.agg(F.map_from_entries(F.collect_list(entry)).alias("m"))
    root = folder(t, "jdk")
    table.select(F.to_json("m")).coalesce(1).write.text(root)
    jdks = R.load_gradle_jdk_map(t.spark, root)
    version = F.concat((F.col("p_size") % 50).cast("string"), F.lit(".0"))
    return t.part.select(text("p_partkey").alias("repo_id"), b.jdk_for_gradle(version, jdks).alias("jdk"))


def _gradle_files(t: Tables) -> DataFrame:
    """Per part a properties file in a folder of its own number, that states a version there and nowhere else."""
    number = (F.col("p_size") % 50).cast("string")
    path = F.concat(F.lit("n"), number, F.lit("/gradle.properties"))
    return files(t.part, text("p_partkey"), (path, F.concat(F.lit("v"), number, F.lit("=7."), (F.col("p_size") % 6).cast("string"))))


@query(
    "q_gradle_rules_file",
    f"""with jdks(known, jdk) as (values {_JDK_VALUES}),
        p as (select p_partkey::varchar repo_id, case when p_size % 50 < 25 then '7.' || (p_size % 6) end v from part)
        select repo_id, v tool_version, case when v is not null then coalesce(jdk, 'JDK version unknown') end runtime_version,
               case when v is null then 'Gradle version detection failed' end error
        from p left join jdks on known = v""",
)
def q_gradle_rules_file(t: Tables) -> DataFrame:
    """A file of version rules, one per folder, loaded and applied; half of the folders have none."""
    number = text("n_nationkey")
    rule = F.struct(
        F.concat(F.lit("n"), number, F.lit("/gradle.properties")).alias("file"),
        F.concat(F.lit("v"), number, F.lit(r"=(\d+(?:\.\d+)*)")).alias("regex"),
    )
    root = _stored(t, t.nation.agg(F.collect_list(rule).alias("extraction_rules")), "gradle")
    found = b.gradle_versions(_gradle_files(t), R.load_gradle_rules(t.spark, root))
    return found.select("repo_id", "tool_version", "runtime_version", "error")


@query(
    "q_build_tool_failures",
    """select 'gradle' method_name, p_partkey::varchar repo_id, 'FAILURE' status, 'Gradle version detection failed' message
       from part where p_size % 3 <> 0""",
)
def q_build_tool_failures(t: Tables) -> DataFrame:
    """Log rows of the repositories whose Gradle files state no version by the usual rules."""
    content = F.when(F.col("p_size") % 3 == 0, F.lit("gradleVersion = 7.1")).otherwise("org.gradle.daemon=true")
    failures = build_tool_failures(files(t.part, text("p_partkey"), ("gradle.properties", content), ("docs/a.md", "gradleVersion = 7.2")))
    log = execution_log_rows(failures, "gradle", "build_tools", "run", "2024-01-16 00:00:00")
    return log.select("method_name", "repo_id", "status", "message")


@query(
    "q_ruleset_file",
    """select p_partkey::varchar repo_id, 'path-' || (p_size % 25) ruleset from part where p_size % 25 <> 24""",
)
def q_ruleset_file(t: Tables) -> DataFrame:
    """A language-to-ruleset INI file, loaded and looked up."""
    root = folder(t, "ini")
    number = text("n_nationkey")
    section = F.concat(F.lit("[lang"), number, F.lit("]\npath = path-"), number)
    t.nation.where("n_nationkey < 24").select(section).coalesce(1).write.text(root)
    detected = t.part.select(
        text("p_partkey").alias("repo_id"), F.concat(F.lit("Lang"), (F.col("p_size") % 25).cast("string")).alias("language")
    )
    found = selection.repository_rulesets(detected, R.load_ruleset_map(t.spark, root))
    return found.select("repo_id", F.explode("rulesets").alias("ruleset"))


@query(
    "q_languages_sorted",
    f"select repo_id, language, format('{{:.6f}}', percent_usage) percent from ({_LANGUAGES_SQL})",
)
def q_languages_sorted(t: Tables) -> DataFrame:
    found = selection.languages_by_share(languages(t))
    return found.select("repo_id", "language", F.format_string("%.6f", "percent_usage").alias("percent"))


@query(
    "q_finding_counts",
    """select user_id::varchar repo_id, event_type severity, count(*) n_findings from events group by all""",
)
def q_finding_counts(t: Tables) -> DataFrame:
    result = named(check_id=F.col("event_type"), path=F.lit("a"), extra=named(severity=F.col("event_type"), message=F.col("props")))
    body = F.to_json(named(results=F.array(result)))
    found = r.parse_semgrep(t.events.select(text("user_id").alias("repo_id"), body.alias("body")))
    return r.finding_counts(found, "severity")
