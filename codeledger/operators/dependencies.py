"""Dependencies: keep-first rows, first-match categories, build-tool inference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeledger.functions.scalars import non_empty, runtime_entry, strip
from codeledger.operators.lists import keep_first
from codeledger.operators.reports import artifact_columns, syft_artifacts
from codeledger.operators.rule_index import CASE_RULES, RuleIndex, first_by_case
from codeledger.sources.rules import CategoryRule

# Rules beyond which looking them up is cheaper than trying them in order.
INDEXED_RULES = 100
LABEL = "struct<category: string, sub_category: string, framework: string>"


def sbom_dependencies(artifacts: DataFrame, order: Sequence[str | Column] = ("pos",)) -> DataFrame:
    """Dependencies of SBOM artifacts (repo_id, <order>, a): first copy per name and version.

    ``ord`` keeps the artifact order for the order-sensitive jobs downstream.
    """
    rank = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order]).alias("ord")
    rows = artifacts.select("repo_id", rank, *artifact_columns())
    return keep_first(rows, ["repo_id", "package_name", "version"], ["ord"])


def _labelled(names: DataFrame, rules: list[CategoryRule], indexed: bool) -> DataFrame:
    """(ptype, package_name, label) of the first rule that hits, for the names that one hits."""
    if indexed:
        picked = RuleIndex(names.sparkSession, rules).first_matches(names)
    else:
        picked = names.withColumn("_rule", F.expr(first_by_case(list(enumerate(rules)), CASE_RULES)))
    labels = names.sparkSession.createDataFrame(
        [(number, (r.category, r.sub_category, r.framework)) for number, r in enumerate(rules)],
        f"_rule int, label {LABEL}",
    )
    return picked.join(labels, "_rule").select("ptype", "package_name", "label")


def categorize_dependencies(
    deps: DataFrame, rules: Sequence[CategoryRule], indexed: bool | None = None
) -> DataFrame:
    """Adds category, sub_category and framework of the first rule that matches.

    A list of more than INDEXED_RULES is looked up by an inverted index, a shorter one is tried in order;
    ``indexed`` decides otherwise.  Both find the same.  Rules run once per distinct (package type, name), not once per row; the
    labels then join back, and adaptive execution broadcasts or splits that join
    by the sizes it measures.  No rule: ``Other`` and empty text.
    """
    ordered = sorted(rules, key=lambda r: (r.package_type.lower(), r.ord))
    ordered = [
        CategoryRule(r.package_type.lower(), r.ord, r.pattern, r.category, r.sub_category, r.framework)
        for r in ordered
    ]
    plain = [c for c in deps.columns if c not in ("category", "sub_category", "framework")]
    rows = deps.select(*plain, F.lower("package_type").alias("ptype"))
    types = sorted({r.package_type for r in ordered})
    if not ordered:
        labelled = rows.withColumn("label", F.lit(None).cast(LABEL))
    else:
        names = rows.where(F.col("ptype").isin(types)).select("ptype", "package_name").distinct()
        indexed = len(ordered) > INDEXED_RULES if indexed is None else indexed
        labelled = rows.join(_labelled(names, ordered, indexed), ["ptype", "package_name"], "left")
    return labelled.select(
        *plain,
        F.coalesce("label.category", F.lit("Other")).alias("category"),
        F.coalesce("label.sub_category", F.lit("")).alias("sub_category"),
        F.coalesce("label.framework", F.lit("")).alias("framework"),
    )


def syft_dependencies(reports: DataFrame, rules: Sequence[CategoryRule]) -> DataFrame:
    """SBOM reports to categorised dependencies, in the order of their artifacts."""
    unused = [F.lit(None).cast(kind).alias(c) for c, kind in (("name_key", "string"), ("source_ord", "int"), ("path", "string"))]
    return categorize_dependencies(sbom_dependencies(syft_artifacts(reports), [*unused, "pos"]), rules)


def build_tool_vote(order: Sequence[str] = ("ord",)) -> Column:
    """Aggregate over a repository's dependencies: the build tool they point to.

    A wrapper package wins, the first in order; then a Java archive located in
    a ``pom.xml``; then the first Python, npm, Go or Ruby package.
    """
    name = F.lower(F.coalesce("package_name", F.lit("")))
    kind = F.lower(F.coalesce("package_type", F.lit("")))
    version = strip(F.coalesce("version", F.lit("")))
    places = F.lower(F.coalesce("locations", F.lit("")))

    def wrapper(tool: str) -> Column:
        return F.concat(F.lit(tool), F.coalesce(F.concat(F.lit(":"), non_empty(version)), F.lit("")))

    is_gradle, is_maven = name.contains("gradle-wrapper"), name.contains("maven-wrapper")
    is_pom = (kind == "java-archive") & places.contains("pom.xml")
    ecosystem = (
        F.when(kind == "python", "python")
        .when(kind == "npm", "node")
        .when(kind == "go-module", "go")
        .when(kind == "gem", "ruby")
    )
    rank = F.when(is_gradle | is_maven, 0).when(is_pom, 1).when(ecosystem.isNotNull(), 2)
    label = (
        F.when(is_gradle, wrapper("gradle-wrapper"))
        .when(is_maven, wrapper("maven-wrapper"))
        .when(is_pom, "maven")
        .otherwise(ecosystem)
    )
    # rows without a rank have no place in the order, so they never win
    place = F.when(rank.isNotNull(), F.struct(rank, *order))
    return F.coalesce(F.min_by(label, place), F.lit("Unknown"))


def infer_build_tool(deps: DataFrame, order: Sequence[str] = ("ord",)) -> DataFrame:
    """(repo_id, build_tool) read off the dependencies (see ``build_tool_vote``)."""
    return deps.groupBy("repo_id").agg(build_tool_vote(order).alias("build_tool"))


def runtime_entries(build_tools: DataFrame) -> DataFrame:
    """(repo_id, entry) with ``Language:version`` per build tool row."""
    return build_tools.select("repo_id", runtime_entry(F.col("tool"), F.col("runtime_version")).alias("entry"))


def distinct_names(rows: DataFrame, column: str, name: str, trim: bool = False) -> DataFrame:
    """Sorted distinct non-blank values per repository.

    Distinct pairs are formed first, so a list is only as long as its vocabulary.
    """
    value = strip(F.col(column)) if trim else F.col(column)
    pairs = rows.select("repo_id", value.alias("v")).where(F.coalesce(F.col("v"), F.lit("")) != "").distinct()
    return pairs.groupBy("repo_id").agg(F.array_sort(F.collect_list("v")).alias(name))
