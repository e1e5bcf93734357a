"""Infrastructure components found in files, and the signals read off them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeledger.functions.factors import fold, gram_counts, grams_of_words, rarest_gram, required_factors
from codeledger.functions.patterns import search_any_sql, search_sql, sql_text
from codeledger.functions.scalars import as_timestamp, basename
from codeledger.sources.rules import IacRule

# Rules per generated array; keeps each generated method small.
RULES_PER_ARRAY = 100
# Content patterns beyond which one pass for the grams of all is cheaper than a search for each.
INDEXED_PATTERNS = 50


def _any_content(rule: IacRule, index: dict[str, list[str]]) -> str:
    """SQL for "any content pattern occurs"; a pattern in ``index`` is tried only where one of its grams occurs."""
    told = []
    for pattern in rule.content_patterns:
        hit = search_sql("content", pattern, ignore_case=True, multiline=True)
        there = [f"array_contains(_present, '{gram}')" for gram in index.get(pattern, ())]
        told.append(f"(({' OR '.join(there)}) AND {hit})" if there else hit)
    return f"({' OR '.join(told)})"


def _rule_hit(rule: IacRule, index: dict[str, list[str]]) -> str:
    told = search_any_sql("_name", rule.file_patterns)
    if rule.content_patterns:
        # AND stops at the name, so text is searched only in files the name admits
        told += " AND " + _any_content(rule, index)
    label = ", ".join(
        f"'{name}', {sql_text(getattr(rule, name))}" for name in ("category", "subcategory", "framework")
    )
    return f"IF({told}, named_struct({label}), NULL)"


def _content_index(rules: Sequence[IacRule]) -> dict[str, list[str]]:
    """For each content pattern that has them, the grams of which a match must hold one."""
    patterns = dict.fromkeys(p for r in rules for p in r.content_patterns)
    factors = {p: required_factors(p) for p in patterns}
    counts = gram_counts(factors.values())
    return {p: sorted({rarest_gram(f, counts) for f in found}) for p, found in factors.items() if found}


def iac_matches(repo_files: DataFrame, rules: Sequence[IacRule], indexed: bool | None = None) -> DataFrame:
    """(repo_id, path, category, subcategory, framework) per file and rule that match.

    File patterns search the base name as spelled; content patterns search the
    text in any case, per line; a rule without them needs only the name, and an
    unreadable file matches no content pattern.  Rules are literals of the plan:
    one scan, no join and no shuffle, however many files there are.

    With more than INDEXED_PATTERNS content patterns, or if ``indexed`` says so, a text is read once for the grams of
    all rules, and a pattern is searched only in texts that hold one of its own.
    """
    rules = [r for r in sorted(rules, key=lambda r: r.ord) if r.file_patterns]
    if not rules:
        empty = [F.lit(None).cast("string").alias(c) for c in ("category", "subcategory", "framework")]
        return repo_files.select("repo_id", "path", *empty).limit(0)
    every_name = dict.fromkeys(p for r in rules for p in r.file_patterns)
    named = repo_files.withColumn("_name", basename(F.col("path"))).where(
        F.expr(search_any_sql("_name", every_name))
    )
    index = _content_index(rules)
    if indexed is None:
        indexed = len(index) > INDEXED_PATTERNS
    if indexed and index:
        admitted = dict.fromkeys(p for r in rules if r.content_patterns for p in r.file_patterns)
        known = F.array(*[F.lit(g) for g in sorted({g for grams in index.values() for g in grams})])
        present = F.array_intersect(grams_of_words(fold(F.col("content"))), known)
        named = named.withColumn("_present", F.when(F.expr(search_any_sql("_name", admitted)), present))
    else:
        index = {}
    chunks = [rules[i : i + RULES_PER_ARRAY] for i in range(0, len(rules), RULES_PER_ARRAY)]
    arrays = [f"array({', '.join(_rule_hit(r, index) for r in chunk)})" for chunk in chunks]
    hits = F.expr(f"array_compact(concat({', '.join(arrays)}))")
    return named.select("repo_id", "path", F.explode(hits).alias("hit")).select("repo_id", "path", "hit.*")


def iac_components(
    repo_files: DataFrame, inventory: DataFrame, rules: Sequence[IacRule], scanned_at: datetime | str | Column
) -> DataFrame:
    """The ``iac_components`` rows of a scan."""
    names = inventory.select("repo_id", "repo_slug", "repo_name")
    return iac_matches(repo_files, rules).join(names, "repo_id").select(
        "repo_id",
        "repo_slug",
        "repo_name",
        F.col("path").alias("file_path"),
        "category",
        "subcategory",
        "framework",
        as_timestamp(scanned_at).alias("scan_timestamp"),
    )


def signal_flags() -> list[Column]:
    """Aggregates over a repository's components: three existence flags."""
    flags = {
        "dockerfile": F.col("framework").isin("Dockerfile", "docker-compose"),
        "cicd_pipeline": F.col("category") == "Developer Platform and CI/CD",
        "iac_config": F.col("category").isin("Infrastructure Platform", "Container Platform"),
    }
    return [F.coalesce(F.bool_or(flag), F.lit(False)).alias(name) for name, flag in flags.items()]


def modernization_signals(components: DataFrame) -> DataFrame:
    """The three flags per repository that has components."""
    return components.groupBy("repo_id").agg(*signal_flags())
