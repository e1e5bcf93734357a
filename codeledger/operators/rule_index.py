"""First-match rules by an inverted index: a name meets the rules that its grams point to, and no others.

From each rule's pattern comes text that all its matches hold (``functions.factors``); the rarest gram of that text
leads to the rule.  Names are exploded to their grams and joined to the index, what the join finds is checked
by the text and then by the pattern.  Rules without such text are tried on every name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeledger.functions.factors import fold, gram_counts, grams, rarest_gram, required_factors
from codeledger.functions.patterns import search_parts, search_sql, sql_text
from codeledger.sources.rules import CategoryRule

INDEX = "kind string, gram string, factor string, _rule int, plain string, regex string"
# Rules of one CASE; more rules are more of them, tried in order.
CASE_RULES = 200


def first_by_case(rules: Sequence[tuple[int, CategoryRule]], case_rules: int = CASE_RULES) -> str:
    """SQL for the number of the first rule that hits ``package_name`` of the package type ``ptype``.

    A CASE has at most ``case_rules`` rules, so that its generated code stays small; COALESCE tries
    the next only where the one before found none.
    """
    by_type: dict[str, list[str]] = {}
    for number, rule in rules:
        hit = search_sql("package_name", rule.pattern, ignore_case=True)
        by_type.setdefault(rule.package_type, []).append(f"WHEN {hit} THEN {number}")
    types = []
    for kind, whens in by_type.items():
        cases = [f"CASE {' '.join(whens[i : i + case_rules])} END" for i in range(0, len(whens), case_rules)]
        types.append(f"WHEN {sql_text(kind)} THEN COALESCE({', '.join(cases)})")
    return f"CASE ptype {' '.join(types)} END"


class RuleIndex:
    """The inverted index of a rule list in order; rules are told by their place in it.

    The index has a row per text of a rule, so it is as bounded as the list, which is on the driver anyway:
    joins broadcast it.
    """

    def __init__(self, spark: SparkSession, rules: Sequence[CategoryRule]) -> None:
        factors = [required_factors(rule.pattern) for rule in rules]
        counts = gram_counts(factors)
        rows = []
        for number, (rule, found) in enumerate(zip(rules, factors, strict=True)):
            plain, regex = search_parts(rule.pattern, ignore_case=True)
            rows += [(rule.package_type, rarest_gram(f, counts), f, number, plain, regex) for f in sorted(found or ())]
        self.rest = [(n, rule) for n, (rule, found) in enumerate(zip(rules, factors, strict=True)) if not found]
        self.rows = spark.createDataFrame(rows, INDEX)

    def candidates(self, names: DataFrame) -> DataFrame:
        """(ptype, package_name, _rule, plain, regex): what is left to verify of (ptype, package_name)."""
        folded = names.select("ptype", "package_name", fold(F.col("package_name")).alias("_folded"))
        looked_up = folded.select("*", F.explode(grams(F.col("_folded"))).alias("_gram"))
        at = (F.col("ptype") == F.col("kind")) & (F.col("_gram") == F.col("gram"))
        found = looked_up.join(F.broadcast(self.rows), at).where(F.contains("_folded", "factor"))
        return found.select("ptype", "package_name", "_rule", "plain", "regex")

    def first_matches(self, names: DataFrame) -> DataFrame:
        """(ptype, package_name, _rule): the first rule that matches, for names that one does."""
        hit = F.expr("if(regex is null, contains(lower(package_name), plain), package_name RLIKE regex)")
        found = self.candidates(names).where(hit).select("ptype", "package_name", "_rule")
        if self.rest:
            tried = names.select("ptype", "package_name", F.expr(first_by_case(self.rest)).alias("_rule"))
            found = found.union(tried.where("_rule is not null"))
        return found.groupBy("ptype", "package_name").agg(F.min("_rule").alias("_rule"))
