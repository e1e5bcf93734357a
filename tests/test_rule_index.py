import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from codeledger.catalog.registry import Tables
from codeledger.catalog.scanners import coded_dependencies, generated_rules
from codeledger.functions.factors import fold, grams, grams_of_words, required_factors
from codeledger.operators.dependencies import categorize_dependencies
from codeledger.operators.iac import iac_matches
from codeledger.operators.rule_index import RuleIndex
from codeledger.sources.rules import CategoryRule, IacRule

from helpers import repo_files, rows

ODD = ["ſpring-boot", "SPRING-BOOT", "Kafka", "KAFKA", "kafKa-clients", "wİdget", "wıdget", "WIDGET", "straße-kafka", "é", "", None, "x", "a.b.c"]


@pytest.mark.parametrize(
    "pattern, factors",
    [
        ("spring-boot", {"spring-boot"}),
        (r"^org\.apache\.(kafka|spark)", {"org.apache.kafka", "org.apache.spark"}),
        ("(foo|barbaz)qux+", {"fooqux", "barbazqux"}),
        ("a?bcd", {"bcd", "abcd"}),
        ("ab{3}c", {"abbbc"}),
        ("[Jj]ackson", {"jackson"}),
        (r"kind:\s*(Deployment|Service)", {"deployment", "service"}),
        ("(?:abc|x)defg.*", {"abcdefg", "xdefg"}),
        ("(?=abc)xyz(?!def)", {"xyz"}),
        ("éabc", {"abc"}),
        ("(abc)+", {"abc"}),
        ("abc|.", None),
        ("(abc)*", None),
        ("ab", None),
        (".*", None),
        ("", None),
        ("[^a]bc", None),
        ("a-b-c", None),
    ],
)
def test_factors(pattern, factors):
    assert required_factors(pattern) == (None if factors is None else frozenset(factors))


def folded(text):
    return text.replace("İ", "i").upper().lower()


letters = st.sampled_from(["abc", "def", "x", "K", "1", "-", r"\.", ".", r"\d", r"\b", "[ab]", "[^c]", "é", "ſ"])
patterns = st.recursive(
    letters,
    lambda inner: st.one_of(
        st.lists(inner, min_size=1, max_size=4).map("".join),
        st.lists(inner, min_size=1, max_size=3).map(lambda p: f"({'|'.join(p)})"),
        st.tuples(inner, st.sampled_from(["?", "*", "+", "{2}", "{1,3}", "+?"])).map(lambda p: f"(?:{p[0]}){p[1]}"),
    ),
    max_leaves=12,
)


@settings(max_examples=600, deadline=None)
@given(patterns, st.lists(st.sampled_from(["abc", "DEF", "x", "k", "K", "1", "-", ".", "é", "s", "ſ", "a", "b", "d"]), max_size=14).map("".join))
def test_every_match_holds_a_factor(pattern, text):
    factors = required_factors(pattern)
    if factors is not None and re.search(pattern, text, re.IGNORECASE):
        assert any(f in folded(text) for f in factors)


def test_fold_and_grams(spark):
    frame = spark.createDataFrame([("Spring ſoKİı", ), ("ab", ), (None, )], "t string")
    found = [r for r in frame.select(fold(F.col("t")).alias("f")).select("f", grams(F.col("f")).alias("g"), grams_of_words(F.col("f")).alias("w")).collect()]
    assert found[0].f == "spring sokii" and set(found[0].g) == {"spr", "pri", "rin", "ing", "sok", "oki", "kii"} == set(found[0].w)
    assert found[1].g == [] and found[2].g is None


def test_index_equals_the_rules_in_order_on_two_thousand_rules(spark):
    deps = coded_dependencies(Tables(spark, "/root/testdata/sf0.01"))
    rules = generated_rules(2_000)
    assert rows(categorize_dependencies(deps, rules, indexed=True)) == rows(categorize_dependencies(deps, rules, indexed=False))
    names = deps.select(F.col("package_type").alias("ptype"), "package_name").distinct()
    index = RuleIndex(spark, rules)
    tried = index.candidates(names).count()
    # 20 rules without text are tried on the names of their type; the rest of the calls are the candidates
    assert len(index.rest) == 20 and tried < 3 * names.count() < names.count() * len(rules) / 3 / 100


def test_index_on_odd_names_and_rules(spark):
    texts = ["spring-boot", "kafka", "(?:kafka|spring).*", "w.dget", r"\bwidget\b", "straße", "a.b", "é", "^$", "KAFKA-CLIENTS$"]
    numbers = random.Random(5)
    rules = [CategoryRule(numbers.choice(["Python", "npm"]), i, t, f"c{i}", "s", "f") for i, t in enumerate(texts * 3)]
    deps = spark.createDataFrame([(k, n, "own", 1) for k in ("python", "NPM", "gem", None) for n in ODD], "package_type string, package_name string, gram string, kind int")
    both = [rows(categorize_dependencies(deps, rules, indexed=i)) for i in (True, False)]
    assert both[0] == both[1] and len({r[-3] for r in both[0]}) > 5
    assert rows(categorize_dependencies(deps.limit(0), rules, indexed=True)) == []


def iac_rules(count):
    numbers = random.Random(3)
    words = [a + b for a in ("kube", "terra", "helm", "docker", "ansi") for b in ("form", "net", "chart", "file", "ble", "gate")]
    out = []
    for i in range(count):
        word = f"{numbers.choice(words)}{i % 97}"
        content = numbers.choice([rf"^{word}:\s*\d+", f"{word}|{word}x", rf"kind:\s*{word.upper()}", rf"{word}\b.*end$", ".", r"^\d+$"])
        name = numbers.choice([r"\.ya?ml$", r"\.tf$", "^Docker", r"\.yaml$"])
        out.append(IacRule(i, f"c{i % 9}", f"s{i}", f"f{i}", (name,), (content, "never there") if i % 2 else (content,)))
    return out


def test_content_index_equals_all_searches_on_five_hundred_rules(spark):
    numbers = random.Random(4)
    rules = iac_rules(500)
    words = [c.strip("^").split(":")[0] for r in rules for c in r.content_patterns[:1] if c[0] not in ".(^\\" or len(c) > 5]
    entries = []
    for i in range(120):
        lines = [numbers.choice(["kind: ", "", "x "]) + numbers.choice(words) + numbers.choice([": 7", " end", "", "X"]) for _ in range(numbers.randrange(9))]
        entries.append((f"d/{numbers.choice(['a.yaml', 'b.yml', 'main.tf', 'Dockerfile', 'c.txt'])}", "\n".join(lines), f"r{i}"))
    entries += [("d/e.yaml", None, "null"), ("d/f.yaml", "", "empty"), ("d/g.yaml", "KUBENET3: 1\n7", "odd"), ("d/long.yaml", "kubenet3: 9\n" * 100_000, "long")]
    files = repo_files(spark, *entries)
    found = iac_matches(files, rules, indexed=True)
    assert rows(found) == rows(iac_matches(files, rules, indexed=False)) and found.count() > 300
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("array_intersect") <= 2


def test_few_patterns_are_searched_without_an_index(spark):
    plan = iac_matches(repo_files(spark, ("a.tf", "x")), iac_rules(20))._jdf.queryExecution().executedPlan().toString()
    assert "array_intersect" not in plan
