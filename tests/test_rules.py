import random
import re

import pytest
from pyspark.sql import functions as F

from codeledger.functions.patterns import java_regex, search
from codeledger.operators.build_tools import UNKNOWN_JDK, jdk_for_gradle, jdk_lookup
from codeledger.operators import dependencies
from codeledger.operators.dependencies import categorize_dependencies
from codeledger.operators.iac import iac_matches
from codeledger.sources import rules as R

from helpers import repo_files, rows

LABELS = ["package_name", "category", "sub_category", "framework"]


def deps(spark, *names, package_type="Python"):
    data = [("r", n, package_type) for n in names]
    return spark.createDataFrame(data, "repo_id string, package_name string, package_type string")


def test_first_rule_wins_in_any_case(spark):
    rules = [
        R.CategoryRule("python", 1, ".*kafka.*", "Msg", "Q", "K"),
        R.CategoryRule("python", 2, ".*kafka-python.*", "Py", "Q", "KP"),
    ]
    found = categorize_dependencies(deps(spark, "Kafka-Python", "left-pad"), rules)
    assert rows(found, *LABELS) == [("Kafka-Python", "Msg", "Q", "K"), ("left-pad", "Other", "", "")]
    assert rows(categorize_dependencies(deps(spark, "kafka", package_type="npm"), rules), *LABELS) == [
        ("kafka", "Other", "", "")
    ]
    assert rows(categorize_dependencies(deps(spark, "kafka"), []), *LABELS) == [("kafka", "Other", "", "")]


def test_few_and_many_cases_equal_a_plain_loop(spark, monkeypatch):
    rng = random.Random(3)
    words = ["kafka", "spring", "boot", "core", "io", "web", "net", "data"]
    patterns = [f".*{a}.*{b}.*" for a in words for b in words]
    patterns += [f"^{a}[-.]" for a in words] + [rf"{a}\b" for a in words] + [f"({a}|{b})$" for a, b in zip(words, words[1:])]
    patterns += [f".*{a}\\.{b}.*" for a, b in zip(words, words[2:])]
    rng.shuffle(patterns)
    rules = [R.CategoryRule("java-archive", i, p, f"c{i}", f"s{i}", f"f{i}") for i, p in enumerate(patterns)]
    names = ["".join(rng.choice(words + [".", "-", ":", "X"]) for _ in range(rng.randrange(1, 5))) for _ in range(300)]
    expected = {}
    for name in names:
        hit = next((r for r in rules if re.search(r.pattern, name, re.IGNORECASE)), None)
        expected[name] = (hit.category, hit.sub_category, hit.framework) if hit else ("Other", "", "")
    given = deps(spark, *names, package_type="Java-Archive")
    for limit in (10_000, 3):
        monkeypatch.setattr(dependencies, "CASE_RULES", limit)
        found = categorize_dependencies(given, rules)
        assert found.count() == len(names)
        assert {r["package_name"]: tuple(r)[3:] for r in found.collect()} == expected


@pytest.mark.parametrize(
    "pattern, text",
    [
        (r"p{margin", "p{margin:0}"), (r"a{2}b", "xaab"), (r"a{,2}b", "ab"), (r"(?P<n>x)\d", "x9"), (r"\{\{", "{{ x"),
        (r"x{", "x{"), (r"[{}]+$", "{}"), (r"\w+é", "caféé"), (r"^b$", "a\nb\nc"), (r"a.b", "a\rb"), (r"kafka\.clients", "kafka-clients"),
        (r"[a&&b]", "&"), (r"[[]", "["), (r"a$", "a\n"), (r".*\.tf.*", "main.tf"), (r"}", "}"), (r"a{1,}", "aaa"),
    ],
)
@pytest.mark.parametrize("ignore_case", [False, True])
@pytest.mark.parametrize("multiline", [False, True])
def test_search_equals_python(spark, pattern, text, ignore_case, multiline):
    flags = (re.IGNORECASE if ignore_case else 0) | (re.MULTILINE if multiline else 0)
    texts = [text, text.upper(), "zz" + text, text + "zz", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    hit = search("t", pattern, ignore_case=ignore_case, multiline=multiline)
    for t, found in df.select("t", hit).collect():
        assert found == bool(re.search(pattern, t, flags)), (pattern, t)


def test_java_regex_spelling():
    assert java_regex(r"(?P<a>x){2}{") == r"(?<a>x){2}\{"
    assert java_regex(r"\{[{]") == r"\{[{]"


TF = R.IacRule(0, "Infra", "Prov", "Terraform", (r"\.tf$",), (r'resource\s+"[\w-]+"',))


def test_iac_rules(spark):
    docker = R.IacRule(1, "Container", "Image", "Dockerfile", ("^Dockerfile$",), ())
    other = R.IacRule(2, "Container", "Image", "Base", ("^Dockerfile", r"\.docker$"), ("^from alpine", "nothing"))
    unused = R.IacRule(3, "Container", "Image", "NoFiles", (), ("x",))
    files = repo_files(
        spark,
        ("m.tf", 'RESOURCE  "x"'), ("n.tf", "variable"), ("m.TF", 'resource "x"'), ("u.tf", None),
        ("a/Dockerfile", "# x\nFROM alpine"), ("b/Dockerfile", None), ("Dockerfile.x", "run from alpine"),
    )
    found = rows(iac_matches(files, [TF, docker, other, unused]), "path", "framework")
    assert found == [
        ("a/Dockerfile", "Base"), ("a/Dockerfile", "Dockerfile"), ("b/Dockerfile", "Dockerfile"), ("m.tf", "Terraform"),
    ]
    assert iac_matches(files, []).count() == 0


def test_many_iac_rules_equal_a_plain_loop(spark):
    rng = random.Random(5)
    exts = ["tf", "yaml", "py", "json", "go", "x"]
    words = ["apply", "kind:", "import", "resource", "{{", "FROM"]
    rules = [
        R.IacRule(i, f"c{i % 7}", f"s{i}", f"f{i}",
                  tuple(rf"\.{rng.choice(exts)}$" for _ in range(rng.randrange(1, 3))),
                  tuple(rng.choice(["^" + w if w[0].isalpha() else w for w in words]) for _ in range(rng.randrange(0, 3))))
        for i in range(230)
    ]
    files = [(f"d{i}/n{i}.{rng.choice(exts)}", "\n".join(rng.choice(words) + "x" for _ in range(4))) for i in range(60)]
    expected = sorted(
        (path, r.framework)
        for path, content in files
        for r in rules
        if any(re.search(p, path.rsplit("/", 1)[-1]) for p in r.file_patterns)
        and (not r.content_patterns or any(re.search(p, content, re.M | re.I) for p in r.content_patterns))
    )
    assert rows(iac_matches(repo_files(spark, *files), rules), "path", "framework") == expected


@pytest.mark.parametrize("version, jdk", [("8.12.3", "21"), ("7.6.9", "17"), ("0.1", UNKNOWN_JDK), ("7.3", "17"),
                                          ("7.2.5", "11"), ("4.10.3", "8"), ("8.3", "17"), ("", UNKNOWN_JDK)])
def test_jdk_for_gradle(spark, version, jdk):
    df = spark.createDataFrame([(version,)], "version string")
    assert df.select(jdk_for_gradle(F.col("version"))).first()[0] == jdk


def test_jdk_lookups_equal_a_plain_loop(spark):
    table = R.gradle_jdk_map()
    assert len(table) == 148
    rng = random.Random(11)
    versions = [".".join(str(rng.randrange(14)) for _ in range(rng.randrange(1, 5))) for _ in range(300)]
    expected = []
    for v in versions:
        parts = v.split(".")
        while parts and ".".join(parts) not in table:
            parts.pop()
        expected.append((v, table[".".join(parts)] if parts else UNKNOWN_JDK))
    df = spark.createDataFrame([(v,) for v in versions], "version string")
    assert rows(df.withColumn("jdk", jdk_for_gradle(F.col("version")))) == sorted(expected)
    joined = jdk_lookup(df, spark.createDataFrame(list(table.items()), "version string, jdk string"))
    assert rows(joined, "version", "jdk") == sorted(expected)


def test_rule_files(spark, tmp_path):
    folder = tmp_path / "python"
    folder.mkdir()
    (folder / "b.yaml").write_text(
        "categories:\n- name: B\n  subcategories:\n  - name: S\n    patterns: ['b1', '(', 'never']\n"
    )
    (folder / "a.yml").write_text(
        "categories:\n- name: A\n  subcategories:\n  - frameworks:\n    - name: F\n      patterns: ['a1', 'a2']\n"
        "  - name: T\n    patterns: ['a3']\n"
    )
    (folder / "c.json").write_text('{"categories": [{"name": "C", "subcategories": [{"patterns": ["c1"]}]}]}')
    (folder / "d.yaml").write_text("categories: [")
    loaded = R.load_category_rules(spark, str(tmp_path), "Python")
    assert [(r.ord, r.pattern, r.category, r.sub_category, r.framework) for r in loaded] == [
        (0, "a1", "A", "unnamed", "F"), (1, "a2", "A", "unnamed", "F"), (2, "a3", "A", "T", ""),
        (3, "b1", "B", "S", ""), (4, "c1", "C", "unnamed", ""),
    ]
    assert R.load_category_rules(spark, str(tmp_path), "cobol") == []
    frame = R.category_rules_frame(spark, loaded)
    assert R.category_rules_from_frame(frame.orderBy(F.desc("ord"))) == loaded


def test_iac_rule_files(spark, tmp_path):
    (tmp_path / "r.yaml").write_text(
        "categories:\n- name: C\n  subcategories:\n  - name: S\n    frameworks:\n    - name: F\n"
        "      file_patterns: ['\\.tf$']\n    - name: G\n      file_patterns: ['x']\n      content_patterns: ['y']\n"
    )
    (tmp_path / "other.yaml").write_text("nothing: 1\n")
    loaded = R.load_iac_rules(spark, str(tmp_path))
    assert loaded == [R.IacRule(0, "C", "S", "F", (r"\.tf$",)), R.IacRule(1, "C", "S", "G", ("x",), ("y",))]
    assert R.iac_rules_from_frame(R.iac_rules_frame(spark, loaded)) == loaded
