"""Rule tables: category rules, infrastructure rules, Gradle and ruleset lookups.

Rules are configuration.  They are read on the driver and travel inside query
plans as literals, so matching needs no join.
"""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

logger = logging.getLogger(__name__)

# Rule folder per package type.
RULE_FOLDERS = {
    "python": "python",
    "java-archive": "java",
    "npm": "javascript",
    "gem": "ruby",
    "dotnet": "dotnet",
    "go-module": "go",
}

# Ruleset folder per detected language.
RULESET_PATHS = {
    "java": "java",
    "javascript": "javascript",
    "java server pages": "java",
    "python": "python",
    "c": "c",
    "c++": "0xdea",
    "c#": "csharp",
    "go": "go",
    "ruby": "ruby",
    "typescript": "typescript",
    "kotlin": "kotlin",
    "rust": "rust",
    "shell": "bash",
    "perl": "bash",
    "scala": "scala",
    "objective-c": "objectivec",
    "sql": "sql",
    "html": "html",
    "dockerfile": "dockerfile",
    "hcl": "terraform",
    "asp.net": "csharp",
    "visual basic.net": "csharp",
    "visual basic 6.0": "csharp",
    "ocaml": "ocaml",
    "php": "php",
    "classic asp": "csharp",
    "html+erb": "ruby",
    "jinja": "python",
    "less": "html",
    "sass": "html",
    "scss": "html",
    "batchfile": "bash",
    "objective-c++": "objectivec",
}

# Where a Gradle version is stated, in order of priority.
GRADLE_VERSION_RULES = [
    (
        "gradle/wrapper/gradle-wrapper.properties",
        r"distributionUrl=.*/gradle-(\d+(?:\.\d+){0,3}(?:-\w+)?)-(?:bin|all)\.zip",
    ),
    ("build.gradle", r"""gradleVersion\s*[=:]\s*['"]?(\d+(?:\.\d+){0,3}(?:-\w+)?)["']?"""),
    ("build.gradle.kts", r"""gradleVersion\s*=?\s*["'](\d+(?:\.\d+){0,3}(?:-\w+)?)["']"""),
    ("settings.gradle", r"""gradleVersion\s*=\s*['"]?(\d+(?:\.\d+){0,3}(?:-\w+)?)["']?"""),
    ("settings.gradle.kts", r"""gradleVersion\s*=?\s*["'](\d+(?:\.\d+){0,3}(?:-\w+)?)["']"""),
    ("gradle.properties", r"gradleVersion\s*=\s*(\d+(?:\.\d+){0,3}(?:-\w+)?)"),
]

# The JDK of each Gradle release, newest first.
GRADLE_JDKS = {
    "8.13": "21",
    "8.12.1": "21",
    "8.12": "21",
    "8.11.1": "21",
    "8.11": "21",
    "8.10.2": "21",
    "8.10.1": "21",
    "8.10": "21",
    "8.9": "21",
    "8.8": "21",
    "8.7": "21",
    "8.6": "21",
    "8.5": "21",
    "8.4": "21",
    "8.3": "17",
    "8.2.1": "17",
    "8.2": "17",
    "8.1.1": "17",
    "8.1": "17",
    "8.0.2": "17",
    "8.0.1": "17",
    "8.0": "17",
    "7.6.4": "17",
    "7.6.3": "17",
    "7.6.2": "17",
    "7.6.1": "17",
    "7.6": "17",
    "7.5.1": "17",
    "7.5": "17",
    "7.4.2": "17",
    "7.4.1": "17",
    "7.4": "17",
    "7.3.3": "17",
    "7.3.2": "17",
    "7.3.1": "17",
    "7.3": "17",
    "7.2": "11",
    "7.1.1": "11",
    "7.1": "11",
    "7.0.2": "11",
    "7.0.1": "11",
    "7.0": "11",
    "6.9.4": "11",
    "6.9.3": "11",
    "6.9.2": "11",
    "6.9.1": "11",
    "6.9": "11",
    "6.8.3": "11",
    "6.8.2": "11",
    "6.8.1": "11",
    "6.8": "11",
    "6.7.1": "11",
    "6.7": "11",
    "6.6.1": "11",
    "6.6": "11",
    "6.5.1": "11",
    "6.5": "11",
    "6.4.1": "11",
    "6.4": "11",
    "6.3": "11",
    "6.2.2": "11",
    "6.2.1": "11",
    "6.2": "11",
    "6.1.1": "11",
    "6.1": "11",
    "6.0.1": "11",
    "6.0": "11",
    "5.6.4": "11",
    "5.6.3": "11",
    "5.6.2": "11",
    "5.6.1": "11",
    "5.6": "11",
    "5.5.1": "11",
    "5.5": "11",
    "5.4.1": "11",
    "5.4": "11",
    "5.3.1": "11",
    "5.3": "11",
    "5.2.1": "11",
    "5.2": "11",
    "5.1.1": "11",
    "5.1": "11",
    "5.0": "11",
    "4.10.3": "8",
    "4.10.2": "8",
    "4.10.1": "8",
    "4.10": "8",
    "4.9": "8",
    "4.8.1": "8",
    "4.8": "8",
    "4.7": "8",
    "4.6": "8",
    "4.5.1": "8",
    "4.5": "8",
    "4.4.1": "8",
    "4.4": "8",
    "4.3.1": "8",
    "4.3": "8",
    "4.2.1": "8",
    "4.2": "8",
    "4.1": "8",
    "4.0.2": "8",
    "4.0.1": "8",
    "4.0": "8",
    "3.5.1": "8",
    "3.5": "8",
    "3.4.1": "8",
    "3.4": "8",
    "3.3": "8",
    "3.2.1": "8",
    "3.2": "8",
    "3.1": "8",
    "3.0": "8",
    "2.14.1": "8",
    "2.14": "8",
    "2.13": "8",
    "2.12": "8",
    "2.11": "8",
    "2.10": "8",
    "2.9": "8",
    "2.8": "8",
    "2.7": "8",
    "2.6": "8",
    "2.5": "8",
    "2.4": "8",
    "2.3": "8",
    "2.2.1": "8",
    "2.2": "8",
    "2.1": "8",
    "2.0": "8",
    "1.12": "8",
    "1.11": "8",
    "1.10": "8",
    "1.9": "8",
    "1.8": "8",
    "1.7": "8",
    "1.6": "8",
    "1.5": "8",
    "1.4": "8",
    "1.3": "8",
    "1.2": "8",
    "1.1": "8",
    "1.0": "8",
    "0.9.2": "8",
    "0.9.1": "8",
    "0.9": "8",
    "0.8": "8",
    "0.7": "8",
}


def gradle_jdk_map() -> dict[str, str]:
    """JDK per Gradle release; ``load_gradle_jdk_map`` reads another one."""
    return dict(GRADLE_JDKS)


@dataclass(frozen=True)
class CategoryRule:
    package_type: str
    ord: int
    pattern: str
    category: str
    sub_category: str
    framework: str


@dataclass(frozen=True)
class IacRule:
    ord: int
    category: str
    subcategory: str
    framework: str
    file_patterns: tuple[str, ...] = ()
    content_patterns: tuple[str, ...] = field(default=())


CATEGORY_RULES_SCHEMA = (
    "package_type string, ord int, pattern string, category string, sub_category string, framework string"
)
IAC_RULES_SCHEMA = (
    "ord int, category string, subcategory string, framework string, "
    "file_patterns array<string>, content_patterns array<string>"
)


def _parse_document(name: str, text: str):
    if name.endswith(".json") or text.lstrip().startswith("{"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as error:  # pragma: no cover - depends on the machine
        raise RuntimeError("reading YAML rule files needs PyYAML; JSON rule files work without it") from error
    return yaml.safe_load(text)


def _read_documents(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """Name and text of the rule files in ``folder``, by name."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.{yaml,yml,json}")
        .option("recursiveFileLookup", "false")
        .load(folder)
    )
    rows = files.select("path", F.col("content").cast("string").alias("text")).collect()
    return sorted((row["path"].rsplit("/", 1)[-1], row["text"]) for row in rows)


def _tree_patterns(tree: dict) -> Iterable[tuple[str, str, str, str]]:
    """(pattern, category, subcategory, framework) in document order."""
    for category in tree.get("categories") or []:
        for sub in category.get("subcategories") or []:
            holders = sub.get("frameworks") or [{**sub, "name": ""}]
            for holder in holders:
                for pattern in holder.get("patterns") or []:
                    yield pattern, category["name"], sub.get("name", "unnamed"), holder.get("name", "unnamed")


def category_rules_from_trees(package_type: str, trees: Iterable[dict]) -> list[CategoryRule]:
    """Flat rules of nested documents; a broken document ends at its first fault."""
    rules: list[CategoryRule] = []
    for tree in trees:
        try:
            for pattern, category, sub, framework in _tree_patterns(tree):
                re.compile(pattern, re.IGNORECASE)
                rules.append(CategoryRule(package_type, len(rules), pattern, category, sub, framework))
        except Exception as error:  # noqa: BLE001 - any fault only drops the rest of this file
            logger.warning("rules of %s: rest of a file skipped: %s", package_type, error)
    return rules


def load_category_rules(spark: SparkSession, root: str, package_type: str) -> list[CategoryRule]:
    """Rules under ``root/<folder of the package type>``; none for an unknown type."""
    package_type = package_type.lower()
    folder = RULE_FOLDERS.get(package_type)
    if folder is None:
        return []
    trees = []
    for name, text in _read_documents(spark, f"{root.rstrip('/')}/{folder}"):
        try:
            trees.append(_parse_document(name, text))
        except RuntimeError:
            raise
        except Exception as error:  # noqa: BLE001 - one unreadable file is skipped
            logger.warning("rule file %s skipped: %s", name, error)
    return category_rules_from_trees(package_type, trees)


def load_all_category_rules_of(spark: SparkSession, root: str, package_types: Iterable[str]) -> list[CategoryRule]:
    return [rule for package_type in package_types for rule in load_category_rules(spark, root, package_type)]


def load_all_category_rules(spark: SparkSession, root: str) -> list[CategoryRule]:
    return load_all_category_rules_of(spark, root, RULE_FOLDERS)


def iac_rules_from_trees(trees: Iterable[dict]) -> list[IacRule]:
    rules: list[IacRule] = []
    for tree in trees:
        for category in (tree or {}).get("categories") or []:
            for sub in category.get("subcategories") or []:
                for framework in sub.get("frameworks") or []:
                    rules.append(
                        IacRule(
                            len(rules),
                            category["name"],
                            sub["name"],
                            framework["name"],
                            tuple(framework.get("file_patterns") or ()),
                            tuple(framework.get("content_patterns") or ()),
                        )
                    )
    return rules


def load_iac_rules(spark: SparkSession, folder: str) -> list[IacRule]:
    """The ``categories`` of every rule file in ``folder``, concatenated."""
    trees = []
    for name, text in _read_documents(spark, folder):
        try:
            trees.append(_parse_document(name, text))
        except RuntimeError:
            raise
        except Exception as error:  # noqa: BLE001
            logger.warning("rule file %s skipped: %s", name, error)
    return iac_rules_from_trees(trees)


def category_rules_frame(spark: SparkSession, rules: list[CategoryRule]) -> DataFrame:
    rows = [(r.package_type, r.ord, r.pattern, r.category, r.sub_category, r.framework) for r in rules]
    return spark.createDataFrame(rows, CATEGORY_RULES_SCHEMA)


def iac_rules_frame(spark: SparkSession, rules: list[IacRule]) -> DataFrame:
    rows = [
        (r.ord, r.category, r.subcategory, r.framework, list(r.file_patterns), list(r.content_patterns))
        for r in rules
    ]
    return spark.createDataFrame(rows, IAC_RULES_SCHEMA)


def category_rules_from_frame(rules: DataFrame) -> list[CategoryRule]:
    found = [CategoryRule(*(row[name] for name in CategoryRule.__dataclass_fields__)) for row in rules.collect()]
    return sorted(found, key=lambda r: (r.package_type, r.ord))


def iac_rules_from_frame(rules: DataFrame) -> list[IacRule]:
    found = [
        IacRule(
            row["ord"],
            row["category"],
            row["subcategory"],
            row["framework"],
            tuple(row["file_patterns"] or ()),
            tuple(row["content_patterns"] or ()),
        )
        for row in rules.collect()
    ]
    return sorted(found, key=lambda r: r.ord)


def gradle_rules_from_tree(tree: dict) -> list[tuple[str, str]]:
    """(file, regex) pairs of an ``extraction_rules`` document, in its order."""
    return [(rule["file"], rule["regex"]) for rule in tree["extraction_rules"]]


def ruleset_map_from_ini(text: str) -> dict[str, str]:
    """Language → ruleset path from an INI text with one section per language."""
    import configparser

    parser = configparser.ConfigParser()
    parser.read_string(text)
    return {s.lower(): parser.get(s, "path") for s in parser.sections() if parser.has_option(s, "path")}


def _one_document(spark: SparkSession, path: str):
    """The parsed rule file at ``path``."""
    rows = spark.read.format("binaryFile").load(path).select(F.col("content").cast("string")).collect()
    if len(rows) != 1:
        raise FileNotFoundError(path)
    return _parse_document(path, rows[0][0])


def load_gradle_jdk_map(spark: SparkSession, path: str) -> dict[str, str]:
    """JDK per Gradle release from a flat ``version: jdk`` file."""
    return {str(version): str(jdk) for version, jdk in _one_document(spark, path).items()}


def load_gradle_rules(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(file, regex) pairs from a rule file."""
    return gradle_rules_from_tree(_one_document(spark, path))


def load_ruleset_map(spark: SparkSession, path: str) -> dict[str, str]:
    """Language to ruleset path from an INI file."""
    return ruleset_map_from_ini("\n".join(row[0] for row in spark.read.option("wholetext", True).text(path).collect()))
