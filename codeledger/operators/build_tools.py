"""Build tools and runtime versions read from repository files.

Inputs are ``repo_files`` rows (repo_id, path, size, content).  Each job first
narrows to the files it reads, extracts the few values it needs in the scan
stage, and shuffles only those; file contents never move.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from codeledger.functions.scalars import (
    BUILD_SCAN_EXCLUDED_DIRS,
    VERSION_SCAN_EXCLUDED_DIRS,
    basename,
    dirname,
    in_excluded_dir,
    is_gradle_file,
    non_empty,
    strip,
    without_qualifier,
)
from codeledger.functions.patterns import java_regex, literal_map
from codeledger.sources.rules import GRADLE_VERSION_RULES, gradle_jdk_map

UNKNOWN_JDK = "JDK version unknown"


def _group(content: Column, pattern: str, flags: str = "") -> Column:
    """First capture of the first match, NULL when there is none."""
    prefix = f"(?{flags})" if flags else ""
    return non_empty(F.regexp_extract(content, prefix + pattern, 1))


# --- Gradle ---------------------------------------------------------------


def jdk_for_gradle(version: Column, jdk_map: Mapping[str, str] | None = None) -> Column:
    """JDK of the longest dotted prefix of ``version`` that the table knows."""
    table = literal_map(jdk_map or gradle_jdk_map())
    parts = F.split(version, r"\.")
    lengths = F.sequence(F.size(parts), F.lit(1), F.lit(-1))
    found = F.transform(lengths, lambda n: table[F.array_join(F.slice(parts, F.lit(1), n), ".")])
    return F.coalesce(F.get(F.array_compact(found), F.lit(0)), F.lit(UNKNOWN_JDK))


def jdk_lookup(versions: DataFrame, jdk_table: DataFrame, column: str = "version") -> DataFrame:
    """As ``jdk_for_gradle`` for a lookup table (version, jdk) of any size: an equi join."""
    rows = versions.select(column).distinct()
    parts = F.split(F.col(column), r"\.")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), ".")
    )
    tried = rows.select(column, F.posexplode(prefixes).alias("_n", "_prefix"))
    known = jdk_table.select(F.col("version").alias("_prefix"), F.col("jdk").alias("_jdk"))
    best = tried.join(known, "_prefix").groupBy(column).agg(F.max_by("_jdk", "_n").alias("jdk"))
    joined = versions.join(best, column, "left")
    return joined.select(*versions.columns, F.coalesce("jdk", F.lit(UNKNOWN_JDK)).alias("jdk"))


def gradle_version_in(
    path: Column, content: Column, rules: Sequence[tuple[str, str]] = GRADLE_VERSION_RULES
) -> Column:
    """The Gradle version a file states, without qualifier, NULL when none."""
    stated = None
    for file, pattern in rules:
        applies = (path == file) | path.endswith("/" + file)
        value = _group(content, java_regex(pattern), "dm")
        stated = F.when(applies, value) if stated is None else stated.when(applies, value)
    return non_empty(without_qualifier(stated))


def gradle_candidates(
    repo_files: DataFrame, rules: Sequence[tuple[str, str]] = GRADLE_VERSION_RULES
) -> DataFrame:
    """Version-bearing files outside build output, wrapper files ranked first."""
    path = F.col("path")
    wrapper_rank = F.when(F.array_contains(F.split(path, "/"), "wrapper"), 0).otherwise(1)
    version = gradle_version_in(path, F.col("content"), rules)
    return repo_files.where(is_gradle_file(path) & ~in_excluded_dir(path, VERSION_SCAN_EXCLUDED_DIRS)).select(
        "repo_id", "path", wrapper_rank.alias("rank"), version.alias("version")
    )


def gradle_versions(
    repo_files: DataFrame,
    rules: Sequence[tuple[str, str]] = GRADLE_VERSION_RULES,
    jdk_map: Mapping[str, str] | None = None,
) -> DataFrame:
    """(repo_id, tool, tool_version, runtime_version, error) of Gradle repositories.

    The first file that states a version wins.  Files without any version give
    an error row; a repository without Gradle files gives none.
    """
    order = F.when(F.col("version").isNotNull(), F.struct("rank", "path"))
    candidates = gradle_candidates(repo_files, rules)
    chosen = candidates.groupBy("repo_id").agg(F.min_by("version", order).alias("tool_version"))
    known = F.col("tool_version").isNotNull()
    return chosen.select(
        "repo_id",
        F.lit("gradle").alias("tool"),
        "tool_version",
        F.when(known, jdk_for_gradle(F.col("tool_version"), jdk_map)).alias("runtime_version"),
        F.when(~known, F.lit("Gradle version detection failed")).alias("error"),
    )


# --- Maven ----------------------------------------------------------------

_POM = "{http://maven.apache.org/POM/4.0.0}"


def _compiler_level(pom: str | None) -> str | None:
    """Release or source level of the first configured compiler plugin."""
    if pom is None:
        return None
    try:
        for plugin in ElementTree.fromstring(pom.encode("utf-8")).findall(f".//{_POM}plugin"):
            config = plugin.find(f"{_POM}configuration")
            if plugin.findtext(f"{_POM}artifactId") != "maven-compiler-plugin" or config is None:
                continue
            for level in (config.find(f"{_POM}release"), config.find(f"{_POM}source")):
                if level is not None:
                    return level.text.strip()
    except (ElementTree.ParseError, AttributeError, ValueError):
        return None
    return None


@F.pandas_udf(StringType())
def compiler_level(poms: pd.Series) -> pd.Series:
    """Spark's xpath functions fail the query on malformed XML, so this parses in Arrow batches."""
    return poms.map(_compiler_level)


def maven_projects(repo_files: DataFrame) -> DataFrame:
    """(repo_id, project_dir, tool, tool_version, runtime_version) of Maven projects.

    A root ``pom.xml`` makes the repository one project; without it every
    folder with a ``pom.xml`` is one.
    """
    path, content = F.col("path"), F.col("content")
    wrapper, jvm = ".mvn/wrapper/maven-wrapper.properties", ".mvn/jvm.config"
    is_pom = basename(path) == "pom.xml"
    is_wrapper = (path == wrapper) | path.endswith("/" + wrapper)
    is_jvm = (path == jvm) | path.endswith("/" + jvm)
    owner = (
        F.when(is_pom, dirname(path))
        .when(is_wrapper, F.regexp_replace(path, r"(^|/)\.mvn/wrapper/[^/]*$", ""))
        .when(is_jvm, F.regexp_replace(path, r"(^|/)\.mvn/[^/]*$", ""))
    )
    wrapper_version = _group(content, r"^distributionUrl[^\r\n]*?apache-maven-([0-9.]+)-bin", "m")
    facts = repo_files.where(is_pom | is_wrapper | is_jvm).select(
        "repo_id",
        owner.alias("project_dir"),
        is_pom.alias("pom"),
        compiler_level(F.when(is_pom, content)).alias("level"),
        F.when(is_wrapper, wrapper_version).alias("maven"),
        F.when(is_jvm, _group(content, r"--release\s+(\d+)")).alias("release"),
    )
    projects = (
        facts.groupBy("repo_id", "project_dir")
        .agg(
            F.bool_or("pom").alias("has_pom"),
            F.max("level").alias("level"),
            F.max("maven").alias("maven"),
            F.max("release").alias("release"),
        )
        .where("has_pom")
    )
    # from the paths alone, so the contents are read once
    rooted = repo_files.where(path == "pom.xml").select("repo_id", F.lit(True).alias("_rooted")).distinct()
    kept = projects.join(rooted, "repo_id", "left").where(
        (F.col("project_dir") == "") | F.col("_rooted").isNull()
    )
    return kept.select(
        "repo_id",
        "project_dir",
        F.lit("maven").alias("tool"),
        F.coalesce("maven", F.lit("unspecified")).alias("tool_version"),
        F.coalesce("level", "release", F.lit("unspecified")).alias("runtime_version"),
    )


# --- Go -------------------------------------------------------------------

# Marker file and tool, in order of preference.
GO_MARKERS = [
    ("go.mod", "Go Modules"),
    ("Gopkg.toml", "dep"),
    ("glide.yaml", "glide"),
    ("vendor/vendor.json", "govendor"),
]


def _first_line(content: Column, pattern: str) -> Column:
    """The first line matching ``pattern`` (one capture), NULL when none does."""
    lines = F.filter(F.split(content, r"\r\n|\r|\n"), lambda line: line.rlike(pattern))
    return F.get(lines, F.lit(0))


def go_tools(repo_files: DataFrame) -> DataFrame:
    """(repo_id, tool, tool_version, runtime_version) of Go repositories."""
    path, content = F.col("path"), F.col("content")
    markers = [name for name, _ in GO_MARKERS]
    relevant = repo_files.where(path.isin(markers + [".go-version", "Gopkg.lock"]) | path.endswith(".go"))
    go_line = _first_line(content, r"^go ")
    lock_line = _first_line(content, r"^version = ")
    glide_line = _first_line(content, r"^\s*version:")
    values = relevant.select(
        "repo_id",
        *[(path == name).alias(f"m{i}") for i, name in enumerate(markers)],
        F.when(path == "go.mod", F.element_at(F.split(strip(go_line), r"\s+"), -1)).alias("go_mod"),
        F.when(path == ".go-version", strip(content)).alias("go_file"),
        F.when(
            path == "Gopkg.lock", F.btrim(strip(F.element_at(F.split(lock_line, "="), -1)), F.lit('"'))
        ).alias("dep"),
        F.when(path == "glide.yaml", strip(F.element_at(F.split(glide_line, ":"), -1))).alias("glide"),
        (path.isin(markers) | path.endswith(".go")).alias("is_go"),
    )
    found = values.groupBy("repo_id").agg(
        *[F.bool_or(f"m{i}").alias(f"m{i}") for i in range(len(markers))],
        *[F.max(c).alias(c) for c in ("go_mod", "go_file", "dep", "glide")],
        F.bool_or("is_go").alias("is_go"),
    )
    tool = None
    for i, (_, label) in enumerate(GO_MARKERS):
        tool = F.when(F.col(f"m{i}"), label) if tool is None else tool.when(F.col(f"m{i}"), label)
    version = (
        F.when(F.col("tool") == "dep", F.col("dep")).when(F.col("tool") == "glide", F.col("glide"))
    )
    # lock and version files alone are not a Go project
    return (
        found.where("is_go")
        .withColumn("tool", tool.otherwise("Go Modules"))
        .select(
            "repo_id",
            "tool",
            F.coalesce(version, F.lit("Unknown")).alias("tool_version"),
            F.coalesce("go_mod", "go_file", F.lit("Unknown")).alias("runtime_version"),
        )
    )


# --- JavaScript -----------------------------------------------------------

# Lock file and tool, in order of preference.
JS_LOCK_FILES = [("yarn.lock", "Yarn"), ("pnpm-lock.yaml", "pnpm"), ("package-lock.json", "npm")]


def _kind(doc: Column, path: str) -> Column:
    """JSON type name at ``path``, NULL when the path is absent."""
    return F.schema_of_variant(F.try_variant_get(doc, path, "variant"))


def js_tools(repo_files: DataFrame) -> DataFrame:
    """(repo_id, directory, tool, tool_version, runtime_version) per ``package.json`` folder."""
    name, content = basename(F.col("path")), F.col("content")
    locks = [lock for lock, _ in JS_LOCK_FILES]
    relevant = repo_files.where(name.isin(["package.json"] + locks))
    is_package = name == "package.json"
    doc = F.when(is_package, F.try_parse_json(content)).alias("doc")
    rows = relevant.select("repo_id", dirname(F.col("path")).alias("directory"), name.alias("name"), doc)
    d = F.col("doc")

    def text(path: str) -> Column:
        return F.try_variant_get(d, path, "string")

    def is_kind(path: str, *kinds: str) -> Column:
        """The value at ``path`` is absent or of one of these JSON types."""
        kind = _kind(d, path)
        matching = F.lit(False)
        for k in kinds:
            matching = matching | kind.startswith(k)
        return kind.isNull() | matching

    no_object = ~is_kind("$", "OBJECT")
    # a number or null cannot be searched for a name: the folder is given up
    broken = ~is_kind("$", "OBJECT", "ARRAY", "STRING") | ~is_kind("$.packageManager", "STRING", "OBJECT", "ARRAY")
    bad_engines = no_object | ~is_kind("$.engines", "OBJECT") | ~is_kind("$.engines.node", "STRING")
    bad_deps = ~is_kind("$.dependencies", "OBJECT") | ~is_kind("$.devDependencies", "OBJECT")
    unknown = F.lit("Unknown")
    node = F.when(bad_engines, unknown).otherwise(strip(F.coalesce(text("$.engines.node"), unknown)))
    package = F.when(
        d.isNotNull(),
        F.struct(
            broken.alias("broken"),
            F.when(is_kind("$.packageManager", "STRING"), text("$.packageManager")).alias("manager"),
            node.alias("node"),
            (bad_engines | bad_deps).alias("no_deps"),
            text("$.dependencies.npm").alias("npm"),
            text("$.devDependencies.yarn").alias("yarn"),
            text("$.devDependencies.pnpm").alias("pnpm"),
        ),
    )
    per_dir = (
        rows.select("repo_id", "directory", "name", package.alias("p"))
        .groupBy("repo_id", "directory")
        .agg(
            F.max("p").alias("p"),
            *[F.bool_or(F.col("name") == lock).alias(tool) for lock, tool in JS_LOCK_FILES],
        )
        .where(F.col("p").isNotNull() & ~F.col("p.broken"))
    )
    manager = F.col("p.manager")
    tool = (
        F.when(manager.contains("yarn"), "Yarn")
        .when(manager.contains("pnpm"), "pnpm")
        .when(manager.contains("npm"), "npm")
    )
    for _, lock_tool in JS_LOCK_FILES:
        tool = tool.when(F.col(lock_tool), lock_tool)
    version = (
        F.when(F.col("p.no_deps"), "Unknown")
        .when(F.col("tool") == "npm", F.coalesce("p.npm", F.lit("bundled")))
        .when(F.col("tool") == "Yarn", F.coalesce("p.yarn", F.lit("Unknown")))
        .otherwise(F.coalesce("p.pnpm", F.lit("Unknown")))
    )
    return per_dir.withColumn("tool", tool.otherwise("npm")).select(
        "repo_id", "directory", "tool", version.alias("tool_version"), F.col("p.node").alias("runtime_version")
    )


# --- Python ---------------------------------------------------------------


def python_tools(repo_files: DataFrame) -> DataFrame:
    """(repo_id, tool, tool_version, runtime_version), one row per tool at the root.

    Any ``requirements.txt`` and no tool at all means pip without versions.
    """
    path, content = F.col("path"), F.col("content")
    root_files = [
        "poetry.lock",
        "pyproject.toml",
        "Pipfile.lock",
        "Pipfile",
        "setup.py",
        "setup.cfg",
        "hatch.toml",
    ]
    relevant = repo_files.where(path.isin(root_files) | (basename(path) == "requirements.txt"))

    def at(file: str, pattern: str) -> Column:
        return F.when(path == file, _group(content, pattern))

    pip_version = F.try_variant_get(F.try_parse_json(content), "$._meta.requires.pip_version", "string")
    has_poetry = (path == "poetry.lock") | ((path == "pyproject.toml") & content.contains("[tool.poetry]"))
    flags = {
        "poetry": F.coalesce(has_poetry, F.lit(False)),
        "pipenv": path.isin("Pipfile.lock", "Pipfile"),
        "setuptools": path.isin("setup.py", "setup.cfg"),
        "hatch": path == "hatch.toml",
        "requirements": basename(path) == "requirements.txt",
    }
    values = {
        "poetry_version": at("poetry.lock", r'poetry-version\s*=\s*"([^"]+)"'),
        "poetry_python": at("pyproject.toml", r'python\s*=\s*"([^"]+)"'),
        "pipenv_version": F.when(path == "Pipfile.lock", pip_version),
        "pipenv_python": at("Pipfile", r'python_version\s*=\s*"([^"]+)"'),
        "setuptools_version": at("setup.py", r"setuptools>=([\d.]+)"),
        "setuptools_python": at("setup.py", r"""python_requires\s*=\s*["']([^"']+)"""),
    }
    # the projection drops the content before the aggregate sorts or shuffles
    facts = relevant.select("repo_id", *[e.alias(n) for n, e in {**flags, **values}.items()])
    seen = facts.groupBy("repo_id").agg(
        *[F.bool_or(n).alias(n) for n in flags], *[F.max(n).alias(n) for n in values]
    )
    none = F.lit(None).cast("string")

    def tool(present: Column, label: str, version: Column, runtime: Column) -> Column:
        row = F.struct(
            F.lit(label).alias("tool"), version.alias("tool_version"), runtime.alias("runtime_version")
        )
        return F.when(present, row)

    c = F.col
    any_tool = c("poetry") | c("pipenv") | c("setuptools") | c("hatch")
    tools = F.array_compact(
        F.array(
            tool(c("poetry"), "Poetry", c("poetry_version"), c("poetry_python")),
            tool(c("pipenv"), "Pipenv", c("pipenv_version"), c("pipenv_python")),
            tool(c("setuptools"), "Setuptools", c("setuptools_version"), c("setuptools_python")),
            tool(c("hatch"), "Hatch", none, none),
            tool(c("requirements") & ~any_tool, "pip", none, none),
        )
    )
    return seen.select("repo_id", F.explode(tools).alias("t")).select("repo_id", "t.*")


# --- Project kind -----------------------------------------------------------


def project_kinds(repo_files: DataFrame) -> DataFrame:
    """(repo_id, is_gradle, is_maven, is_locked) per repository."""
    path = F.col("path")
    gradle = basename(path).startswith("build.gradle") & ~in_excluded_dir(path, BUILD_SCAN_EXCLUDED_DIRS)
    return repo_files.groupBy("repo_id").agg(
        F.bool_or(gradle).alias("is_gradle"),
        F.bool_or(path == "pom.xml").alias("is_maven"),
        F.bool_or(path == "gradle.lockfile").alias("is_locked"),
    )

