"""Gradle dependency extraction and the merge of artifact lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeledger import schemas
from codeledger.functions.scalars import (
    BUILD_SCAN_EXCLUDED_DIRS,
    artifact_key,
    basename,
    dirname,
    in_excluded_dir,
    maven_purl,
    non_empty,
    strip,
)
from codeledger.operators.lists import keep_first

# The configurations whose dependencies count.
CONFIGURATIONS = [
    "implementation",
    "api",
    "compile",
    "runtimeOnly",
    "testImplementation",
    "compileOnly",
    "annotationProcessor",
]
_CONF = "(?:" + "|".join(CONFIGURATIONS) + ")"
_QUOTED = r"""['"]([^'"]+)['"]"""

# How a build file states a dependency, a shared block, a module.
STRING_STYLE = _CONF + r"""\s*\(?\s*['"]([^'":]+:[^'":]+(?::[^'"]+)?)['"]\s*\)?"""
MAP_STYLE = (
    _CONF
    + r"\s+\{\s*group\s*:\s*" + _QUOTED
    + r"\s*,\s*name\s*:\s*" + _QUOTED
    + r"\s*(?:,\s*version\s*:\s*" + _QUOTED + r")?\s*\}"
)
SHARED_BLOCK = r"(?:allprojects|subprojects)\s*\{([^}]*)\}"
INCLUDE = r"""(?i)include\s*['"](.*?)['"]"""


def _all(content: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(content, F.lit(pattern), F.lit(group))


def _coordinate(text: Column) -> Column:
    """struct<group, artifact, version> of ``g:a[:v]``; further parts belong to the group."""
    parts = F.transform(F.split(text, ":"), lambda p: strip(p))
    n = F.size(parts)
    long = n >= 3
    group = F.when(long, F.array_join(F.slice(parts, F.lit(1), n - 2), ":")).otherwise(F.get(parts, F.lit(0)))
    artifact = F.when(long, F.get(parts, n - 2)).otherwise(F.get(parts, F.lit(1)))
    version = F.when(long, F.coalesce(non_empty(F.get(parts, n - 1)), F.lit("unknown"))).otherwise("unknown")
    return F.struct(group.alias("group"), artifact.alias("artifact"), version.alias("version"))


def declared_dependencies(content: Column) -> Column:
    """Array of struct<group, artifact, version> a build file declares, in order.

    Bodies of shared blocks come first and are read again with the whole file,
    so their dependencies appear twice; the merge removes the copies.
    """
    bodies = _all(content, SHARED_BLOCK, 1)
    in_blocks = F.flatten(F.transform(bodies, lambda body: _all(body, STRING_STYLE, 1)))
    stated = F.concat(in_blocks, _all(content, STRING_STYLE, 1))
    zipped = F.arrays_zip(
        _all(content, MAP_STYLE, 1).alias("g"),
        _all(content, MAP_STYLE, 2).alias("n"),
        _all(content, MAP_STYLE, 3).alias("v"),
    )
    mapped = F.transform(
        zipped,
        lambda z: F.struct(
            strip(z["g"]).alias("group"),
            strip(z["n"]).alias("artifact"),
            F.coalesce(non_empty(strip(z["v"])), F.lit("unknown")).alias("version"),
        ),
    )
    return F.concat(F.transform(stated, _coordinate), mapped)


def gradle_dependencies(build_files: DataFrame) -> DataFrame:
    """(repo_id, path, pos, group, artifact, version) of build files; map-side only.

    Takes files with ``content``, or with the ``deps`` already extracted.
    """
    deps = F.col("deps") if "deps" in build_files.columns else declared_dependencies(F.col("content"))
    found = build_files.select("repo_id", "path", F.posexplode(deps).alias("pos", "d"))
    return found.select("repo_id", "path", "pos", "d.group", "d.artifact", "d.version")


def unlocked_modules(repo_files: DataFrame) -> DataFrame:
    """(repo_id, dir) of folders with a ``build.gradle*`` but no ``gradle.lockfile``."""
    name = basename(F.col("path"))
    built, locked = name.startswith("build.gradle"), name == "gradle.lockfile"
    folders = repo_files.where(built | locked).select(
        "repo_id", dirname(F.col("path")).alias("dir"), built.alias("built"), locked.alias("locked")
    )
    kinds = folders.groupBy("repo_id", "dir").agg(F.bool_or("built").alias("built"), F.bool_or("locked").alias("locked"))
    return kinds.where(F.col("built") & ~F.col("locked")).select("repo_id", "dir")


def _existing_dirs(repo_files: DataFrame) -> DataFrame:
    folders = repo_files.select("repo_id", dirname(F.col("path")).alias("dir")).distinct()
    parts = F.split("dir", "/")
    ancestors = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")
    )
    return folders.select("repo_id", F.explode(ancestors).alias("dir")).distinct()


def included_modules(repo_files: DataFrame, check_exists: bool = True) -> DataFrame:
    """(repo_id, root, dir) of modules the settings files in ``root`` include.

    ``:`` and ``.`` separate folders; only the first quoted name of an include
    counts.  A module must exist as a folder unless ``check_exists`` is off.
    """
    path = F.col("path")
    named = repo_files.where(basename(path).startswith("settings.gradle")).select(
        "repo_id", dirname(path).alias("root"), F.explode(_all(F.col("content"), INCLUDE, 1)).alias("name")
    )
    relative = F.regexp_replace(F.translate("name", ":.", "//"), "^/+", "")
    absolute = F.when(F.col("root") == "", relative).otherwise(F.concat_ws("/", "root", relative))
    declared = named.select("repo_id", "root", absolute.alias("dir")).distinct()
    if not check_exists:
        return declared
    return declared.join(_existing_dirs(repo_files), ["repo_id", "dir"], "left_semi").select(
        "repo_id", "root", "dir"
    )


def gradle_build_files(repo_files: DataFrame, modules: DataFrame | None = None) -> DataFrame:
    """(repo_id, path, deps) of the Gradle files in modules without a lock file.

    Dependencies are extracted in the scan stage, before the join, so contents
    are not shuffled.  A module that does not exist has no files to join.
    """
    roots = unlocked_modules(repo_files) if modules is None else modules
    included = included_modules(repo_files, check_exists=False)
    under = included.join(roots.select("repo_id", F.col("dir").alias("root")), ["repo_id", "root"], "left_semi")
    searched = roots.select("repo_id", "dir").unionByName(under.select("repo_id", "dir")).distinct()
    path, name = F.col("path"), basename(F.col("path"))
    catalog = (path == "gradle/libs.versions.toml") | path.endswith("/gradle/libs.versions.toml")
    wanted = name.contains(".gradle") | name.startswith("gradle.properties") | catalog
    folder = F.when(catalog, dirname(dirname(path))).otherwise(dirname(path))
    files = repo_files.where(wanted & ~in_excluded_dir(path, BUILD_SCAN_EXCLUDED_DIRS)).select(
        "repo_id", "path", folder.alias("dir"), declared_dependencies(F.col("content")).alias("deps")
    )
    return files.join(searched, ["repo_id", "dir"], "left_semi").select("repo_id", "path", "deps")


def gradle_artifacts(dependencies: DataFrame) -> DataFrame:
    """SBOM artifacts (repo_id, path, pos, a) of extracted Gradle dependencies."""
    version = F.when(F.col("version") != "unknown", F.col("version"))
    group, artifact = F.col("group"), F.col("artifact")
    place = F.concat(F.lit("pkg:gradle/"), group, F.lit("/"), artifact)
    a = F.struct(
        artifact.alias("name"),
        version.alias("version"),
        F.lit("java-archive").alias("type"),
        F.lit("java").alias("language"),
        maven_purl(group, artifact, version).alias("purl"),
        F.array().cast("array<struct<value: string>>").alias("licenses"),
        F.array(F.struct(place.alias("path"))).alias("locations"),
        F.struct(
            F.struct(group.alias("groupId"), artifact.alias("artifactId")).alias("pomProperties")
        ).alias("metadata"),
    )
    return dependencies.select("repo_id", "path", "pos", a.cast(schemas.ARTIFACT).alias("a"))


def merge_artifacts(base: DataFrame, *modules: DataFrame) -> DataFrame:
    """Artifact lists merged: (repo_id, name_key, source_ord, path, pos, a).

    ``base`` (repo_id, pos, a) comes before the module lists (repo_id, path,
    pos, a); the first copy of a package URL stays.  The four middle columns
    are the order of the merged list: name in any case, then source, then place.
    """
    lists = [base.withColumn("path", F.lit("")), *modules]
    tagged = None
    for source, rows in enumerate(lists):
        part = rows.select("repo_id", F.lit(source).alias("source_ord"), "path", "pos", "a")
        tagged = part if tagged is None else tagged.unionByName(part)
    key = artifact_key(F.col("a.purl"), F.col("a.name"), F.col("a.version"))
    kept = keep_first(tagged.withColumn("_key", key), ["repo_id", "_key"], ["source_ord", "path", "pos"])
    name_key = F.lower(F.coalesce("a.name", F.lit(""))).alias("name_key")
    return kept.select("repo_id", name_key, "source_ord", "path", "pos", "a")


MERGED_ORDER = ["name_key", "source_ord", "path", "pos"]


def sorted_artifacts(merged: DataFrame) -> DataFrame:
    return merged.orderBy("repo_id", *MERGED_ORDER)
