import json
import re

from pyspark.sql import functions as F

from codeledger import schemas
from codeledger.operators import sbom
from codeledger.operators.dependencies import infer_build_tool, sbom_dependencies

from helpers import repo_files, rows

GAV = ["group", "artifact", "version"]


def declared(spark, text):
    found = sbom.gradle_dependencies(repo_files(spark, ("build.gradle", text)))
    return [tuple(r) for r in found.orderBy("pos").select(*GAV).collect()]


def test_dependency_styles(spark):
    text = "implementation 'a:b:1'\napi(\"c:d\")\ncompile { group: 'g', name: 'n', version: '2' }\n"
    assert declared(spark, text) == [("a", "b", "1"), ("c", "d", "unknown"), ("g", "n", "2")]


def test_odd_declarations(spark):
    text = """
    subprojects { implementation 'shared:lib:1' }
    implementation 'g:a:1:sources'
    runtimeOnly(
        'h:i:2'
    )
    testImplementation "j : k : 3"
    compile { group : 'm', name : "n" }
    kapt 'no:no:1'
    implementation project(':core')
    implementation 'justname'
    """
    assert declared(spark, text) == [
        ("shared", "lib", "1"), ("shared", "lib", "1"), ("g:a", "1", "sources"), ("h", "i", "2"), ("j", "k", "3"),
        ("m", "n", "unknown"),
    ]


def test_no_content_no_dependencies(spark):
    assert declared(spark, None) == [] and declared(spark, "") == []


def test_included_modules(spark):
    files = repo_files(
        spark,
        ("settings.gradle", "include 'app:core'\nINCLUDE ':lib.x', ':second'\ninclude 'gone'\nincludeBuild 'b'\ninclude(':c')"),
        ("app/core/build.gradle", ""), ("lib/x/src/A.java", ""), ("b/f", ""), ("c/f", ""), ("second/f", ""),
        ("deep/settings.gradle.kts", 'include "m"'), ("deep/m/n/f", ""),
    )
    assert rows(sbom.included_modules(files), "root", "dir") == [("", "app/core"), ("", "lib/x"), ("deep", "deep/m")]
    assert ("", "gone") in rows(sbom.included_modules(files, check_exists=False), "root", "dir")


def test_build_files_of_unlocked_modules(spark):
    files = repo_files(
        spark,
        ("build.gradle", "api 'a:a:1'"), ("settings.gradle", "include ':core'"), ("core/deps.gradle", "api 'b:b:1'"),
        ("gradle.properties", "x"), ("gradle/libs.versions.toml", "y"), ("other/deps.gradle", "api 'c:c:1'"),
        ("locked/build.gradle", "api 'd:d:1'"), ("locked/gradle.lockfile", ""), ("target/build.gradle", "api 'e:e:1'"),
    )
    assert rows(sbom.unlocked_modules(files), "dir") == [("",), ("target",)]
    assert rows(sbom.gradle_build_files(files), "path") == [
        ("build.gradle",), ("core/deps.gradle",), ("gradle.properties",), ("gradle/libs.versions.toml",), ("settings.gradle",),
    ]


def artifacts(spark, entries, path=None):
    data = [("r", pos, json.dumps(a)) for pos, a in enumerate(entries)]
    df = spark.createDataFrame(data, "repo_id string, pos int, j string")
    df = df.select("repo_id", "pos", F.from_json("j", schemas.ARTIFACT).alias("a"))
    return df if path is None else df.withColumn("path", F.lit(path))


def test_merge_keeps_base_copies_sorted_by_name(spark):
    base = artifacts(spark, [{"name": "Zed", "version": "1", "purl": "a"}, {"name": "n", "version": "1", "type": "base"}])
    module = artifacts(spark, [{"name": "zed", "purl": "a"}, {"name": "n", "version": "1"}, {"name": "beta", "version": "2"}], "m")
    merged = sbom.sorted_artifacts(sbom.merge_artifacts(base, module))
    assert [(r["a"]["name"], r["a"]["type"], r["source_ord"]) for r in merged.collect()] == [
        ("beta", None, 1), ("n", "base", 0), ("Zed", None, 0),
    ]


def test_from_build_file_to_dependencies(spark):
    files = repo_files(spark, ("build.gradle", "api 'g:b:1'\nallprojects { api 'g:a:2' }\napi 'g:c'"))
    gradle = sbom.gradle_artifacts(sbom.gradle_dependencies(files))
    merged = sbom.merge_artifacts(artifacts(spark, [{"name": "gradle-wrapper", "version": " 8.5 ", "type": "x"}]), gradle)
    deps = sbom_dependencies(merged, sbom.MERGED_ORDER)
    assert rows(deps, "package_name", "version", "package_type", "locations") == [
        ("g:a", "2", "java-archive", "pkg:gradle/g/a"),
        ("g:b", "1", "java-archive", "pkg:gradle/g/b"),
        ("g:c", "Unknown", "java-archive", "pkg:gradle/g/c"),
        ("gradle-wrapper", " 8.5 ", "x", ""),
    ]
    assert rows(infer_build_tool(deps), "build_tool") == [("gradle-wrapper:8.5",)]


def _fold(entries):
    """The inference as a plain loop over ordered dependencies."""
    label, wrapper = None, re.compile("(gradle|maven)-wrapper")
    for name, kind, version, places in entries:
        hit = "gradle-wrapper" if "gradle-wrapper" in name else wrapper.search(name) and "maven-wrapper"
        if hit:
            return hit + (":" + version if version else "")
        if kind == "java-archive" and "pom.xml" in places:
            label = "maven"
        label = label or {"python": "python", "npm": "node", "go-module": "go", "gem": "ruby"}.get(kind)
    return label or "Unknown"


def test_build_tool_inference_equals_a_plain_loop(spark):
    import random

    rng = random.Random(2)
    repos = {"empty": [("x", "deb", "1", "")]}
    for i in range(120):
        repos[f"r{i}"] = [
            (
                rng.choice(["x"] * 8 + ["my-gradle-wrapper", "maven-wrapper"]),
                rng.choice(["python", "npm", "go-module", "gem", "java-archive", "deb"]),
                rng.choice(["", "1", "2"]),
                rng.choice(["", "/a/pom.xml"]),
            )
            for _ in range(rng.randrange(1, 6))
        ]
    data = [(r, i, *e) for r, entries in repos.items() for i, e in enumerate(entries)]
    df = spark.createDataFrame(
        data, "repo_id string, ord int, package_name string, package_type string, version string, locations string"
    ).repartition(5)
    assert dict(rows(infer_build_tool(df))) == {r: _fold(e) for r, e in repos.items()}
