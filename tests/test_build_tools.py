import pytest

from codeledger.operators import build_tools as b

from helpers import repo_files, rows

TOOL = ["tool", "tool_version", "runtime_version"]
WRAPPER = "gradle/wrapper/gradle-wrapper.properties"


def zip_url(version):
    return f"distributionUrl=https\\://services/gradle-{version}-bin.zip\n"


@pytest.mark.parametrize(
    "entries, expected",
    [
        ([(WRAPPER, zip_url("8.5"))], ("8.5", "21", None)),
        ([(WRAPPER, zip_url("8.5-rc1"))], ("8.5", "21", None)),
        ([(WRAPPER, zip_url("8.5-rc-1"))], (None, None, "Gradle version detection failed")),
        ([("build.gradle", "gradleVersion = '6.9'"), (WRAPPER, zip_url("7.3"))], ("7.3", "17", None)),
        ([("build.gradle", "x"), ("app/settings.gradle.kts", 'gradleVersion = "5.1"')], ("5.1", "11", None)),
        ([("build.gradle", None), ("gradle.properties", "a=b\ngradleVersion=4.2\n")], ("4.2", "8", None)),
        ([("build/build.gradle", "gradleVersion = '6.9'"), ("x/gradle.properties", "")], (None, None, "Gradle version detection failed")),
        ([("build.gradle", "gradleVersion: 99.1")], ("99.1", b.UNKNOWN_JDK, None)),
    ],
)
def test_gradle_version(spark, entries, expected):
    found = rows(b.gradle_versions(repo_files(spark, *entries)), "tool_version", "runtime_version", "error")
    assert found == [expected]


def test_no_gradle_files_no_row(spark):
    files = repo_files(spark, ("out/build.gradle", "gradleVersion = '6.9'"), ("README", "gradleVersion = '1'"))
    assert b.gradle_versions(files).count() == 0


def pom(body, ns="http://maven.apache.org/POM/4.0.0"):
    return f'<project xmlns="{ns}"><build><plugins>{body}</plugins></build></project>'


COMPILER = "<plugin><artifactId>maven-compiler-plugin</artifactId><configuration>{}</configuration></plugin>"


@pytest.mark.parametrize(
    "text, level",
    [
        (pom(COMPILER.format("<source>11</source><release> 17 </release>")), "17"),
        (pom(COMPILER.format("<source>11</source>")), "11"),
        (pom(COMPILER.format("<target>11</target>") + COMPILER.format("<source>8</source>")), "8"),
        (pom("<plugin><artifactId>maven-compiler-plugin</artifactId></plugin>"), None),
        (pom("<plugin><artifactId>other</artifactId><configuration><release>9</release></configuration></plugin>"), None),
        (pom(COMPILER.format("<release>17</release>"), ns="http://else"), None),
        (pom(COMPILER.format("<release/><source>8</source>")), None),
        ("<project><unclosed>", None),
        ('<?xml version="1.0" encoding="UTF-8"?>\n' + pom(COMPILER.format("<release>21</release>")), "21"),
        (None, None),
    ],
)
def test_compiler_level(text, level):
    assert b._compiler_level(text) == level


def test_maven_scope_and_versions(spark):
    level = pom(COMPILER.format("<release>17</release>"))
    files = repo_files(
        spark,
        ("pom.xml", level, "root"),
        ("sub/pom.xml", level, "root"),
        (".mvn/wrapper/maven-wrapper.properties", "distributionUrl=https://x/apache-maven-3.9.6-bin.zip", "root"),
        ("a/pom.xml", "<broken", "multi"),
        ("a/.mvn/jvm.config", "-Xmx1g --release 11", "multi"),
        ("b/c/pom.xml", level, "multi"),
        (".mvn/wrapper/maven-wrapper.properties", "distributionUrl=https://x/apache-maven-3.1-bin.zip", "multi"),
        (".mvn/jvm.config", "--release 9", "none"),
    )
    assert rows(b.maven_projects(files), "repo_id", "project_dir", *TOOL) == [
        ("multi", "a", "maven", "unspecified", "11"),
        ("multi", "b/c", "maven", "unspecified", "17"),
        ("root", "", "maven", "3.9.6", "17"),
    ]


@pytest.mark.parametrize(
    "entries, expected",
    [
        ([("go.mod", "module x\n\ngo 1.21\n")], ("Go Modules", "Unknown", "1.21")),
        ([("go.mod", "module x\r\ngo 1.21 \r\n")], ("Go Modules", "Unknown", "1.21")),
        ([("go.mod", "module x"), (".go-version", " 1.20\n")], ("Go Modules", "Unknown", "1.20")),
        ([("Gopkg.toml", ""), ("Gopkg.lock", 'a\nversion = "v1.2"\nversion = "v3"')], ("dep", "v1.2", "Unknown")),
        ([("glide.yaml", "package: x\n  version: 0.13\n")], ("glide", "0.13", "Unknown")),
        ([("vendor/vendor.json", "{}"), ("x.go", "")], ("govendor", "Unknown", "Unknown")),
        ([("cmd/x.go", "")], ("Go Modules", "Unknown", "Unknown")),
        ([("go.mod", None), ("Gopkg.toml", "")], ("Go Modules", "Unknown", "Unknown")),
    ],
)
def test_go(spark, entries, expected):
    assert rows(b.go_tools(repo_files(spark, *entries)), *TOOL) == [expected]


def test_go_needs_go_files(spark):
    assert b.go_tools(repo_files(spark, (".go-version", "1.2"), ("sub/go.mod", "go 1.1"), ("Gopkg.lock", ""))).count() == 0


@pytest.mark.parametrize(
    "entries, expected",
    [
        ([("package.json", '{"packageManager":"pnpm@8","engines":{"node":" >=18 "}}')], [("", "pnpm", "Unknown", ">=18")]),
        ([("package.json", '{"packageManager":"bun@1"}'), ("yarn.lock", "")], [("", "Yarn", "Unknown", "Unknown")]),
        ([("package.json", "{}"), ("pnpm-lock.yaml", ""), ("package-lock.json", "{}")], [("", "pnpm", "Unknown", "Unknown")]),
        ([("package.json", '{"dependencies":{"npm":"9"}}')], [("", "npm", "9", "Unknown")]),
        ([("package.json", '{"engines":{"node":18},"dependencies":{"npm":"9"}}')], [("", "npm", "Unknown", "Unknown")]),
        ([("package.json", '{"engines":{"node":"1"},"devDependencies":null}')], [("", "npm", "Unknown", "1")]),
        ([("package.json", '{"packageManager":"yarn","devDependencies":{"yarn":"1.2"}}')], [("", "Yarn", "1.2", "Unknown")]),
        ([("package.json", "{broken"), ("yarn.lock", "")], []),
        ([("package.json", '{"packageManager":null}')], []),
        ([("package.json", '{"packageManager":5}')], []),
        ([("package.json", '{"packageManager":{"name":"yarn"}}')], [("", "npm", "bundled", "Unknown")]),
        ([("package.json", "[1]")], [("", "npm", "Unknown", "Unknown")]),
        ([("package.json", "7")], []),
        ([("package.json", '{"engines":null}')], [("", "npm", "Unknown", "Unknown")]),
        ([("a/package.json", "{}"), ("b/yarn.lock", ""), ("a/b/package.json", "{}")],
         [("a", "npm", "bundled", "Unknown"), ("a/b", "npm", "bundled", "Unknown")]),
    ],
)
def test_js(spark, entries, expected):
    assert rows(b.js_tools(repo_files(spark, *entries)), "directory", *TOOL) == expected


@pytest.mark.parametrize(
    "entries, expected",
    [
        ([("poetry.lock", ""), ("pyproject.toml", '[tool.poetry]\npython = "^3.11"\n')], [("Poetry", None, "^3.11")]),
        ([("pyproject.toml", "[project]\n")], []),
        ([("sub/requirements.txt", "x")], [("pip", None, None)]),
        ([("sub/requirements.txt", "x"), ("hatch.toml", "")], [("Hatch", None, None)]),
        ([("Pipfile", 'python_version = "3.9"'), ("Pipfile.lock", '{"_meta":{"requires":{"pip_version":"23"}}}')],
         [("Pipenv", "23", "3.9")]),
        ([("Pipfile.lock", "{bad")], [("Pipenv", None, None)]),
        ([("setup.py", "setuptools>=61.0 python_requires = '>=3.8'"), ("setup.cfg", "")], [("Setuptools", "61.0", ">=3.8")]),
        ([("setup.cfg", ""), ("poetry.lock", 'poetry-version = "1.2"')], [("Poetry", "1.2", None), ("Setuptools", None, None)]),
        ([("sub/setup.py", "")], []),
    ],
)
def test_python(spark, entries, expected):
    assert rows(b.python_tools(repo_files(spark, *entries)), *TOOL) == expected


def test_project_kinds(spark):
    files = repo_files(
        spark,
        ("a/build.gradle.kts", "", "g"), ("bin/build.gradle", "", "x"), ("sub/pom.xml", "", "x"),
        ("pom.xml", "", "m"), ("gradle.lockfile", "", "m"),
    )
    assert rows(b.project_kinds(files)) == [("g", True, False, False), ("m", False, True, True), ("x", False, False, False)]


def test_gradle_rules_and_jdk_table_are_parameters(spark):
    from codeledger.sources.rules import gradle_rules_from_tree

    rules = gradle_rules_from_tree({"extraction_rules": [{"file": "build.gradle", "regex": r"ver=(\S+)", "priority": 1}]})
    files = repo_files(spark, ("build.gradle", "ver=9.1-x"), ("gradle.properties", "gradleVersion=4.2"))
    found = b.gradle_versions(files, rules, {"9": "25"})
    assert rows(found, "tool_version", "runtime_version") == [("9.1", "25")]
