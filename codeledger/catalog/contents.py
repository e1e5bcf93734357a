"""File-content jobs on the driver tables: pages and parts stand in for files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeledger import schemas
from codeledger.catalog.portfolio import text
from codeledger.catalog.registry import Tables, query
from codeledger.functions.scalars import without_qualifier
from codeledger.operators import build_tools as b
from codeledger.operators import sbom
from codeledger.operators.iac import iac_components, iac_matches, modernization_signals
from codeledger.plans.tables import build_tools_table, dependency_table
from codeledger.sources.rules import CategoryRule, IacRule, gradle_jdk_map


#: Tasks a core that work on files made of parts.
PART_TASKS = 4


def lit(value) -> Column:
    return F.lit(value)


def concat(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else lit(p) for p in parts])


def files(rows: DataFrame, repo: Column, *entries: tuple) -> DataFrame:
    """One ``repo_files`` row per (path, content[, condition]) and input row."""
    made = []
    for entry in entries:
        path, content, *when = [e if isinstance(e, Column) else lit(e) for e in entry]
        made.append(F.when(when[0] if when else lit(True), F.struct(path.alias("path"), content.alias("content"))))
    exploded = rows.select(repo.alias("repo_id"), F.explode(F.array_compact(F.array(*made))).alias("f"))
    return exploded.select(
        "repo_id", "f.path", F.octet_length("f.content").cast("bigint").alias("size"), "f.content"
    )


def dealt_parts(t: Tables) -> DataFrame:
    """Part rows dealt over all cores, for files that cost far more than the row they are made of.

    The splits of a scan don't tell: a file of few row groups is read by as few tasks.
    """
    return t.part.repartition(PART_TASKS * t.spark.sparkContext.defaultParallelism)


def part_no() -> Column:
    return F.col("p_partkey")


def part_size() -> Column:
    return F.col("p_size")


# --- Gradle -----------------------------------------------------------------

_JDK_VALUES = ", ".join(f"('{version}', '{jdk}')" for version, jdk in gradle_jdk_map().items())
_VERSION_SQL = """(p_size % 10) || '.' || (p_partkey % 15) || case p_partkey % 3 when 0 then '' else '.' ||
  (p_partkey % 4) end"""
_PREFIX_SQL = f"""with jdks(known, jdk) as (values {_JDK_VALUES}),
  v as (select p_partkey, ({_VERSION_SQL}) as version from part),
  hits as (select p_partkey, jdk from v join jdks on version = known or starts_with(version, known || '.')
           qualify row_number() over (partition by p_partkey order by length(known) desc) = 1)
  select p_partkey::varchar repo_id, version, coalesce(jdk, 'JDK version unknown') jdk
  from v left join hits using (p_partkey)"""


def _versions(t: Tables) -> DataFrame:
    tail = F.when(part_no() % 3 == 0, "").otherwise(concat(".", (part_no() % 4).cast("string")))
    version = concat((part_size() % 10).cast("string"), ".", (part_no() % 15).cast("string"), tail, "-rc-1")
    return t.part.select(text("p_partkey").alias("repo_id"), without_qualifier(version).alias("version"))


@query("q_prefix_lookup", _PREFIX_SQL)
def q_prefix_lookup(t: Tables) -> DataFrame:
    return _versions(t).withColumn("jdk", b.jdk_for_gradle(F.col("version")))


@query("q_prefix_lookup_join", _PREFIX_SQL)
def q_prefix_lookup_join(t: Tables) -> DataFrame:
    table = t.spark.createDataFrame(list(gradle_jdk_map().items()), "version string, jdk string")
    return b.jdk_lookup(_versions(t), table).select("repo_id", "version", "jdk")


@query(
    "q_priority_first_match",
    f"""with jdks(known, jdk) as (values {_JDK_VALUES}),
        f as (select page_id // 4 repo, page_id % 4 kind, page_id,
                case page_id % 4
                  when 0 then case when page_id % 12 = 0 then null else '6.' || (page_id % 9) end
                  when 1 then case when page_id % 3 = 0 then '7.' || (page_id % 7) || '.1' end
                  when 3 then case when page_id % 5 = 0 then '8.' || (page_id % 13) end end as version,
                case page_id % 4 when 1 then 0 else 1 end wrapper_rank,
                case page_id % 4 when 0 then 'build.gradle' when 1 then 'gradle/wrapper'
                  when 2 then 'build/build.gradle' else 'sub/settings.gradle.kts' end path
              from pages),
        c as (select * from f where kind <> 2),
        best as (select repo, version from c where version is not null
                 qualify row_number() over (partition by repo order by wrapper_rank, path) = 1),
        r as (select distinct repo, best.version from c left join best using (repo)),
        j as (select repo, jdk from r join jdks on version = known or starts_with(version, known || '.')
              qualify row_number() over (partition by repo order by length(known) desc) = 1)
        select repo::varchar repo_id, 'gradle' tool, version tool_version,
               case when version is not null then coalesce(jdk, 'JDK version unknown') end runtime_version,
               case when version is null then 'Gradle version detection failed' end error
        from r left join j using (repo)""",
)
def q_priority_first_match(t: Tables) -> DataFrame:
    page = F.col("page_id")
    num = lambda n: (page % n).cast("string")
    html = F.col("html")
    rows = files(
        t.pages,
        F.floor(page / 4).cast("string"),
        (
            "build.gradle",
            F.when(page % 12 == 0, html).otherwise(concat(html, "\ngradleVersion = '6.", num(9), "'\n")),
            page % 4 == 0,
        ),
        (
            "gradle/wrapper/gradle-wrapper.properties",
            F.when(
                page % 3 == 0, concat("a=b\ndistributionUrl=https\\://x/gradle-7.", num(7), ".1-rc1-bin.zip\n")
            ).otherwise("distributionUrl=https\\://x/gradle-current.zip"),
            page % 4 == 1,
        ),
        ("build/build.gradle", "gradleVersion = '9.9'", page % 4 == 2),
        (
            "sub/settings.gradle.kts",
            F.when(page % 5 == 0, concat('gradleVersion = "8.', num(13), '"')).otherwise("gradleVersion = 8"),
            page % 4 == 3,
        ),
    )
    return b.gradle_versions(rows)


_SLUG_SQL = "replace(p_name, ' ', '-')"


def slug() -> Column:
    return F.replace("p_name", lit(" "), lit("-"))


def _gradle_files(t: Tables) -> DataFrame:
    group = F.replace("p_brand", lit("#"), lit("."))
    size = part_size().cast("string")
    build = concat(
        "plugins { id 'java' }\nallprojects {\n  dependencies_of 'none'\n  api 'shared:",
        slug(),
        ":1'\n}\ndependencies {\n  implementation '",
        group, ":", slug(), ":", size,
        "'\n  testImplementation(\"", group, ":", slug(), "\")\n  runtimeOnly 'a.b:c.d:", size,
        ":extra'\n  compile { group: 'm.", group, "', name: '", slug(), "', version: '", size,
        "' }\n  compileOnly {\n group : \"n\" , name : \"", slug(), "\" }\n  kapt 'not:counted:1'\n}\n",
    )
    return files(dealt_parts(t), text("p_partkey"), ("build.gradle", build))


_GRADLE_DEPS_SQL = f"""
  with p as (select p_partkey::varchar repo_id, replace(p_brand, '#', '.') g, {_SLUG_SQL} n, p_size::varchar s
             from part)
  select repo_id, 0 pos, 'shared' "group", n artifact, '1' as version from p
  union all select repo_id, 1, 'shared', n, '1' from p
  union all select repo_id, 2, g, n, s from p
  union all select repo_id, 3, g, n, 'unknown' from p
  union all select repo_id, 4, 'a.b:c.d', s, 'extra' from p
  union all select repo_id, 5, 'm.' || g, n, s from p
  union all select repo_id, 6, 'n', n, 'unknown' from p"""


@query("q_gradle_deps", _GRADLE_DEPS_SQL)
def q_gradle_deps(t: Tables) -> DataFrame:
    return sbom.gradle_dependencies(_gradle_files(t)).drop("path")


@query(
    "q_gradle_artifacts",
    f"""select repo_id, 'java-archive' type, artifact as name, nullif(version, 'unknown') as version,
               'pkg:maven/' || "group" || '/' || artifact || case version when 'unknown' then ''
                 else '@' || version end purl,
               'pkg:gradle/' || "group" || '/' || artifact place from ({_GRADLE_DEPS_SQL})""",
)
def q_gradle_artifacts(t: Tables) -> DataFrame:
    a = sbom.gradle_artifacts(sbom.gradle_dependencies(_gradle_files(t)))
    return a.select(
        "repo_id", "a.type", "a.name", "a.version", "a.purl", F.col("a.locations")[0]["path"].alias("place")
    )


def _module_files(t: Tables) -> DataFrame:
    """Repository = brand; one module folder per part, some locked, some nested or excluded."""
    key = text("p_partkey")
    root = concat("m", key)
    dep = concat("implementation 'g:", slug(), ":", part_size().cast("string"), "'")
    settings = concat("include ':lib:core', ':other'\ninclude 'gone.", key, "'\n")
    return files(
        dealt_parts(t),
        F.col("p_brand"),
        (concat(root, "/build.gradle"), dep),
        (concat(root, "/gradle.lockfile"), "", part_size() % 3 == 0),
        (concat(root, "/settings.gradle"), settings, part_size() % 2 == 0),
        (concat(root, "/lib/core/extra.gradle"), concat("api 'core:c", key, ":1'")),
        (concat(root, "/lib/core/src/Main.java"), "class Main {}"),
        (concat(root, "/out/build.gradle"), concat("api 'never:n", key, ":1'"), part_size() % 5 == 0),
        (concat(root, "/gradle/libs.versions.toml"), concat("api 'toml:t", key, ":1'"), part_size() % 7 == 0),
    )


@query(
    "q_gradle_modules",
    """select p_brand repo_id, 'm' || p_partkey root, 'm' || p_partkey || '/lib/core' dir from part
       where p_size % 2 = 0""",
)
def q_gradle_modules(t: Tables) -> DataFrame:
    return sbom.included_modules(_module_files(t))


@query(
    "q_unlocked_modules",
    """select p_brand repo_id, 'm' || p_partkey dir from part where p_size % 3 <> 0
       union all select p_brand, 'm' || p_partkey || '/out' from part where p_size % 5 = 0""",
)
def q_unlocked_modules(t: Tables) -> DataFrame:
    return sbom.unlocked_modules(_module_files(t))


@query(
    "q_gradle_build_files",
    f"""select p_brand repo_id, 'm' || p_partkey || '/build.gradle' path,
               'g/' || {_SLUG_SQL} || '/' || p_size "declared" from part where p_size % 3 <> 0
        union all select p_brand, 'm' || p_partkey || '/settings.gradle', '' from part
        where p_size % 3 <> 0 and p_size % 2 = 0
        union all select p_brand, 'm' || p_partkey || '/lib/core/extra.gradle', 'core/c' || p_partkey || '/1'
        from part where p_size % 3 <> 0 and p_size % 2 = 0
        union all select p_brand, 'm' || p_partkey || '/gradle/libs.versions.toml', 'toml/t' || p_partkey || '/1'
        from part where p_size % 3 <> 0 and p_size % 7 = 0""",
)
def q_gradle_build_files(t: Tables) -> DataFrame:
    found = sbom.gradle_build_files(_module_files(t))
    shown = F.transform("deps", lambda d: F.concat_ws("/", d["group"], d["artifact"], d["version"]))
    return found.select("repo_id", "path", F.array_join(shown, ";").alias("declared"))


# --- SBOM merge -------------------------------------------------------------


@query(
    "q_sbom_merge",
    """with base as (
         select p_brand repo_id, 0 source_ord, '' path, p_partkey pos, p_name as name, p_size::varchar as version,
                case when p_size % 2 = 0 then 'pkg:maven/' || p_brand || '/' || p_name || '@' || p_size else '' end purl
         from part),
       module as (
         select p_brand repo_id, 1 source_ord, l_orderkey || '/' || l_linenumber || '/' || l_quantity || '/'
                  || l_shipdate::date path, l_partkey pos, upper(p_name) as name, l_linenumber::varchar as version,
                case when l_linenumber < 4 then 'pkg:maven/' || p_brand || '/' || p_name || '@' || (l_linenumber * 2)
                end purl
         from lineitem join part on l_partkey = p_partkey),
       u as (select *, coalesce(nullif(purl, ''), name || '@' || version) k
             from (select * from base union all select * from module)),
       kept as (select * from u qualify row_number() over
                (partition by repo_id, k order by source_ord, path, pos) = 1)
       select repo_id, name, version, coalesce(purl, '-') purl, lower(name) name_key, source_ord, path, pos
       from kept""",
)
def q_sbom_merge(t: Tables) -> DataFrame:
    def artifact(name: Column, version: Column, purl: Column) -> Column:
        none = lit(None)
        a = F.struct(
            name.alias("name"), version.alias("version"), none.alias("type"), none.alias("language"),
            purl.alias("purl"), none.alias("licenses"), none.alias("locations"), none.alias("metadata"),
        )
        return a.cast(schemas.ARTIFACT).alias("a")

    even = concat("pkg:maven/", F.col("p_brand"), "/", F.col("p_name"), "@", text("p_size"))
    base = t.part.select(
        F.col("p_brand").alias("repo_id"),
        part_no().alias("pos"),
        artifact(F.col("p_name"), text("p_size"), F.when(part_size() % 2 == 0, even).otherwise("")),
    )
    line = F.col("l_linenumber")
    url = concat("pkg:maven/", F.col("p_brand"), "/", F.col("p_name"), "@", (line * 2).cast("string"))
    rows = t.lineitem.join(t.part, F.col("l_partkey") == part_no())
    module = rows.select(
        F.col("p_brand").alias("repo_id"),
        F.concat_ws(
            "/", "l_orderkey", "l_linenumber", "l_quantity", F.date_format("l_shipdate", "yyyy-MM-dd")
        ).alias("path"),
        F.col("l_partkey").alias("pos"),
        artifact(F.upper("p_name"), line.cast("string"), F.when(line < 4, url)),
    )
    merged = sbom.sorted_artifacts(sbom.merge_artifacts(base, module))
    url = F.coalesce("a.purl", lit("-")).alias("purl")
    return merged.select("repo_id", "a.name", "a.version", url, *sbom.MERGED_ORDER)


# --- Maven, Go, JavaScript, Python ------------------------------------------


def _pom(level: Column) -> Column:
    return concat(
        '<?xml version="1.0"?><project xmlns="http://maven.apache.org/POM/4.0.0"><build><plugins>'
        "<plugin><artifactId>other</artifactId><configuration><release>1</release></configuration></plugin>"
        "<plugin><artifactId>maven-compiler-plugin</artifactId></plugin>"
        "<plugin><artifactId>maven-compiler-plugin</artifactId><configuration>",
        level,
        "</configuration></plugin></plugins></build></project>",
    )


@query(
    "q_maven",
    """with p as (select *, case when p_size % 2 = 0 then '' else 'mod' || p_partkey end dir from part),
       lev as (select p_brand || '/' || (p_partkey // 3) repo_id, dir, p_size,
                 case p_partkey % 5 when 0 then p_size::varchar when 1 then 's' || p_size
                   when 2 then null when 3 then null else null end pom,
                 case when p_partkey % 3 = 0 then p_size::varchar end release,
                 case when p_partkey % 7 < 4 then '3.' || (p_partkey % 9) || '.1' end maven from p),
       g as (select repo_id, dir, max(pom) pom, max(release) release, max(maven) maven from lev group by all)
       select repo_id, dir project_dir, 'maven' tool, coalesce(maven, 'unspecified') tool_version,
              coalesce(pom, release, 'unspecified') runtime_version
       from g where dir = '' or repo_id not in (select repo_id from g where dir = '')""",
)
def q_maven(t: Tables) -> DataFrame:
    size = part_size().cast("string")
    folder = F.when(part_size() % 2 == 0, "").otherwise(concat("mod", text("p_partkey"), "/"))
    both = concat("<source>old</source><release> ", size, " </release>")
    pom = (
        F.when(part_no() % 5 == 0, _pom(both))
        .when(part_no() % 5 == 1, _pom(concat("<source>s", size, "</source>")))
        .when(part_no() % 5 == 2, concat("<project><unclosed>", size))
        .when(part_no() % 5 == 3, F.replace(_pom(both), lit("POM/4.0.0"), lit("POM/0")))
        .otherwise(_pom(lit("<target>9</target>")))
    )
    wrapper = concat(
        "# distributionUrl=apache-maven-0.0-bin\ndistributionUrl=https://x/apache-maven-3.",
        (part_no() % 9).cast("string"),
        ".1-bin.zip\n",
    )
    rows = files(
        dealt_parts(t),
        concat(F.col("p_brand"), "/", F.floor(part_no() / 3).cast("string")),
        (concat(folder, "pom.xml"), pom),
        (concat(folder, ".mvn/wrapper/maven-wrapper.properties"), wrapper, part_no() % 7 < 4),
        (concat(folder, ".mvn/jvm.config"), concat("-Xmx1g --release  ", size), part_no() % 3 == 0),
    )
    return b.maven_projects(rows)


@query(
    "q_go",
    """select p_partkey::varchar repo_id,
         case p_size % 6 when 0 then 'Go Modules' when 1 then 'dep' when 2 then 'glide' when 3 then 'govendor'
           when 4 then 'Go Modules' end tool,
         case p_size % 6 when 1 then 'v' || p_partkey when 2 then p_partkey::varchar else 'Unknown' end tool_version,
         case when p_size % 6 = 0 then '1.' || p_size when p_partkey % 2 = 0 then '1.1.' || p_partkey
           else 'Unknown' end runtime_version
       from part where p_size % 6 <> 5""",
)
def q_go(t: Tables) -> DataFrame:
    kind, key = part_size() % 6, text("p_partkey")
    rows = files(
        dealt_parts(t),
        key,
        ("go.mod", concat("module x\n\ngo  1.", part_size().cast("string"), "\r\n\nrequire y v1\n"), kind == 0),
        ("Gopkg.toml", "", kind.isin(0, 1)),
        ("Gopkg.lock", concat("[[projects]]\n  version = \"no\"\nversion = \"v", key, "\"\n"), kind == 1),
        ("glide.yaml", concat("package: x\n  version: ", key, "\nversion: later\n"), kind == 2),
        ("vendor/vendor.json", "{}", kind == 3),
        ("cmd/main.go", "package main", kind == 4),
        (".go-version", concat(" 1.1.", key, "\n"), part_no() % 2 == 0),
    )
    return b.go_tools(rows)


@query(
    "q_js",
    """with d as (
         select p_brand repo_id, 'web/d' || p_partkey directory, p_partkey, p_size,
           case when p_size % 5 = 0 then 'Yarn' when p_size % 5 = 1 then 'pnpm' when p_size % 5 = 2 then 'npm'
                when p_partkey % 4 = 0 then 'Yarn' when p_partkey % 4 = 1 then 'pnpm' else 'npm' end tool
         from part where p_partkey % 11 <> 0)
       select repo_id, directory, tool,
         case when p_partkey % 13 = 1 then 'Unknown'
              when tool = 'npm' then case when p_size % 3 = 0 then '9.' || p_size else 'bundled' end
              when tool = 'Yarn' then case when p_size % 3 = 0 then '1.' || p_size else 'Unknown' end
              else 'Unknown' end tool_version,
         case when p_partkey % 13 = 1 then 'Unknown' else '>=' || p_size end runtime_version from d""",
)
def q_js(t: Tables) -> DataFrame:
    key, size = text("p_partkey"), part_size().cast("string")
    folder = concat("web/d", key, "/")
    manager = (
        F.when(part_size() % 5 == 0, '"packageManager": "yarn@3",')
        .when(part_size() % 5 == 1, '"packageManager": "pnpm@8",')
        .when(part_size() % 5 == 2, '"packageManager": "npm@9",')
        .otherwise("")
    )
    engines = F.when(part_no() % 13 == 1, '{"node": 18}').otherwise(concat('{"node": "  >=', size, ' "}'))
    deps = F.when(
        part_size() % 3 == 0,
        concat('"dependencies": {"npm": "9.', size, '"}, "devDependencies": {"yarn": "1.', size, '"},'),
    ).otherwise("")
    package = F.when(part_no() % 11 == 0, "{broken").otherwise(
        concat("{", manager, deps, '"engines": ', engines, ', "name": "x"}')
    )
    rows = files(
        dealt_parts(t),
        F.col("p_brand"),
        (concat(folder, "package.json"), package),
        (concat(folder, "yarn.lock"), "", part_no() % 4 == 0),
        (concat(folder, "pnpm-lock.yaml"), "", part_no() % 4 == 1),
        (concat(folder, "package-lock.json"), "{}", part_no() % 4 == 2),
        (concat("locks/l", key, "/yarn.lock"), ""),
    )
    return b.js_tools(rows)


@query(
    "q_python_tools",
    """with p as (select p_partkey::varchar repo_id, p_size s, p_partkey k from part)
       select repo_id, 'Poetry' tool, case when s % 2 = 0 then '1.' || s end tool_version,
              case when k % 2 = 0 then '^3.' || s end runtime_version from p where s % 2 = 0 or (k % 2 = 0 and s % 3 = 0)
       union all select repo_id, 'Pipenv', case when k % 3 = 0 then '2' || s end, case when k % 5 = 0 then '3.' || s end
       from p where k % 3 = 0 or k % 5 = 0
       union all select repo_id, 'Setuptools', '4.' || s, '>=3.' || s from p where k % 7 = 0
       union all select repo_id, 'Setuptools', null, null from p where k % 7 = 1
       union all select repo_id, 'Hatch', null, null from p where k % 9 = 0
       union all select repo_id, 'pip', null, null from p
       where k % 4 = 1 and not (s % 2 = 0 or (k % 2 = 0 and s % 3 = 0) or k % 3 = 0 or k % 5 = 0
                                or k % 7 in (0, 1) or k % 9 = 0)""",
)
def q_python_tools(t: Tables) -> DataFrame:
    size = part_size().cast("string")
    section = F.when(part_size() % 3 == 0, "[tool.poetry]\n").otherwise("[project]\n")
    setup = concat("setup(setup_requires=['setuptools>=4.", size, "'], python_requires='>=3.", size, "')")
    rows = files(
        dealt_parts(t),
        text("p_partkey"),
        ("poetry.lock", concat('poetry-version = "1.', size, '"'), part_size() % 2 == 0),
        ("pyproject.toml", concat(section, 'python = "^3.', size, '"\n'), part_no() % 2 == 0),
        ("Pipfile.lock", concat('{"_meta": {"requires": {"pip_version": "2', size, '"}}}'), part_no() % 3 == 0),
        ("Pipfile", concat('python_version = "3.', size, '"'), part_no() % 5 == 0),
        ("setup.py", setup, part_no() % 7 == 0),
        ("setup.cfg", "", part_no() % 7 == 1),
        ("hatch.toml", "", part_no() % 9 == 0),
        ("sub/requirements.txt", "numpy\n", part_no() % 4 == 1),
        ("sub/setup.py", "python_requires='no'"),
    )
    return b.python_tools(rows)


@query(
    "q_project_kind",
    """select p_brand || '/' || (p_partkey // 4) repo_id, bool_or(p_size % 4 = 0) is_gradle,
              bool_or(p_size % 3 = 0) is_maven, bool_or(p_size % 5 = 0) is_locked from part group by all""",
)
def q_project_kind(t: Tables) -> DataFrame:
    key = text("p_partkey")
    rows = files(
        dealt_parts(t),
        concat(F.col("p_brand"), "/", F.floor(part_no() / 4).cast("string")),
        (concat("a/", key, "/build.gradle.kts"), "", part_size() % 4 == 0),
        (concat("bin/", key, "/build.gradle"), "", part_size() % 4 == 1),
        ("pom.xml", "", part_size() % 3 == 0),
        (concat(key, "/pom.xml"), ""),
        ("gradle.lockfile", "", part_size() % 5 == 0),
    )
    return b.project_kinds(rows)


# --- infrastructure ---------------------------------------------------------

IAC_RULES = [
    IacRule(0, "Infrastructure Platform", "Queries", "Tracked", (r"utm_source=\w+$", r"\?page=\d"), (r'<html lang="en">',)),
    IacRule(1, "Container Platform", "Pages", "Dockerfile", (r"^\d+\.html$",), ()),
    IacRule(2, "Developer Platform and CI/CD", "Anchors", "Anchored", ("#top$",), (r"^<!doctype\s+HTML>", "no such text")),
    IacRule(3, "Developer Platform and CI/CD", "Numbers", "Threes", ("^3",), ("CLASS=.AD.", r"\{\s*margin")),
    IacRule(4, "Other", "Case", "Never", (r"\.HTML$",), ()),
    IacRule(5, "Other", "Braces", "Styled", ("1",), ("p{margin:0}",)),
]
_IAC_SQL = """
  with f as (select page_id, 'repo-' || (page_id % 20) repo_id, split_part(url, '/', -1) as name, html from pages),
  m as (
    select page_id, repo_id, 'Infrastructure Platform' category, 'Queries' subcategory, 'Tracked' framework from f
    where regexp_matches(name, 'utm_source=\\w+$|\\?page=\\d') and contains(lower(html), '<html lang="en">')
    union all select page_id, repo_id, 'Container Platform', 'Pages', 'Dockerfile' from f
    where regexp_matches(name, '^\\d+\\.html$')
    union all select page_id, repo_id, 'Developer Platform and CI/CD', 'Anchors', 'Anchored' from f
    where name like '%#top' and (regexp_matches(html, '^<!doctype\\s+html>', 'im') or contains(lower(html), 'no such text'))
    union all select page_id, repo_id, 'Developer Platform and CI/CD', 'Numbers', 'Threes' from f
    where name like '3%' and (regexp_matches(html, 'class=.ad.', 'i') or regexp_matches(html, '\\{\\s*margin', 'i'))
    union all select page_id, repo_id, 'Other', 'Braces', 'Styled' from f
    where contains(name, '1') and contains(lower(html), 'p{margin:0}'))"""


def _page_files(t: Tables) -> DataFrame:
    path = concat(text("page_id"), "/", F.substring_index("url", "/", -1))
    return files(t.wide("pages"), concat("repo-", (F.col("page_id") % 20).cast("string")), (path, F.col("html")))


@query(
    "q_iac_theta",
    f"{_IAC_SQL} select page_id, repo_id, category, subcategory, framework from m",
)
def q_iac_theta(t: Tables) -> DataFrame:
    hits = iac_matches(_page_files(t), IAC_RULES)
    page = F.substring_index("path", "/", 1).cast("bigint").alias("page_id")
    return hits.select(page, "repo_id", "category", "subcategory", "framework")


@query(
    "q_iac_signals",
    f"""{_IAC_SQL} select repo_id, bool_or(framework in ('Dockerfile', 'docker-compose')) dockerfile,
          bool_or(category = 'Developer Platform and CI/CD') cicd_pipeline,
          bool_or(category in ('Infrastructure Platform', 'Container Platform')) iac_config
        from m group by repo_id""",
)
def q_iac_signals(t: Tables) -> DataFrame:
    repo = concat("repo-", (F.col("page_id") % 20).cast("string"))
    repos = t.pages.select(repo.alias("repo_id"), repo.alias("repo_slug"), repo.alias("repo_name")).distinct()
    return modernization_signals(iac_components(_page_files(t), repos, IAC_RULES, "2024-01-01 00:00:00"))


@query(
    "q_signals",
    """select user_id::varchar repo_id, bool_or(event_type = 'click' and value < 5) dockerfile,
              bool_or(event_type = 'error' and value < 5) cicd_pipeline,
              bool_or(event_type = 'view' and value < 5) iac_config from events group by user_id""",
)
def q_signals(t: Tables) -> DataFrame:
    kind, small = F.col("event_type"), F.col("value") < 5
    framework = F.when((kind == "click") & small, "docker-compose").otherwise(kind)
    category = F.when((kind == "error") & small, "Developer Platform and CI/CD").when(
        (kind == "view") & small, "Container Platform"
    )
    rows = t.events.select(
        text("user_id").alias("repo_id"), framework.alias("framework"), category.alias("category")
    )
    return modernization_signals(rows)



# --- whole tables -----------------------------------------------------------


@query(
    "q_build_tools_table",
    f"""with jdks(known, jdk) as (values {_JDK_VALUES})
        select p_partkey::varchar repo_id, 'gradle' tool, '7.' || (p_size % 6) tool_version, jdk runtime_version
        from part join jdks on known = '7.' || (p_size % 6) where p_partkey % 6 = 0
        union all select p_partkey::varchar, 'maven', 'unspecified', p_size::varchar from part where p_partkey % 6 = 0
        union all select p_partkey::varchar, 'Go Modules', 'Unknown', '1.' || p_size from part where p_partkey % 6 = 1
        union all select p_partkey::varchar, 'npm', 'bundled', 'Unknown' from part where p_partkey % 6 = 2
        union all select p_partkey::varchar, 'Hatch', null, null from part where p_partkey % 6 = 3""",
)
def q_build_tools_table(t: Tables) -> DataFrame:
    key, size = text("p_partkey"), part_size().cast("string")
    rows = files(
        dealt_parts(t),
        key,
        ("gradle.properties", concat("gradleVersion = 7.", (part_size() % 6).cast("string"))),
        ("pom.xml", _pom(concat("<release>", size, "</release>"))),
        ("go.mod", concat("module x\ngo 1.", size, "\n")),
        ("web/package.json", "{}"),
        ("hatch.toml", ""),
        ("docs/readme.md", F.col("p_name")),
    )
    kind = part_no() % 6
    spoken = (
        F.when(kind == 0, " JAVA")
        .when(kind == 1, "Go")
        .when(kind == 2, "TypeScript")
        .when(kind == 3, "jupyter notebook")
        .when(kind == 4, "go")
        .otherwise("C")
    )
    languages = t.part.select(key.alias("repo_id"), spoken.alias("main_language"))
    return build_tools_table(rows, languages)


@query(
    "q_dependency_table",
    f"""with p as (select p_partkey::varchar repo_id, {_SLUG_SQL} n, p_size s from part)
        select repo_id, n package_name, s::varchar as version, 'java-archive' package_type, '/base' locations,
               case when n like '%-plate' then 'Plates' else 'Other' end category from p where s % 2 = 0
        union all select repo_id, 'other', '1', 'python', '', 'Any' from p where s % 2 = 1
        union all select repo_id, 'g:' || n, s::varchar, 'java-archive', 'pkg:gradle/g/' || n,
               case when n like '%-plate' then 'Plates' else 'Other' end from p where s % 2 = 1 and s % 3 <> 0
        union all select repo_id, 'x:y', 'Unknown', 'java-archive', 'pkg:gradle/x/y', 'Other' from p where s % 3 <> 0""",
)
def q_dependency_table(t: Tables) -> DataFrame:
    key, size = text("p_partkey"), part_size().cast("string")
    declared = concat("api 'g:", slug(), ":", size, "'\napi('x:y')\n")
    build = files(
        dealt_parts(t),
        key,
        ("build.gradle", declared),
        ("gradle.lockfile", "", part_size() % 3 == 0),
    )
    java = F.struct(
        slug().alias("name"),
        size.alias("version"),
        lit("java-archive").alias("type"),
        concat("pkg:maven/g/", slug(), "@", size).alias("purl"),
        F.array(F.struct(lit("/base").alias("path"))).alias("locations"),
    )
    other = F.struct(
        lit("other").alias("name"),
        lit("1").alias("version"),
        lit("python").alias("type"),
        lit(None).cast("string").alias("purl"),
        F.array().cast("array<struct<path: string>>").alias("locations"),
    )
    artifacts = F.array(F.when(part_size() % 2 == 0, java).otherwise(other))
    reports = t.part.select(key.alias("repo_id"), F.to_json(F.struct(artifacts.alias("artifacts"))).alias("body"))
    rules = [
        CategoryRule("java-archive", 0, "-plate$", "Plates", "", ""),
        CategoryRule("python", 0, ".*", "Any", "", ""),
    ]
    return dependency_table(reports, build, rules).select(
        "repo_id", "package_name", "version", "package_type", "locations", "category"
    )
