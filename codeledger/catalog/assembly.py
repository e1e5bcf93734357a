"""Vulnerabilities, dependency sections and whole profiles on the driver tables.

Roles: supplier is the inventory; lineitem rows stand for the commits, files,
dependencies, findings and vulnerabilities of their supplier.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeledger.catalog.portfolio import text
from codeledger.catalog.registry import Tables, query
from codeledger.operators import history
from codeledger.operators import vulnerabilities as v
from codeledger.operators.dependencies import (
    categorize_dependencies,
    distinct_names,
    infer_build_tool,
)
from codeledger.operators.lists import list_parts, section_counts
from codeledger.plans import profile as p
from codeledger.session import checkpointed
from codeledger.sources.rules import CategoryRule

AS_OF = "2001-12-01 06:00:00"


def repo() -> Column:
    return text("l_suppkey").alias("repo_id")


# --- the profile's tables ---------------------------------------------------

RULES = [
    CategoryRule("python", 0, r".*lib-1\d$", "Teens", "Tens", "TeenKit"),
    CategoryRule("npm", 0, "lib-[0-9]$", "Digits", "Ones", " OneJS "),
    CategoryRule("java-archive", 0, "LIB-2.*", "Twenties", "Twos", "TwoJ"),
    CategoryRule("java-archive", 1, ".*wrapper.*", "Wrappers", "Build", ""),
]


def _package() -> Column:
    wrapped = (F.col("l_partkey") % 40 == 38) & (F.col("l_suppkey") % 5 == 0)
    return F.when(wrapped, "gradle-wrapper").otherwise(
        F.concat(F.lit("lib-"), (F.col("l_partkey") % 40).cast("string"))
    )


def _kind() -> Column:
    m = F.col("l_partkey") % 4
    return F.when(m == 0, "python").when(m == 1, "npm").when(m == 2, "java-archive").otherwise("gem")


def _severity(critical: str) -> Column:
    flag = F.col("l_returnflag")
    return F.when(flag == "A", critical).when(flag == "N", "High").otherwise("Low")


def dependencies(t: Tables) -> DataFrame:
    pom = (F.col("l_partkey") % 8 == 2) & (F.col("l_suppkey") % 3 == 0)
    rows = t.lineitem.select(
        repo(),
        _package().alias("package_name"),
        text("l_linenumber").alias("version"),
        _kind().alias("package_type"),
        F.lit("MIT").alias("licenses"),
        F.when(pom, "/app/pom.xml").otherwise("/lock").alias("locations"),
        F.lit("any").alias("language"),
    ).distinct()
    return categorize_dependencies(rows, RULES)


def grype(t: Tables) -> DataFrame:
    return t.lineitem.where(F.col("l_linestatus") == "F").select(
        repo(),
        _package().alias("package"),
        text("l_linenumber").alias("version"),
        _severity("Critical").alias("severity"),
        F.concat(F.lit("f"), text("l_linenumber")).alias("fix_versions"),
    )


def trivy(t: Tables) -> DataFrame:
    return t.lineitem.where(F.col("l_linestatus") == "O").select(
        repo(),
        F.when(F.col("l_partkey") % 10 != 0, _package()).alias("pkg_name"),
        text("l_linenumber").alias("installed_version"),
        _severity("CRITICAL").alias("severity"),
        F.concat(F.lit("t"), text("l_linenumber")).alias("fixed_version"),
    )


def commits(t: Tables) -> DataFrame:
    return t.lineitem.select(
        repo(),
        F.concat("l_returnflag", text("l_linenumber")).alias("author_email"),
        F.col("l_shipdate").cast("timestamp").alias("committed_at"),
    )


def metrics(t: Tables) -> DataFrame:
    folder = F.when(F.col("l_returnflag") == "R", ".git/objects/").otherwise("src/")
    files = t.lineitem.select(
        repo(),
        F.concat(folder, text("l_orderkey")).alias("path"),
        (F.col("l_quantity") * 12345).cast("bigint").alias("size"),
    )
    branches = t.lineitem.where(F.col("l_quantity") == 1).select(repo(), F.col("l_linestatus").alias("ref"))
    return history.repo_metrics(commits(t), files, branches, AS_OF)


def profile_tables(t: Tables) -> p.ProfileTables:
    line = t.lineitem
    number, quantity = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    suppliers = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    inventory = suppliers.where(F.col("n_regionkey") != 4).select(
        text("s_suppkey").alias("repo_id"),
        F.col("s_name").alias("repo_name"),
        F.when(F.col("s_acctbal") > 0, "SUCCESS").otherwise("").alias("status"),
        F.col("n_name").alias("host_name"),
        F.lit(None).cast("string").alias("app_id"),
        F.concat(F.lit("tc-"), text("n_regionkey")).alias("tc"),
        F.to_timestamp(F.lit("2001-11-30 01:02:03.250000")).alias("updated_on"),
        F.concat(F.lit("git@github.com:o/"), text("s_suppkey")).alias("clone_url_ssh"),
        F.concat(F.lit("https://github.com/o/"), text("s_suppkey")).alias("browse_url"),
    )
    lizard = line.groupBy(repo()).agg(
        F.sum(quantity).alias("total_nloc"),
        F.avg(number).alias("avg_ccn"),
        F.sum("l_partkey").alias("total_token_count"),
        F.count(F.lit(1)).alias("function_count"),
        F.sum(number).alias("total_ccn"),
    )
    quantities = line.groupBy(repo(), F.concat(F.lit("lang"), text("l_linenumber")).alias("language")).agg(
        F.sum("l_quantity").alias("q")
    )
    totals = quantities.groupBy("repo_id").agg(F.sum("q").alias("total"))
    languages = quantities.join(totals, "repo_id").select(
        "repo_id", "language", (F.col("q") * 100 / F.col("total")).alias("percent_usage")
    )
    cloc = line.select(
        repo(),
        F.concat(F.lit("lang"), text("l_linenumber")).alias("language"),
        quantity.alias("code"),
        number.alias("blank"),
        F.lit(1).alias("comment"),
    )
    tools = line.select(
        repo(),
        F.when(number == 1, "gradle").when(number == 2, "Yarn").otherwise("Go Modules").alias("tool"),
        F.lit("1").alias("tool_version"),
        F.when(F.col("l_returnflag") == "A", "17").when(F.col("l_returnflag") == "N", "21").alias("runtime_version"),
    ).distinct()
    eol = line.select(
        repo(),
        _package().alias("artifact_name"),
        text("l_linenumber").alias("artifact_version"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("eol_date"),
        F.lit("99").alias("latest_release"),
    )
    findings = line.select(
        repo(),
        F.concat(F.lit("src/"), text("l_orderkey")).alias("path"),
        F.col("l_returnflag").alias("rule_id"),
        F.col("l_linestatus").alias("severity"),
        F.lit("security").alias("category"),
        F.lit("").alias("subcategory"),
        F.lit("LOW").alias("likelihood"),
        F.lit("HIGH").alias("impact"),
        text("l_linenumber").alias("confidence"),
    )
    framework = F.when(number == 1, "Dockerfile").when(number == 2, "Terraform").when(number == 3, "")
    ci, platform = (number == 4) & (quantity == 7), (number == 2) & (quantity == 9)
    category = F.when(ci, "Developer Platform and CI/CD").when(platform, "Infrastructure Platform")
    iac = line.select(
        repo(),
        F.when((number == 1) & (quantity > 3), "Helm").otherwise(framework.otherwise("Helm")).alias("framework"),
        category.otherwise("Other").alias("category"),
    )
    return p.ProfileTables(
        inventory=inventory,
        repo_metrics=metrics(t),
        lizard_summary=lizard,
        languages=languages,
        cloc_metrics=cloc,
        syft_dependencies=dependencies(t),
        build_tools=tools,
        grype_results=grype(t),
        trivy_vulnerability=trivy(t),
        xeol_results=eol,
        semgrep_results=findings,
        iac_components=iac,
        recent_commits=history.recent_commits(commits(t), AS_OF),
    )


def stored_tables(t: Tables) -> p.ProfileTables:
    """As ``profile_tables``, with the costliest tables written once instead of derived per use."""
    tables = profile_tables(t)
    return replace(
        tables, syft_dependencies=checkpointed(tables.syft_dependencies), repo_metrics=checkpointed(tables.repo_metrics)
    )


_TABLES_SQL = f"""
  line as (select *, l_suppkey::varchar repo_id, l_linenumber::varchar ln, l_quantity::int q,
             case when l_partkey % 40 = 38 and l_suppkey % 5 = 0 then 'gradle-wrapper'
                  else 'lib-' || (l_partkey % 40) end pkg,
             case l_partkey % 4 when 0 then 'python' when 1 then 'npm' when 2 then 'java-archive' else 'gem' end kind
           from lineitem),
  inv as (select s_suppkey::varchar repo_id, s_name, case when s_acctbal > 0 then 'SUCCESS' else 'Unknown' end status,
            n_name, 'tc-' || n_regionkey tc, s_suppkey
          from supplier join nation on s_nationkey = n_nationkey where n_regionkey <> 4),
  deps as (select distinct repo_id, pkg, ln, kind,
             case when l_partkey % 8 = 2 and l_suppkey % 3 = 0 then '/app/pom.xml' else '/lock' end loc,
             case when kind = 'python' and regexp_matches(pkg, 'lib-1[0-9]$') then 'TeenKit'
                  when kind = 'npm' and regexp_matches(pkg, 'lib-[0-9]$') then 'OneJS'
                  when kind = 'java-archive' and contains(pkg, 'lib-2') then 'TwoJ' else '' end fw,
             case when kind = 'python' and regexp_matches(pkg, 'lib-1[0-9]$') then 'Teens'
                  when kind = 'npm' and regexp_matches(pkg, 'lib-[0-9]$') then 'Digits'
                  when kind = 'java-archive' and contains(pkg, 'lib-2') then 'Twenties'
                  when kind = 'java-archive' and contains(pkg, 'wrapper') then 'Wrappers' else 'Other' end cat,
             case when kind = 'python' and regexp_matches(pkg, 'lib-1[0-9]$') then 'Tens'
                  when kind = 'npm' and regexp_matches(pkg, 'lib-[0-9]$') then 'Ones'
                  when kind = 'java-archive' and contains(pkg, 'lib-2') then 'Twos'
                  when kind = 'java-archive' and contains(pkg, 'wrapper') then 'Build' else '' end sub,
             case fw when 'OneJS' then ' OneJS ' else fw end fws0
           from line),
  vall as (select repo_id, pkg, ln, case l_returnflag when 'A' then 'Critical' when 'N' then 'High' else 'Low' end sev,
             'f' || ln fix, 'Grype' src from line where l_linestatus = 'F'
           union all
           select repo_id, pkg, ln, case l_returnflag when 'A' then 'CRITICAL' when 'N' then 'High' else 'Low' end,
             't' || ln, 'Trivy' from line where l_linestatus = 'O' and l_partkey % 10 <> 0),
  vulns as (select * from vall qualify row_number() over
              (partition by repo_id, pkg, ln, sev order by src, fix) = 1),
  authors as (select repo_id, l_returnflag || ln author, count(*) n, min(l_shipdate) f, max(l_shipdate) l
              from line group by all),
  ranked as (select *, row_number() over (partition by repo_id order by n desc, author) rn from authors),
  hist as (select repo_id, sum(n)::bigint commits, count(*) people, max(l) l,
             floor(date_diff('second', min(f), timestamp '{AS_OF}') / 86400)::bigint age,
             floor(date_diff('second', max(l), timestamp '{AS_OF}') / 86400)::bigint idle,
             max(n) top1, (sum(n) filter (rn <= 3))::bigint top3 from ranked group by all),
  sizes as (select repo_id, sum(q * 12345) all_bytes, coalesce(sum(q * 12345) filter (l_returnflag <> 'R'), 0) code_bytes,
              count(*) filter (l_returnflag <> 'R') files from line group by all),
  branch as (select repo_id, count(*) n from line where q = 1 group by all),
  recent as (select repo_id, string_agg(strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S'), ',' order by l_shipdate desc) dates
             from line where l_shipdate >= timestamp '{AS_OF}' - interval 365 days group by all)"""


def _mb(x: str) -> str:
    return f"format('{{:.2f}}', {x} / 1000000.0::double)::double"


_BASIC_SQL = f"""
  select inv.repo_id, s_name repo_name, status, n_name host_name, tc, '2001-11-30T01:02:03.250000' last_updated,
         'git@github.com:o/' || s_suppkey clone_url, 'https://github.com/o/' || s_suppkey browse_url,
         {_mb("all_bytes")} size_mb, {_mb("code_bytes")} code_mb, files file_count, commits total_commits,
         people contributors, case when idle > 365 then 'INACTIVE' else 'ACTIVE' end activity_status,
         strftime(l, '%Y-%m-%dT%H:%M:%S') last_commit, format('{{:.2f}}', age / 365.0::double)::double age_years,
         coalesce(branch.n, 0) branches, top1, top3, coalesce(dates, '') recent_dates
  from inv join hist using (repo_id) join sizes using (repo_id) left join branch using (repo_id)
       left join recent using (repo_id)"""


def _fields(profiles: DataFrame, **fields: Column) -> DataFrame:
    return profiles.select("repo_id", *[c.alias(n) for n, c in fields.items()])


def at(name: str) -> Column:
    return F.col("profile").getField(name)


def long(c: Column) -> Column:
    return c.cast("bigint")


# --- single sections --------------------------------------------------------


@query(
    "q_vuln_union_dedup",
    f"""with {_TABLES_SQL}
        select repo_id, pkg package, ln as version, sev severity, fix fix_version, src source from vulns""",
)
def q_vuln_union_dedup(t: Tables) -> DataFrame:
    return v.deduplicated_vulnerabilities(v.combined_vulnerabilities(grype(t), trivy(t)))


@query(
    "q_vuln_normalized",
    f"""with {_TABLES_SQL}, u as (select repo_id, pkg, ln, upper(sev[1]) || lower(sev[2:]) sev, src from vall),
          k as (select * from u qualify row_number() over (partition by repo_id, pkg, ln, sev order by src) = 1)
        select repo_id, src source, sev severity, count(*) n from k group by all""",
)
def q_vuln_normalized(t: Tables) -> DataFrame:
    combined = v.combined_vulnerabilities(grype(t), trivy(t), normalize_severity=True)
    kept = v.deduplicated_vulnerabilities(combined)
    return kept.groupBy("repo_id", "source", "severity").agg(F.count(F.lit(1)).alias("n"))


@query(
    "q_vuln_metrics",
    f"""with {_TABLES_SQL}, d as (select repo_id, count(*) n from deps group by all)
        select repo_id, count(*) vulnerability_count, count(*) filter (sev = 'Critical') critical_count,
               format('{{:.2f}}', count(*)::double / greatest(coalesce(any_value(n), 0), 1) * 100)::double
                 vulnerable_percent
        from vulns left join d using (repo_id) group by repo_id""",
)
def q_vuln_metrics(t: Tables) -> DataFrame:
    kept = v.deduplicated_vulnerabilities(v.combined_vulnerabilities(grype(t), trivy(t)))
    return v.vulnerability_metrics(kept, section_counts("Dependencies", dependencies(t)))


_TOOL_SQL = """
  tool as (select repo_id, first(tool order by rnk, pkg, ln) build_tool from (
     select *, case when pkg = 'gradle-wrapper' then 'gradle-wrapper:' || ln
                    when kind = 'java-archive' and contains(loc, 'pom.xml') then 'maven'
                    when kind = 'python' then 'python' when kind = 'npm' then 'node' when kind = 'gem' then 'ruby' end tool,
               case when pkg = 'gradle-wrapper' then 0 when tool = 'maven' then 1 when tool is not null then 2 end rnk
     from deps) where rnk is not null group by repo_id)"""


@query(
    "q_build_tool_infer",
    f"with {_TABLES_SQL}, {_TOOL_SQL} select repo_id, build_tool from tool",
)
def q_build_tool_infer(t: Tables) -> DataFrame:
    return infer_build_tool(dependencies(t), ["package_name", "version"])


_RUNTIME_SQL = """
  runtimes as (select repo_id, string_agg(e, ', ' order by e) runtime from (
     select distinct repo_id, case ln when '1' then 'Java:' when '2' then 'Node.js:' else 'Unknown:' end
         || case l_returnflag when 'A' then '17' when 'N' then '21' else 'Unknown' end e
     from line) group by repo_id)"""


@query("q_runtime_label", f"with {_TABLES_SQL}, {_RUNTIME_SQL} select repo_id, runtime from runtimes")
def q_runtime_label(t: Tables) -> DataFrame:
    rows = p.runtime_versions(profile_tables(t).build_tools)
    return rows.select("repo_id", F.col("runtime_version").alias("runtime"))


@query(
    "q_frameworks_sorted",
    f"""with {_TABLES_SQL} select repo_id, string_agg(distinct fw, ',' order by fw) frameworks
        from deps where fw <> '' group by repo_id""",
)
def q_frameworks_sorted(t: Tables) -> DataFrame:
    names = distinct_names(dependencies(t), "framework", "frameworks", trim=True)
    return names.select("repo_id", F.array_join("frameworks", ",").alias("frameworks"))


# --- whole profiles ---------------------------------------------------------

_PROFILE_SQL = f"""with {_TABLES_SQL}, {_TOOL_SQL}, {_RUNTIME_SQL},
  basic as ({_BASIC_SQL}),
  pct as (select repo_id, 'lang' || ln lang, format('{{:.2f}}', sum(l_quantity) * 100
              / sum(sum(l_quantity)) over (partition by repo_id))::double pct from line group by repo_id, ln),
  lang as (select repo_id, string_agg(lang || '=' || format('{{:.2f}}', pct), ';' order by lang) shares,
             first(lang order by pct desc, lang) main, string_agg(lang, ',' order by lang) langs from pct group by repo_id),
  liz as (select repo_id, sum(q)::bigint nloc, format('{{:.2f}}', avg(l_linenumber))::double ccn,
             sum(l_partkey)::bigint tokens, count(*) functions, sum(l_linenumber)::bigint total_ccn
          from line group by repo_id),
  loc as (select repo_id, sum(q)::bigint code, sum(l_linenumber)::bigint blank, count(*) remarks
          from line group by repo_id),
  dep as (select repo_id, count(*) n, string_agg(concat_ws('|', pkg, ln, kind, 'any', loc, 'MIT', cat, sub, fws0), ';' order by pkg, ln, kind, loc) list,
             coalesce(string_agg(distinct nullif(fw, ''), ',' order by nullif(fw, '')), '') fws
          from deps group by repo_id),
  sec as (select repo_id, count(*) n, count(*) filter (sev = 'Critical') critical,
             string_agg(concat_ws('|', pkg, ln, sev, fix, src), ';' order by pkg, ln, sev) list
          from vulns group by repo_id),
  eol as (select repo_id, count(*) n, string_agg(concat_ws('|', pkg, ln, l_shipdate::date::varchar, '99'), ';'
             order by pkg, ln, l_shipdate) list from line group by repo_id),
  sem as (select repo_id, count(*) n, string_agg(concat_ws('|', 'src/' || l_orderkey, l_returnflag, l_linestatus, 'security', '', 'LOW', 'HIGH', ln), ';'
             order by 'src/' || l_orderkey, l_returnflag, l_linestatus, ln) list
          from line group by repo_id),
  iac as (select repo_id, bool_or(l_linenumber = 1 and q <= 3) docker, bool_or(l_linenumber = 4 and q = 7) cicd,
             bool_or(l_linenumber = 2 and q = 9) config,
             coalesce(string_agg(distinct fwk, ',' order by fwk), '') fws
          from (select *, case when l_linenumber = 1 and q <= 3 then 'Dockerfile' when l_linenumber = 2 then 'Terraform'
                  when l_linenumber = 3 then null else 'Helm' end fwk from line) group by repo_id)
  select basic.*, null::varchar app_id, shares, main main_language,
    array_to_string(list_filter(string_split(langs, ','), lambda x: x <> main), ',') other_languages, coalesce(nloc, 0) nloc, coalesce(ccn, 0) avg_ccn,
    coalesce(tokens, 0) tokens, coalesce(functions, 0) functions, coalesce(total_ccn, 0) total_ccn,
    coalesce(code, 0) loc, coalesce(blank, 0) blank, coalesce(remarks, 0) remarks,
    case when coalesce(code, 0) < 100 and size_mb < 1 then 'Empty/Minimal' when coalesce(code, 0) < 100 then 'Docs/Data'
         when size_mb < 1 then 'Tiny' when size_mb < 10 then 'Small' when size_mb < 100 then 'Medium'
         when size_mb < 1000 then 'Large' else 'Massive' end label,
    coalesce(dep.n, 0) n_deps, coalesce(dep.list, '') deps, coalesce(dep.fws, '') frameworks,
    coalesce(build_tool, 'Unknown') build_tool, coalesce(runtime, '-') runtime,
    coalesce(sec.n, 0) n_vulns, coalesce(sec.list, '') vulns, coalesce(critical, 0) critical,
    format('{{:.2f}}', coalesce(sec.n, 0)::double / greatest(coalesce(dep.n, 0), 1) * 100)::double vuln_percent,
    coalesce(eol.n, 0) n_eol, coalesce(eol.list, '') eol, coalesce(sem.n, 0) n_findings, coalesce(sem.list, '') findings,
    coalesce(docker, false) dockerfile, coalesce(cicd, false) cicd, coalesce(config, false) iac_config,
    coalesce(iac.fws, '') iac_frameworks
  from basic left join lang using (repo_id) left join liz using (repo_id) left join loc using (repo_id)
    left join dep using (repo_id) left join tool using (repo_id) left join runtimes using (repo_id)
    left join sec using (repo_id) left join eol using (repo_id) left join sem using (repo_id)
    left join iac using (repo_id)"""


def _joined(name: str, *fields: str) -> Column:
    return F.array_join(F.transform(at(name), lambda x: F.concat_ws("|", *[x[f] for f in fields])), ";")


def shown_profile(profiles: DataFrame) -> DataFrame:
    """Every field of the nested profile, lists as text."""
    shares = F.transform(
        F.map_entries(at("Language Percentages")),
        lambda e: F.concat(e["key"], F.lit("="), F.format_string("%.2f", e["value"])),
    )
    flags = at("Modernization Signals")
    return _fields(
        profiles,
        repo_name=at("Repo Name"),
        status=at("Status"),
        host_name=at("VCS Hostname"),
        app_id=at("App ID"),
        tc=at("TC"),
        last_updated=at("Last Updated"),
        clone_url=at("Clone URL SSH"),
        browse_url=at("Browse URL"),
        size_mb=at("Repo Size (MB)"),
        code_mb=at("Code Size (MB)"),
        file_count=long(at("File Count")),
        total_commits=long(at("Total Commits")),
        contributors=long(at("Contributors")),
        activity_status=at("Activity Status"),
        last_commit=at("Last Commit Date"),
        age_years=at("Repo Age (Years)"),
        branches=long(at("Active Branch Count")),
        top1=long(at("Top Contributor Commits")),
        top3=long(at("Commits by Top 3 Contributors")),
        recent_dates=F.array_join(at("Recent Commit Dates"), ","),
        shares=F.array_join(F.array_sort(shares), ";"),
        main_language=at("Main Language"),
        other_languages=F.array_join(at("Other Languages"), ","),
        nloc=long(at("Total NLOC")),
        avg_ccn=at("Avg Cyclomatic Complexity"),
        tokens=long(at("Total Tokens")),
        functions=long(at("Total Functions")),
        total_ccn=long(at("Total Cyclomatic Complexity")),
        loc=long(at("Lines of Code")),
        blank=long(at("Blank Lines")),
        remarks=long(at("Comment Lines")),
        label=at("Classification Label"),
        n_deps=long(at("Total Dependencies")),
        deps=_joined("Dependencies", *[n for _, n in p.DEPENDENCY_FIELDS[:4]], "locations", "licenses", *[n for _, n in p.DEPENDENCY_FIELDS[6:]]),
        frameworks=F.array_join(at("Frameworks"), ","),
        build_tool=at("Build Tool"),
        runtime=F.coalesce(at("Runtime Version"), F.lit("-")),
        n_vulns=F.size(at("Vulnerabilities")).cast("bigint"),
        vulns=_joined("Vulnerabilities", *p.VULNERABILITY_FIELDS),
        critical=long(at("Critical Vuln Count")),
        vuln_percent=at("Vulnerable Dependencies %"),
        n_eol=long(at("EOL Packages Found")),
        eol=_joined("EOL Results", *p.EOL_FIELDS),
        n_findings=F.size(at("Semgrep Findings")).cast("bigint"),
        findings=_joined("Semgrep Findings", *p.SEMGREP_FIELDS),
        dockerfile=flags["Dockerfile"],
        cicd=flags["CI/CD Pipeline"],
        iac_config=flags["IaC Config"],
        iac_frameworks=F.array_join(at("IaC Frameworks"), ","),
    )


@query("q_profile", _PROFILE_SQL)
def q_profile(t: Tables) -> DataFrame:
    return shown_profile(p.assembled(p.build_profiles(stored_tables(t))))


@query(
    "q_profile_documents",
    f"""select repo_id, repo_name, size_mb, n_deps, vuln_percent, n_findings, dockerfile, main_language, label, n_vulns
        from ({_PROFILE_SQL})""",
)
def q_profile_documents(t: Tables) -> DataFrame:
    """The serialised documents, read back as JSON."""
    profiles = p.build_profiles(stored_tables(t))
    doc = F.parse_json("profile_json")

    def get(path: str, kind: str) -> Column:
        return F.variant_get(doc, path, kind)

    return p.profile_documents(profiles).select(
        get("$['Repo ID']", "string").alias("repo_id"),
        get("$['Repo Name']", "string").alias("repo_name"),
        get("$['Repo Size (MB)']", "double").alias("size_mb"),
        get("$['Total Dependencies']", "bigint").alias("n_deps"),
        get("$['Vulnerable Dependencies %']", "double").alias("vuln_percent"),
        F.size(get("$['Semgrep Findings']", "array<variant>")).cast("bigint").alias("n_findings"),
        get("$['Modernization Signals'].Dockerfile", "boolean").alias("dockerfile"),
        get("$['Main Language']", "string").alias("main_language"),
        get("$['Classification Label']", "string").alias("label"),
        F.size(get("$.Vulnerabilities", "array<variant>")).cast("bigint").alias("n_vulns"),
    )


@query(
    "q_profile_overflow",
    f"""select repo_id, 'Vulnerabilities' section, n_vulns n from ({_PROFILE_SQL}) where n_vulns > 150
        union all select repo_id, 'Dependencies', n_deps from ({_PROFILE_SQL}) where n_deps > 150
        union all select repo_id, 'document', n_eol + n_findings + n_deps from ({_PROFILE_SQL})""",
)
def q_profile_overflow(t: Tables) -> DataFrame:
    """Sections of many small parts add up to every row, next to the counts of the profile rows."""
    profiles = p.build_profiles(stored_tables(t), part_items=20)
    copies = F.from_json("items_json", "array<struct<copies: bigint>>")
    n = F.sum(F.aggregate(copies, F.lit(0).cast("bigint"), lambda a, x: a + x["copies"])).alias("n")
    counted = p.section_rows(profiles).groupBy("repo_id", "section").agg(n)
    long_lists = counted.where((F.col("n") > 150) & F.col("section").isin("Vulnerabilities", "Dependencies"))
    findings = counted.where(F.col("section") == "Semgrep Findings").select("repo_id", F.col("n").alias("found"))
    total = at("EOL Packages Found") + F.coalesce("found", F.lit(0)) + at("Total Dependencies")
    documents = profiles.scalars.join(findings, "repo_id", "left")
    documents = documents.select("repo_id", F.lit("document").alias("section"), total.cast("bigint").alias("n"))
    return long_lists.unionByName(documents)


@query(
    "q_profile_rejects",
    """select s_suppkey::varchar repo_id, 'Missing repository or metrics for ' || s_suppkey error
       from supplier join nation on s_nationkey = n_nationkey where n_regionkey = 4""",
)
def q_profile_rejects(t: Tables) -> DataFrame:
    return p.profile_rejects(profile_tables(t))


@query(
    "q_list_parts",
    """select l_suppkey::varchar repo_id, count(*) n, sum(l_orderkey)::bigint keys,
              count(distinct l_returnflag) flags, true bounded from lineitem group by l_suppkey""",
)
def q_list_parts(t: Tables) -> DataFrame:
    """The parts of a skewed table add up to every row."""
    limit = 100
    rows = t.lineitem.select(repo(), "l_orderkey", "l_returnflag")
    parts = list_parts(rows, ["l_orderkey", "l_returnflag"], limit)
    entry = parts.select("repo_id", (F.size("items") <= limit).alias("bounded"), F.explode("items").alias("i"))
    return entry.groupBy("repo_id").agg(
        F.sum("i.copies").alias("n"),
        F.sum(F.col("i.item.l_orderkey") * F.col("i.copies")).alias("keys"),
        F.countDistinct("i.item.l_returnflag").alias("flags"),
        F.bool_and("bounded").alias("bounded"),
    )
