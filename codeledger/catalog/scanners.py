"""Report ingestion on the driver tables: each row becomes a scanner report.

Reports are encoded per row with ``to_json``, so building them needs no
grouping; the parsers then see nested, partial and broken documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeledger import schemas
from codeledger.catalog.portfolio import languages, text
from codeledger.catalog.registry import Tables, query
from codeledger.functions.scalars import python_round
from codeledger.operators import reports as r
from codeledger.operators.dependencies import categorize_dependencies, sbom_dependencies
from codeledger.plans.profile import language_section, loc_totals
from codeledger.sources.rules import CategoryRule


def lit(value) -> Column:
    return F.lit(value)


def named(**fields: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def items(t: Tables) -> DataFrame:
    return t.wide("lineitem").join(t.part, F.col("l_partkey") == F.col("p_partkey"))


# --- lines of code, complexity, languages -----------------------------------


def cloc_reports(t: Tables) -> DataFrame:
    lines = F.length("text") - F.length(F.replace("text", lit("\n"), lit(""))) + 1
    counts = named(nFiles=lit(1), blank=F.col("n_chars") % 5, comment=F.col("n_chars") % 7, code=lines)
    header = named(n_files=lit(2), version=lit("1.9"))
    body = F.to_json(named(header=header, LANG=counts, SUM=counts))
    body = F.replace(body, lit('"LANG"'), F.concat(lit('"'), "lang", lit('"')))
    return t.wide("documents").select(F.col("source").alias("repo_id"), lit("cloc").alias("tool"), body.alias("body"))


_CLOC_SQL = """
  select source repo_id, lang as language, 1 files, n_chars % 5 blank, n_chars % 7 "comment",
         length(text) - length(replace(text, chr(10), '')) + 1 code from documents"""


@query(
    "q_cloc_languages",
    f"""select repo_id, language, sum(files)::bigint files, sum(blank)::bigint blank, sum("comment")::bigint "comment",
               sum(code)::bigint code from ({_CLOC_SQL}) group by all""",
)
def q_cloc_languages(t: Tables) -> DataFrame:
    rows = r.parse_cloc(cloc_reports(t))
    return rows.groupBy("repo_id", "language").agg(
        *[F.sum(c).alias(c) for c in ("files", "blank", "comment", "code")]
    )


@query(
    "q_loc_totals",
    f"""select repo_id, sum(code)::bigint code, sum(blank)::bigint blank, sum("comment")::bigint "comment"
        from ({_CLOC_SQL}) group by all""",
)
def q_loc_totals(t: Tables) -> DataFrame:
    return loc_totals(r.parse_cloc(cloc_reports(t)))


def lizard_reports(t: Tables) -> DataFrame:
    quantity = F.col("l_quantity").cast("int").cast("string")
    head = F.concat_ws(",", quantity, text("l_linenumber"), text("l_partkey"), lit("1"), lit("12"))
    tail = lit(',"f@1-12@./a.py","./a.py","f","f( a )",1,12')
    long_tail = lit(',"g@1-22@./a.py","./a.py","g","g( a , b )",1,22')
    body = F.concat(head, tail, lit("\n"), head, long_tail, lit("\n\nnot a function\n"))
    return t.wide("lineitem").select(text("l_suppkey").alias("repo_id"), lit("lizard").alias("tool"), body.alias("body"))


def _complexity_sql(copies: int) -> str:
    return f"""select l_suppkey::varchar repo_id, (sum(l_quantity) * {copies})::bigint total_nloc,
         sum(l_linenumber) / count(*) avg_ccn, (sum(l_partkey) * {copies})::bigint total_token_count,
         count(*) * {copies} function_count, (sum(l_linenumber) * {copies})::bigint total_ccn
       from lineitem group by l_suppkey"""


@query("q_complexity_summary", _complexity_sql(1))
def q_complexity_summary(t: Tables) -> DataFrame:
    return r.parse_lizard(lizard_reports(t))


@query("q_complexity_quoted", _complexity_sql(2))
def q_complexity_quoted(t: Tables) -> DataFrame:
    return r.parse_lizard(lizard_reports(t), strict=False)


@query(
    "q_complexity_errors",
    "select distinct l_suppkey::varchar repo_id from lineitem where l_quantity = 50 and l_linenumber = 7",
)
def q_complexity_errors(t: Tables) -> DataFrame:
    broken = (F.col("l_quantity") == 50) & (F.col("l_linenumber") == 7)
    first = F.when(broken, "x1").otherwise(text("l_partkey"))
    line = F.concat_ws(",", first, lit("1,2,3,4,a,b,c,d,1,2"))
    return r.complexity_errors(t.lineitem.select(text("l_suppkey").alias("repo_id"), line.alias("line")))


@query(
    "q_percent_parse",
    """select p_partkey::varchar repo_id, p_name as language, p_retailprice / 100 percent_usage
       from part where p_size % 10 <> 0
       union all select p_partkey::varchar, 'Java Server Pages', p_size::double from part""",
)
def q_percent_parse(t: Tables) -> DataFrame:
    share = F.when(F.col("p_size") % 10 == 0, lit("n/a")).otherwise((F.col("p_retailprice") / 100).cast("string"))
    body = F.concat(share, lit("%\t"), "p_name", lit("  \n  "), text("p_size"), lit("%   Java Server Pages\n\n7%\n"))
    reports = t.part.select(text("p_partkey").alias("repo_id"), lit("enry").alias("tool"), body.alias("body"))
    return r.parse_enry(reports).select("repo_id", "language", "percent_usage")


@query(
    "q_language_map",
    """with s as (select l_suppkey::varchar repo_id, p_type as language, sum(l_quantity) q
                  from lineitem join part on l_partkey = p_partkey group by all),
            p as (select repo_id, language,
                         format('{:.2f}', q * 100 / sum(q) over (partition by repo_id))::double pct from s),
            m as (select repo_id, language main from p
                  qualify row_number() over (partition by repo_id order by pct desc, language) = 1)
       select repo_id, string_agg(language || '=' || format('{:.2f}', pct), ';' order by language) shares,
              any_value(main) main, string_agg(language, ';' order by language) filter (language <> main) others
       from p join m using (repo_id) group by repo_id""",
)
def q_language_map(t: Tables) -> DataFrame:
    rows = language_section(languages(t))
    entries = F.transform(
        F.map_entries("shares"), lambda e: F.concat(e["key"], lit("="), F.format_string("%.2f", e["value"]))
    )
    return rows.select(
        "repo_id",
        F.array_join(F.array_sort(entries), ";").alias("shares"),
        "main",
        F.array_join(F.array_sort("others"), ";").alias("others"),
    )


@query(
    "q_rounding",
    """select l_suppkey::varchar repo_id, count(*) n,
              round(sum(format('{:.2f}', l_extendedprice * l_discount / 7)::double * 100))::bigint cents,
              round(sum(format('{:.2f}', l_quantity / 8)::double * 100))::bigint eighths
       from lineitem group by l_suppkey""",
)
def q_rounding(t: Tables) -> DataFrame:
    value = python_round(F.col("l_extendedprice") * F.col("l_discount") / 7, 2)
    eighth = python_round(F.col("l_quantity") / 8, 2)
    return t.lineitem.groupBy(text("l_suppkey").alias("repo_id")).agg(
        F.count(lit(1)).alias("n"),
        F.round(F.sum(value * 100)).cast("bigint").alias("cents"),
        F.round(F.sum(eighth * 100)).cast("bigint").alias("eighths"),
    )


# --- vulnerabilities, end of life -------------------------------------------


@query(
    "q_nested_vulns",
    """with v as (
         select l_suppkey::varchar repo_id, 'pom.xml' target, 'lang-pkgs' resource_class, l_returnflag severity,
                'CVE-' || l_partkey id, l_quantity q from lineitem
         union all
         select l_suppkey::varchar, 'pom.xml', 'lang-pkgs', null, 'GHSA-' || l_orderkey, null from lineitem
         union all
         select l_suppkey::varchar, 'go.sum', 'lang-pkgs', 'LOW', 'CVE-low', l_quantity from lineitem
         where l_linenumber = 1)
       select repo_id, target, resource_class, severity, count(*) n, count(distinct id) ids,
              sum(q)::bigint versions from v group by all""",
)
def q_nested_vulns(t: Tables) -> DataFrame:
    first = named(
        VulnerabilityID=F.concat(lit("CVE-"), text("l_partkey")),
        PkgName=lit("a:b"),
        InstalledVersion=F.col("l_quantity").cast("int").cast("string"),
        Severity=F.col("l_returnflag"),
    )
    second = named(
        VulnerabilityID=F.concat(lit("GHSA-"), text("l_orderkey")),
        PkgName=lit(None).cast("string"),
        InstalledVersion=lit(None).cast("string"),
        Severity=lit(None).cast("string"),
    )
    low = named(
        VulnerabilityID=lit("CVE-low"),
        PkgName=lit("c"),
        InstalledVersion=F.col("l_quantity").cast("int").cast("string"),
        Severity=lit("LOW"),
    )
    results = F.array(
        named(Target=lit("pom.xml"), Class=lit("lang-pkgs"), Type=lit("pom"), Vulnerabilities=F.array(first, second)),
        named(
            Target=lit("go.sum"),
            Class=lit("lang-pkgs"),
            Type=lit("gomod"),
            Vulnerabilities=F.when(F.col("l_linenumber") == 1, F.array(low)),
        ),
        named(
            Target=lit("Dockerfile"),
            Class=lit("config"),
            Type=lit("dockerfile"),
            Vulnerabilities=F.slice(F.array(low), 1, 0),
        ),
    )
    reports = t.wide("lineitem").select(text("l_suppkey").alias("repo_id"), F.to_json(named(Results=results)).alias("body"))
    rows = r.parse_trivy(reports)
    return rows.groupBy("repo_id", "target", "resource_class", "severity").agg(
        F.count(lit(1)).alias("n"),
        F.countDistinct("vulnerability_id").alias("ids"),
        F.sum(F.col("installed_version").cast("bigint")).alias("versions"),
    )


@query(
    "q_match_vulns",
    """select p_partkey::varchar repo_id, 'CVE-' || p_size cve, 'No description provided' description,
              'Critical' severity, 'java' as language, p_brand || ':' || p_name package, p_size::varchar as version,
              '1, ' || p_size fix_versions, 'fixed' fix_state, '/' || p_name || '.jar' file_path from part
       union all
       select p_partkey::varchar, 'No CVE', p_type, 'UNKNOWN', 'Unknown', p_name, 'Unknown', '', 'not fixed', 'N/A'
       from part where p_size % 2 = 0""",
)
def q_match_vulns(t: Tables) -> DataFrame:
    full = named(
        vulnerability=named(
            id=F.concat(lit("CVE-"), text("p_size")),
            description=lit(None).cast("string"),
            severity=lit("Critical"),
            fix=named(versions=F.array(lit("1"), text("p_size")), state=lit("fixed")),
        ),
        artifact=named(
            name=F.col("p_name"),
            version=text("p_size"),
            language=lit("java"),
            metadata=named(pomGroupID=F.col("p_brand"), pomArtifactID=F.col("p_name")),
            locations=F.array(
                named(path=F.concat(lit("/"), "p_name", lit(".jar"))), named(path=lit("/second.jar"))
            ),
        ),
    )
    bare = named(
        vulnerability=named(
            id=lit(None).cast("string"),
            description=F.col("p_type"),
            severity=lit(None).cast("string"),
            fix=lit(None).cast("struct<versions: array<string>, state: string>"),
        ),
        artifact=named(
            name=F.col("p_name"),
            version=lit(None).cast("string"),
            language=lit(None).cast("string"),
            metadata=named(pomGroupID=F.col("p_brand"), pomArtifactID=lit("")),
            locations=F.array().cast("array<struct<path: string>>"),
        ),
    )
    matches = F.when(F.col("p_size") % 2 == 0, F.array(full, bare)).otherwise(F.array(full))
    reports = t.part.select(text("p_partkey").alias("repo_id"), F.to_json(named(matches=matches)).alias("body"))
    return r.parse_grype(reports).drop("cvss")


@query(
    "q_eol_match",
    """select p_partkey::varchar repo_id, p_brand product_name, 'Unknown' product_permalink,
              p_size::varchar release_cycle, case when p_size % 3 = 0 then 'true' else '2023-04-30' end eol_date,
              '14.' || p_size latest_release, 'Unknown' latest_release_date, 'Unknown' release_date,
              p_name artifact_name, '14' artifact_version, 'binary' artifact_type,
              case when p_size % 2 = 0 then '/usr/' || p_name else 'N/A' end file_path, 'Unknown' as language
       from part""",
)
def q_eol_match(t: Tables) -> DataFrame:
    cycle = named(
        ProductName=F.col("p_brand"),
        ReleaseCycle=text("p_size"),
        Eol=F.when(F.col("p_size") % 3 == 0, "#true#").otherwise("2023-04-30"),
        LatestRelease=F.concat(lit("14."), text("p_size")),
    )
    places = F.array(named(path=F.concat(lit("/usr/"), "p_name")))
    artifact = named(
        name=F.col("p_name"),
        version=lit("14"),
        type=lit("binary"),
        locations=F.when(F.col("p_size") % 2 == 0, places),
    )
    body = F.to_json(named(matches=F.array(named(Cycle=cycle, artifact=artifact))))
    body = F.replace(body, lit('"#true#"'), lit("true"))
    return r.parse_xeol(t.part.select(text("p_partkey").alias("repo_id"), body.alias("body")))


# --- findings and checks ----------------------------------------------------


@query(
    "q_findings",
    """select user_id::varchar repo_id, 'src/' || event_type || '.py' path, event_id::int start_line,
              (event_id + 1)::int end_line, event_type rule_id,
              case event_type when 'error' then 'ERROR' else 'INFO' end severity, props message,
              case when event_id % 2 = 0 then 'security' else '' end category,
              case when event_id % 5 = 0 then 'vuln' else '' end subcategory,
              case when event_id % 2 = 0 then 'flask' else '' end technology,
              case event_id % 3 when 0 then 'CWE-1, CWE-' || event_id when 1 then 'CWE-' || event_id else '' end cwe,
              '' likelihood, 'HIGH' impact, '' confidence from events""",
)
def q_findings(t: Tables) -> DataFrame:
    e = F.col("event_id")
    cwe = F.concat(lit("CWE-"), text("event_id"))
    metadata = named(
        category=F.when(e % 2 == 0, "security"),
        subcategory=F.when(e % 5 == 0, F.array(lit("vuln"))),
        technology=F.when(e % 2 == 0, F.array(lit("flask"))),
        cwe=F.when(e % 3 == 0, F.array(lit("CWE-1"), cwe)),
        impact=lit("HIGH"),
    )
    result = named(
        check_id=F.col("event_type"),
        path=F.concat(lit("src/"), "event_type", lit(".py")),
        start=named(line=e),
        end=named(line=e + 1),
        extra=named(
            severity=F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO"),
            message=F.col("props"),
            metadata=metadata,
        ),
    )
    body = F.to_json(named(results=F.array(result)))
    as_text = F.concat(lit('"metadata":{"cwe":"'), cwe, lit('",'))
    body = F.when(e % 3 == 1, F.replace(body, lit('"metadata":{'), as_text)).otherwise(body)
    return r.parse_semgrep(t.wide("events").select(text("user_id").alias("repo_id"), body.alias("body")))


def checkov_reports(t: Tables, per_event: bool = False) -> DataFrame:
    e, v = F.col("event_id"), F.col("value").cast("int")
    tf = named(check_type=lit("terraform"), summary=named(passed=v, failed=lit(2)))
    k8s = named(check_type=lit("kubernetes"), summary=named(passed=v + 1))
    single = named(check_type=lit("dockerfile"), summary=named(passed=v, failed=lit(0), skipped=lit(1)))
    bare = named(passed=lit(0), failed=lit(0), skipped=lit(3), parsing_errors=lit(4), resource_count=v)
    shape = e % 5
    both = F.concat(lit("["), F.to_json(tf), lit(", "), F.to_json(k8s), lit("]"))
    body = (
        F.when(shape == 0, both)
        .when(shape == 1, F.to_json(single))
        .when(shape == 2, F.to_json(bare))
        .when(shape == 3, "[]")
        .otherwise("{")
    )
    repo = text("event_id" if per_event else "user_id")
    return t.wide("events").select(repo.alias("repo_id"), lit("checkov").alias("tool"), body.alias("body"))


_CHECKS_SQL = """
  select event_id, user_id, 'terraform' check_type, 0 pos, value::int::bigint v from events where event_id % 5 = 0
  union all select event_id, user_id, 'kubernetes', 1, value::int from events where event_id % 5 = 0
  union all select event_id, user_id, 'dockerfile', 0, value::int from events where event_id % 5 = 1
  union all select event_id, user_id, 'no-checks', 0, value::int from events where event_id % 5 = 2"""
_CHECK_COUNTS_SQL = """
  case check_type when 'kubernetes' then v + 1 when 'no-checks' then 0 else v end passed,
  case check_type when 'terraform' then 2 else 0 end failed,
  case check_type when 'dockerfile' then 1 when 'no-checks' then 3 else 0 end skipped,
  case check_type when 'no-checks' then v else 0 end resource_count,
  case check_type when 'no-checks' then 4 else 0 end parsing_errors"""
_COUNTS = ["passed", "failed", "skipped", "resource_count", "parsing_errors"]


@query(
    "q_polymorphic_checks",
    f"""select repo_id, check_type, {", ".join(f"sum({c})::bigint {c}" for c in _COUNTS)}
        from (select user_id::varchar repo_id, check_type, {_CHECK_COUNTS_SQL}
              from ({_CHECKS_SQL.replace("value::int", "trunc(value)::int")})) group by all""",
)
def q_polymorphic_checks(t: Tables) -> DataFrame:
    rows = r.parse_checkov(checkov_reports(t))
    return rows.groupBy("repo_id", "check_type").agg(*[F.sum(c).alias(c) for c in _COUNTS])


@query(
    "q_checks_last_only",
    f"""select event_id::varchar repo_id, check_type, {_CHECK_COUNTS_SQL}
        from ({_CHECKS_SQL.replace("value::int", "trunc(value)::int")})
        qualify row_number() over (partition by event_id order by pos desc) = 1""",
)
def q_checks_last_only(t: Tables) -> DataFrame:
    return r.parse_checkov(checkov_reports(t, per_event=True), last_only=True)


@query(
    "q_report_errors",
    """select user_id::varchar repo_id, 'checkov' tool,
              case event_id % 5 when 3 then 'empty output' else 'not valid JSON' end reason, count(*) n
       from events where event_id % 5 >= 3 group by all""",
)
def q_report_errors(t: Tables) -> DataFrame:
    rows = r.report_errors(checkov_reports(t))
    return rows.groupBy("repo_id", "tool", "reason").agg(F.count(lit(1)).alias("n"))


# --- dependencies -----------------------------------------------------------

RULES = [
    CategoryRule("python", 0, ".*ring.*", "Rings", "Round", "RingLib"),
    CategoryRule("python", 1, "^(red|blue) ", "Colours", "Primary", "Paint"),
    CategoryRule("python", 2, ".*", "Python", "Any", ""),
    CategoryRule("npm", 0, r"widget\b", "Widgets", "UI", "WidgetKit"),
    CategoryRule("npm", 1, "small", "Sizes", "Small", ""),
    CategoryRule("npm", 2, ".*OLD.*", "Ages", "Old", "Retro"),
    CategoryRule("java-archive", 0, "^brand#1.*:(hot|cold)", "Heat", "Thermal", "Heater"),
    CategoryRule("java-archive", 1, "plate$", "Plates", "Flat", "PlateJ"),
]


def _label_sql(name: str, kind: str) -> str:
    """struct-free CASE for the rules above, in SQL's own regex dialect."""

    def pick(field: int) -> str:
        values = {
            "ring": ("Rings", "Round", "RingLib"),
            "colour": ("Colours", "Primary", "Paint"),
            "python": ("Python", "Any", ""),
            "widget": ("Widgets", "UI", "WidgetKit"),
            "small": ("Sizes", "Small", ""),
            "old": ("Ages", "Old", "Retro"),
            "heat": ("Heat", "Thermal", "Heater"),
            "plate": ("Plates", "Flat", "PlateJ"),
            "other": ("Other", "", ""),
        }
        v = {k: x[field] for k, x in values.items()}
        return f"""case when {kind} = 'python' and contains(lower({name}), 'ring') then '{v["ring"]}'
          when {kind} = 'python' and regexp_matches(lower({name}), '^(red|blue) ') then '{v["colour"]}'
          when {kind} = 'python' then '{v["python"]}'
          when {kind} = 'npm' and regexp_matches(lower({name}), 'widget\\b') then '{v["widget"]}'
          when {kind} = 'npm' and contains(lower({name}), 'small') then '{v["small"]}'
          when {kind} = 'npm' and contains(lower({name}), 'old') then '{v["old"]}'
          when {kind} = 'java-archive' and regexp_matches(lower({name}), '^brand#1.*:(hot|cold)') then '{v["heat"]}'
          when {kind} = 'java-archive' and regexp_matches(lower({name}), 'plate$') then '{v["plate"]}'
          else '{v["other"]}' end"""

    return f"{pick(0)} category, {pick(1)} sub_category, {pick(2)} framework"


_KIND_SQL = "case p_size % 4 when 0 then 'python' when 1 then 'npm' when 2 then 'java-archive' else 'gem' end"


def kind_of_part() -> Column:
    m = F.col("p_size") % 4
    return F.when(m == 0, "python").when(m == 1, "npm").when(m == 2, "java-archive").otherwise("gem")


@query(
    "q_category_first_match",
    f"""with n as (select p_partkey::varchar repo_id, {_KIND_SQL} package_type,
                          case when p_size % 4 = 2 then p_brand || ':' || p_name else p_name end package_name from part)
        select repo_id, package_type, package_name, {_label_sql("package_name", "package_type")} from n""",
)
def q_category_first_match(t: Tables) -> DataFrame:
    name = F.when(F.col("p_size") % 4 == 2, F.concat("p_brand", lit(":"), "p_name")).otherwise(F.col("p_name"))
    deps = t.part.select(
        text("p_partkey").alias("repo_id"), kind_of_part().alias("package_type"), name.alias("package_name")
    )
    return categorize_dependencies(deps, RULES).select(
        "repo_id", "package_type", "package_name", "category", "sub_category", "framework"
    )


def generated_rules(count: int) -> list[CategoryRule]:
    """Rules of several forms; one in a hundred holds no text that an index could use."""

    def pattern(i: int) -> str:
        code = f"k{i:04d}"
        forms = (f"widget-{code}$", f"^(red|blue).*{code}", rf"{code.upper()}|gizmo-k0{i % 1000:03d}", rf"{code}\b")
        return rf"k\d\d{i % 50:02d}$" if i % 100 == 3 else forms[i % 4]

    kinds = ("python", "npm", "java-archive")
    return [CategoryRule(kinds[i % 3], i, pattern(i), f"Category {i}", f"Sub {i % 7}", f"Frame {i % 11}") for i in range(count)]


def coded_dependencies(t: Tables) -> DataFrame:
    name = F.concat(F.replace("p_name", lit(" "), lit("-")), lit("-k"), F.lpad(text("p_partkey"), 4, "0"))
    return t.part.select(text("p_partkey").alias("repo_id"), kind_of_part().alias("package_type"), name.alias("package_name"))


@query(
    "q_category_index",
    f"""with n as (select p_partkey::varchar repo_id, {_KIND_SQL} package_type,
                          replace(p_name, ' ', '-') || '-k' || case when p_partkey < 10000 then lpad(p_partkey::varchar, 4, '0')
                            else left(p_partkey::varchar, 4) end package_name
                     from part),
        r as (select i, case i % 3 when 0 then 'python' when 1 then 'npm' else 'java-archive' end kind,
                case when i % 100 = 3 then printf('k\\d\\d%02d$', i % 50) when i % 4 = 0 then printf('widget-k%04d$', i)
                  when i % 4 = 1 then printf('^(red|blue).*k%04d', i)
                  when i % 4 = 2 then printf('K%04d|gizmo-k0%03d', i, i % 1000) else printf('k%04d\\b', i) end as p
              from (select unnest(range(2000)) i)),
        m as (select package_type, package_name, min(i) i from (select distinct package_type, package_name from n) d
              join r on kind = package_type and regexp_matches(package_name, p, 'i') group by all)
        select repo_id, package_type, package_name, coalesce('Category ' || i, 'Other') category,
               coalesce('Sub ' || (i % 7), '') sub_category, coalesce('Frame ' || (i % 11), '') framework
        from n left join m using (package_type, package_name)""",
)
def q_category_index(t: Tables) -> DataFrame:
    """Two thousand rules, found by their index."""
    return categorize_dependencies(coded_dependencies(t), generated_rules(2_000)).select(
        "repo_id", "package_type", "package_name", "category", "sub_category", "framework"
    )


def syft_reports(t: Tables) -> DataFrame:
    """One SBOM per ordered item, with a second copy of its artifact."""
    pom = F.when(
        F.col("p_size") % 4 == 2, named(pomProperties=named(groupId=F.col("p_brand"), artifactId=F.col("p_name")))
    )
    place = F.concat(lit("/o"), text("l_orderkey"), lit("/"), text("l_linenumber"))
    licenses = F.array(named(value=F.col("p_type")), named(value=lit(None).cast("string")))
    first = named(
        name=F.col("p_name"),
        version=text("p_size"),
        type=kind_of_part(),
        language=F.when(F.col("p_size") % 4 == 0, "python"),
        licenses=licenses,
        locations=F.array(named(path=place), named(path=lit("/x"))),
        metadata=pom,
    )
    copy = named(
        name=F.col("p_name"),
        version=text("p_size"),
        type=lit("later copy"),
        language=lit("none"),
        licenses=licenses,
        locations=F.array(named(path=lit("/copy"))),
        metadata=pom,
    )
    body = F.to_json(named(artifacts=F.array(first, copy)))
    order = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")]
    return items(t).select(text("l_suppkey").alias("repo_id"), F.struct(*order).alias("at"), body.alias("body"))


@query(
    "q_sbom_dependencies",
    f"""with a as (
          select l_suppkey::varchar repo_id,
                 case when p_size % 4 = 2 then p_brand || ':' || p_name else p_name end package_name,
                 p_size::varchar as version, {_KIND_SQL} package_type, p_type || ', Unknown' licenses,
                 '/o' || l_orderkey || '/' || l_linenumber || ', /x' locations,
                 case when p_size % 4 = 0 then 'python' else 'Unknown' end as language,
                 row_number() over (partition by l_suppkey, package_name, p_size
                   order by l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) rn
          from lineitem join part on l_partkey = p_partkey)
        select repo_id, package_name, version, package_type, licenses, locations, language,
               {_label_sql("package_name", "package_type")} from a where rn = 1""",
)
def q_sbom_dependencies(t: Tables) -> DataFrame:
    artifacts = syft_reports(t).select(
        "repo_id", "at", F.posexplode(F.from_json("body", schemas.SYFT_REPORT)["artifacts"]).alias("pos", "a")
    )
    deps = sbom_dependencies(artifacts, ["at", "pos"])
    return categorize_dependencies(deps, RULES).drop("ord")
