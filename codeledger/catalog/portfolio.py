"""Selection, batching, history, languages and status on the driver tables.

Roles: customer is the inventory, orders the commits (author = priority),
lineitem with part the languages, events the execution log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeledger.catalog.registry import Tables, query
from codeledger.functions.scalars import is_recent, size_class, ssh_clone_url
from codeledger.operators import history, selection, status
from codeledger.operators.keyed import insert_ignore, last_writer_wins, replace_by_key, upsert
from codeledger.operators.lists import whole_lists
from codeledger.plans import derived
from codeledger.sources.rules import RULESET_PATHS

AS_OF = "2001-08-02 00:00:00"


def text(c: str):
    return F.col(c).cast("string")


# --- roles ------------------------------------------------------------------


def inventory(t: Tables) -> DataFrame:
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        text("c_custkey").alias("repo_id"),
        F.col("c_name").alias("repo_name"),
        F.col("c_mktsegment").alias("project_key"),
        F.concat(F.lit("slug-"), text("c_custkey")).alias("repo_slug"),
        F.concat(F.lit("app-"), text("n_regionkey")).alias("app_id"),
        F.col("n_name").alias("host_name"),
        F.lit(None).cast("string").alias("tc_cluster"),
        F.concat(F.lit("tc-"), text("c_nationkey")).alias("tc"),
        F.concat(F.lit("git@github.com:org/"), text("c_custkey"), F.lit(".git")).alias("clone_url_ssh"),
        F.concat(F.lit("https://github.com/org/"), text("c_custkey")).alias("browse_url"),
        F.when(F.col("c_acctbal") < 0, "ERROR").when(F.col("c_acctbal") < 5000, "SUCCESS").alias("status"),
        F.lit("old").alias("comment"),
        F.to_timestamp(F.lit("2001-01-01 12:30:00")).alias("updated_on"),
    )


_INVENTORY_SQL = """
  select c_custkey::varchar repo_id, c_name repo_name, c_mktsegment project_key,
         'slug-' || c_custkey repo_slug, 'app-' || n_regionkey app_id, n_name host_name,
         'tc-' || c_nationkey tc, 'git@github.com:org/' || c_custkey || '.git' clone_url_ssh,
         'https://github.com/org/' || c_custkey browse_url,
         case when c_acctbal < 0 then 'ERROR' when c_acctbal < 5000 then 'SUCCESS' end status
  from customer join nation on c_nationkey = n_nationkey"""


def commits(t: Tables) -> DataFrame:
    return t.orders.select(
        text("o_custkey").alias("repo_id"),
        F.col("o_orderpriority").alias("author_email"),
        F.col("o_orderdate").cast("timestamp").alias("committed_at"),
    )


def combined(t: Tables) -> DataFrame:
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_name").alias("repo_id"),
        F.col("n_name").alias("host_name"),
        F.when(F.col("c_acctbal") >= 2500, "ACTIVE").otherwise("INACTIVE").alias("activity_status"),
        F.when(F.col("c_acctbal") < 0, "ERROR").otherwise("SUCCESS").alias("status"),
        F.concat(F.lit("tc-"), text("n_regionkey")).alias("tc"),
        F.initcap("c_mktsegment").alias("main_language"),
        F.lit("Small").alias("classification_label"),
        text("c_nationkey").alias("app_id"),
        F.col("c_nationkey").alias("number_of_contributors"),
        F.concat(F.lit("git@github.com:org/"), text("c_custkey")).alias("clone_url_ssh"),
        F.to_timestamp(F.lit("2001-01-01 00:00:00")).alias("updated_at"),
    )


_COMBINED_SQL = """
  select c_name repo_id, n_name host_name,
         case when c_acctbal >= 2500 then 'ACTIVE' else 'INACTIVE' end activity_status,
         case when c_acctbal < 0 then 'ERROR' else 'SUCCESS' end status,
         'tc-' || n_regionkey tc, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) main_language,
         'Small' classification_label, c_nationkey::varchar app_id,
         c_nationkey number_of_contributors, 'git@github.com:org/' || c_custkey clone_url_ssh,
         '2001-01-01' updated_on
  from customer join nation on c_nationkey = n_nationkey"""


def languages(t: Tables) -> DataFrame:
    """Share of ordered quantity per part type, for each supplier."""
    items = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    sums = items.groupBy(text("l_suppkey").alias("repo_id"), F.col("p_type").alias("language")).agg(
        F.sum("l_quantity").alias("q")
    )
    totals = sums.groupBy("repo_id").agg(F.sum("q").alias("total"))
    return sums.join(totals, "repo_id").select(
        "repo_id", "language", (F.col("q") * 100 / F.col("total")).alias("percent_usage")
    )


_LANGUAGES_SQL = """
  select repo_id, language, q * 100 / sum(q) over (partition by repo_id) percent_usage
  from (select l_suppkey::varchar repo_id, p_type as language, sum(l_quantity) q
        from lineitem join part on l_partkey = p_partkey group by all)"""


# --- selection --------------------------------------------------------------


def _selected(t: Tables, payload: dict) -> DataFrame:
    rows = selection.select_repositories(combined(t), payload)
    return rows.withColumn("updated_on", F.date_format("updated_on", "yyyy-MM-dd"))


@query(
    "q_payload_filter",
    f"""select distinct repo_id, status, clone_url_ssh, updated_on, host_name, activity_status, tc,
               main_language, classification_label, app_id, number_of_contributors
        from ({_COMBINED_SQL})
        where lower(host_name) in ('nation_1', 'nation_2', 'nation_7', 'nation_11')
          and lower(activity_status) = 'active' and number_of_contributors in (1, 2, 11, 99)
          and lower(main_language) in ('building', 'machinery', 'household')""",
)
def q_payload_filter(t: Tables) -> DataFrame:
    payload = {
        "host_name": ["nation_1", "Nation_2", "NATION_7", "NATION_11"],
        "activity_status": ["active"],
        "number_of_contributors": [1, 2, 11, 99],
        "main_language": ["BUILDING", "Machinery", "household"],
        "unknown_key": ["ignored"],
    }
    return _selected(t, {"payload": payload})


@query(
    "q_payload_repo_id",
    f"""select distinct repo_id, status, clone_url_ssh, updated_on, host_name, activity_status, tc,
               main_language, classification_label, app_id, number_of_contributors
        from ({_COMBINED_SQL}) where lower(repo_id) like '%r#0000_00%'""",
)
def q_payload_repo_id(t: Tables) -> DataFrame:
    return _selected(t, {"repo_id": ["R#0000_00", "only the first counts"]})


_PAGE = "select o_orderkey, o_custkey, o_orderstatus from orders order by o_orderkey"


@query("q_page", f"{_PAGE} limit 250 offset 500")
def q_page(t: Tables) -> DataFrame:
    return selection.page(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), 500, 250, "o_orderkey")


@query("q_page_deep", f"{_PAGE} limit 2000 offset 11000")
def q_page_deep(t: Tables) -> DataFrame:
    return selection.page(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), 11000, 2000, "o_orderkey")


@query(
    "q_batch_number",
    """select c_custkey::varchar repo_id, (row_number() over (order by c_custkey::varchar) - 1) // 100 + 1 batch_no
       from customer""",
)
def q_batch_number(t: Tables) -> DataFrame:
    return selection.number_batches(t.customer.select(text("c_custkey").alias("repo_id")), 100)


@query(
    "q_size_class",
    """select source || '/' || lang repo_id, sum(strlen(text)) * 1000 size_bytes,
              sum(length(text) - length(replace(text, chr(10), '')) + 1) total_loc,
              case when total_loc < 100 and size_bytes < 1000000 then 'Empty/Minimal'
                   when total_loc < 100 then 'Docs/Data' when size_bytes < 1000000 then 'Tiny'
                   when size_bytes < 10000000 then 'Small' when size_bytes < 100000000 then 'Medium'
                   when size_bytes < 1000000000 then 'Large' else 'Massive' end label
       from documents group by source, lang""",
)
def q_size_class(t: Tables) -> DataFrame:
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    sizes = t.documents.groupBy(F.concat("source", F.lit("/"), "lang").alias("repo_id")).agg(
        (F.sum(F.octet_length("text")) * 1000).alias("size_bytes"), F.sum(lines).alias("total_loc")
    )
    return sizes.withColumn("label", size_class(F.col("size_bytes"), F.col("total_loc")))


@query(
    "q_url_normalise",
    r"""with u as (
          select page_id, case page_id % 5
              when 0 then regexp_replace(url, '^https?://[^/]+/', 'https://github.com/')
              when 1 then regexp_replace(url, '^https?://[^/]+/', 'https://scm.example.com/scm/') || '.git'
              when 2 then regexp_replace(url, '^https?://[^/]+/', 'https://lab.example.com/group/')
              when 3 then 'git@' || url else url end clone_url,
            case page_id % 5 when 0 then 'github.com' when 1 then 'scm.example.com'
              when 2 then 'lab.example.com' when 3 then 'any' else 'other.example.com' end host
          from pages),
        m as (select *, regexp_replace(regexp_replace(clone_url, '\.git$', ''), '^https://[^/]+/', '') tail from u)
        select page_id,
          case when host = 'any' then clone_url
               when not starts_with(clone_url, 'https://') then null
               when host = 'github.com' and regexp_matches(clone_url, '^https://github\.com/([^/]+)/.+')
                 then 'git@github.com:' || tail || '.git'
               when host = 'scm.example.com' and regexp_matches(clone_url, '^https://[^/]+/scm/[^/]+/.+')
                 then 'ssh://git@scm.example.com:7999/' || substr(tail, 5) || '.git'
               when host = 'lab.example.com' and regexp_matches(clone_url, '^https://[^/]+/[^/]+(?:/[^/]+)*/.+')
                 then 'git@lab.example.com:' || tail || '.git' end ssh_url,
          case when host = 'any' then null
               when not starts_with(clone_url, 'https://') then 'Unsupported URL format: ' || clone_url
               when host = 'other.example.com'
                 then 'Unsupported host_name ''other.example.com'' for URL: ' || clone_url
               when host = 'github.com' and not regexp_matches(clone_url, '^https://github\.com/([^/]+)/.+')
                 then 'URL not recognized as a valid GitHub URL: ' || clone_url
               when host = 'scm.example.com' and not regexp_matches(clone_url, '^https://[^/]+/scm/[^/]+/.+')
                 then 'URL not recognized as a valid Bitbucket URL: ' || clone_url
               when host = 'lab.example.com'
                 and not regexp_matches(clone_url, '^https://[^/]+/[^/]+(?:/[^/]+)*/.+')
                 then 'URL not recognized as a valid GitLab URL: ' || clone_url end error
        from m""",
)
def q_url_normalise(t: Tables) -> DataFrame:
    kind, url = F.col("page_id") % 5, F.col("url")
    at = r"^https?://[^/]+/"
    clone = (
        F.when(kind == 0, F.regexp_replace(url, at, "https://github.com/"))
        .when(kind == 1, F.concat(F.regexp_replace(url, at, "https://scm.example.com/scm/"), F.lit(".git")))
        .when(kind == 2, F.regexp_replace(url, at, "https://lab.example.com/group/"))
        .when(kind == 3, F.concat(F.lit("git@"), url))
        .otherwise(url)
    )
    host = (
        F.when(kind == 0, "github.com")
        .when(kind == 1, "scm.example.com")
        .when(kind == 2, "lab.example.com")
        .when(kind == 3, "any")
        .otherwise("other.example.com")
    )
    urls = t.pages.select("page_id", clone.alias("clone"), host.alias("host"))
    ssh = ssh_clone_url(F.col("clone"), F.col("host"), "scm.example.com", "lab.example.com")
    return urls.select("page_id", ssh.alias("s")).select("page_id", F.col("s.url").alias("ssh_url"), "s.error")


# --- history ----------------------------------------------------------------


@query(
    "q_commit_stats",
    f"""with a as (select o_custkey, o_orderpriority, count(*) n, min(o_orderdate) f, max(o_orderdate) l
                   from orders group by all),
             r as (select *, row_number() over (partition by o_custkey order by n desc, o_orderpriority) rn from a)
        select o_custkey::varchar repo_id, sum(n)::bigint total_commits, count(*) number_of_contributors,
               case when date_diff('day', max(l), timestamp '{AS_OF}') > 365 then 'INACTIVE' else 'ACTIVE' end
                 activity_status,
               strftime(min(f), '%Y-%m-%d') first_commit_date, strftime(max(l), '%Y-%m-%d') last_commit_date,
               date_diff('day', min(f), timestamp '{AS_OF}') repo_age_days, max(n) top_contributor_commits,
               (sum(n) filter (rn <= 3))::bigint commits_by_top_3_contributors
        from r group by o_custkey""",
)
def q_commit_stats(t: Tables) -> DataFrame:
    stats = history.commit_stats(commits(t), AS_OF)
    for c in ("first_commit_date", "last_commit_date"):
        stats = stats.withColumn(c, F.date_format(c, "yyyy-MM-dd"))
    return stats


@query(
    "q_contributor_topk",
    """with a as (select o_custkey::varchar repo_id, o_orderpriority author_email, count(*) n
                 from orders group by all)
       select *, row_number() over (partition by repo_id order by n desc, author_email) as "rank" from a
       qualify "rank" <= 3""",
)
def q_contributor_topk(t: Tables) -> DataFrame:
    top = history.top_contributors(history.commits_by_author(commits(t)), 3)
    return top.select("repo_id", "author_email", "n", "rank")


@query(
    "q_recent_dates",
    f"""select o_custkey::varchar repo_id, count(*) n,
               strftime(min(o_orderdate), '%Y-%m-%d') oldest, strftime(max(o_orderdate), '%Y-%m-%d') newest,
               string_agg(strftime(o_orderdate, '%Y-%m-%d'), ',' order by o_orderdate desc) dates
        from orders where o_orderdate >= timestamp '{AS_OF}' - interval 365 days group by o_custkey""",
)
def q_recent_dates(t: Tables) -> DataFrame:
    whole = whole_lists(history.recent_commit_dates(commits(t), AS_OF, 5), "dates")
    days = F.transform(F.reverse("dates"), lambda d: F.date_format(d, "yyyy-MM-dd"))
    return whole.select(
        "repo_id",
        F.size(days).cast("bigint").alias("n"),
        F.array_min(days).alias("oldest"),
        F.array_max(days).alias("newest"),
        F.array_join(days, ",").alias("dates"),
    )


@query(
    "q_recent_commit_share",
    f"""select o_custkey::varchar repo_id, count(*) filter (o_orderdate >= timestamp '{AS_OF}' - interval 365 days)
               recent, count(*) total from orders group by o_custkey""",
)
def q_recent_commit_share(t: Tables) -> DataFrame:
    recent = F.count_if(is_recent(F.col("committed_at"), AS_OF))
    return commits(t).groupBy("repo_id").agg(recent.alias("recent"), F.count(F.lit(1)).alias("total"))


@query(
    "q_repo_metrics",
    f"""with a as (select o_custkey, o_orderpriority, count(*) n, min(o_orderdate) f, max(o_orderdate) l
                   from orders group by all),
             c as (select o_custkey, sum(n)::bigint total_commits, max(n) top1, max(l) l from a group by all),
             s as (select o_custkey, sum(l_quantity) all_bytes,
                          coalesce(sum(l_quantity) filter (l_returnflag <> 'R'), 0) code_bytes,
                          count(*) filter (l_returnflag <> 'R') files
                   from lineitem join orders on l_orderkey = o_orderkey group by all),
             b as (select o_custkey, count(*) branches from orders where o_orderstatus = 'O' group by all)
        select o_custkey::varchar repo_id, coalesce(all_bytes, 0)::double repo_size_bytes,
               coalesce(code_bytes, 0)::double code_size_bytes, coalesce(files, 0) file_count, total_commits,
               coalesce(branches, 0) active_branch_count, top1 top_contributor_commits
        from c left join s using (o_custkey) left join b using (o_custkey)""",
)
def q_repo_metrics(t: Tables) -> DataFrame:
    items = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    folder = F.when(F.col("l_returnflag") == "R", ".git/objects/").otherwise("src/")
    files = items.select(
        text("o_custkey").alias("repo_id"),
        F.concat(folder, text("l_partkey")).alias("path"),
        F.col("l_quantity").cast("bigint").alias("size"),
        F.lit(None).cast("string").alias("content"),
    )
    branches = t.orders.where(F.col("o_orderstatus") == "O").select(
        text("o_custkey").alias("repo_id"), text("o_orderkey").alias("ref")
    )
    metrics = history.repo_metrics(commits(t), files, branches, AS_OF)
    return metrics.select(
        "repo_id",
        "repo_size_bytes",
        "code_size_bytes",
        F.col("file_count").cast("bigint").alias("file_count"),
        F.col("total_commits").cast("bigint").alias("total_commits"),
        F.col("active_branch_count").cast("bigint").alias("active_branch_count"),
        F.col("top_contributor_commits").cast("bigint").alias("top_contributor_commits"),
    )


# --- languages --------------------------------------------------------------


@query(
    "q_main_language",
    f"""select repo_id, language main_language, format('{{:.6f}}', percent_usage) percent
        from ({_LANGUAGES_SQL})
        qualify row_number() over (partition by repo_id order by percent_usage desc, language) = 1""",
)
def q_main_language(t: Tables) -> DataFrame:
    main = selection.main_languages(languages(t))
    return main.select("repo_id", "main_language", F.format_string("%.6f", "percent_usage").alias("percent"))


@query(
    "q_language_gate",
    f"""with m as (select repo_id, language from ({_LANGUAGES_SQL})
                   qualify row_number() over (partition by repo_id order by percent_usage desc, language) = 1)
        select s_suppkey::varchar repo_id, s_name
        from supplier semi join m on s_suppkey::varchar = repo_id and lower(language) in ('medium', 'promo', 'small')
        where s_suppkey::varchar in (select repo_id from m where language in ('MEDIUM', 'PROMO'))""",
)
def q_language_gate(t: Tables) -> DataFrame:
    repos = t.supplier.select(text("s_suppkey").alias("repo_id"), "s_name")
    main = selection.main_languages(languages(t))
    return selection.gate_by_language(
        repos, main, [" Medium", "promo ", "SMALL"], exact_top=["MEDIUM", "PROMO", "small"]
    )


@query(
    "q_ruleset_lookup",
    """select source repo_id, string_agg(distinct p, ',' order by p) rulesets
       from (select source, case lang when 'en' then 'ruby' when 'fr' then 'csharp' when 'de' then 'bash' end p
             from documents) where p is not null group by source""",
)
def q_ruleset_lookup(t: Tables) -> DataFrame:
    spoken = {"en": "HTML+ERB", "fr": "Classic ASP", "de": "Batchfile", "es": "no such language"}
    table = F.create_map(*[F.lit(x) for pair in spoken.items() for x in pair])
    detected = t.documents.select(F.col("source").alias("repo_id"), table[F.col("lang")].alias("language"))
    sets = selection.repository_rulesets(detected, RULESET_PATHS)
    return sets.select("repo_id", F.array_join("rulesets", ",").alias("rulesets"))


# --- status -----------------------------------------------------------------


def execution_log(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    state = F.when(kind == "error", "FAILURE").when(kind == "purchase", "PROCESSING").when(
        (kind == "view") & (F.col("value") < 3), "OTHER"
    )
    return t.events.select(
        F.lit("run_analysis").alias("method_name"),
        kind.alias("stage"),
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
        text("user_id").alias("repo_id"),
        state.otherwise("SUCCESS").alias("status"),
        F.col("props").alias("message"),
        F.col("ts").cast("timestamp").alias("execution_time"),
        F.col("value").alias("duration"),
    )


_ROLLUP_SQL = """
  select run_id, repo_id,
         case when n = 0 then 'ERROR' when failed then 'FAILURE' when good = n then 'SUCCESS' else 'UNKNOWN' end status,
         case when n = 0 then 'No analysis records.' when good = n then 'All steps completed.' end as comment
  from (select strftime(ts, '%Y-%m-%d') run_id, user_id::varchar repo_id,
               count(*) filter (event_type <> 'purchase') n, bool_or(event_type = 'error') failed,
               count(*) filter (event_type not in ('purchase', 'error')
                                and not (event_type = 'view' and value < 3)) good
        from events group by all)"""


@query("q_status_rollup", _ROLLUP_SQL)
def q_status_rollup(t: Tables) -> DataFrame:
    return status.rollup_status(execution_log(t))


@query(
    "q_status_update",
    f"""with i as ({_INVENTORY_SQL}), r as (select * from ({_ROLLUP_SQL}) where run_id = '2024-01-15'),
        s as (select repo_id, coalesce(r.status, 'ERROR') status,
                     case when r.run_id is null then 'No analysis records.' else r.comment end as comment
              from i left join r using (repo_id))
        select repo_id, s.status, coalesce(s.comment, 'old') as comment, '2024-01-16' updated_on from s""",
)
def q_status_update(t: Tables) -> DataFrame:
    repos = inventory(t)
    log = execution_log(t).where(F.col("run_id") == "2024-01-15")
    rollup = status.rollup_status(log, repos.select(F.lit("2024-01-15").alias("run_id"), "repo_id"))
    updated = status.update_inventory_status(repos, rollup, "2024-01-16 00:00:00")
    return updated.select("repo_id", "status", "comment", F.date_format("updated_on", "yyyy-MM-dd").alias("updated_on"))


@query(
    "q_log_append",
    """select stage, status, count(*) n from (
         select event_type stage, case when event_type = 'error' then 'FAILURE'
                 when event_type = 'purchase' then 'PROCESSING'
                 when event_type = 'view' and value < 3 then 'OTHER' else 'SUCCESS' end status from events
         union all
         select 'Late', case when c_acctbal < 0 then 'FAILURE' else 'SUCCESS' end from customer) group by all""",
)
def q_log_append(t: Tables) -> DataFrame:
    outcomes = t.customer.select(
        text("c_custkey").alias("repo_id"),
        F.col("c_name").alias("message"),
        F.when(F.col("c_acctbal") < 0, "negative").alias("error"),
        F.lit(0.5).alias("duration"),
    )
    rows = status.execution_log_rows(outcomes, "run_analysis", "Late", "r1", AS_OF)
    log = execution_log(t).unionByName(rows)
    return log.groupBy("stage", "status").agg(F.count(F.lit(1)).alias("n"))


# --- keyed merges -----------------------------------------------------------


def _halves(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = t.orders.select(
        text("o_custkey").alias("repo_id"),
        "o_orderkey",
        F.col("o_orderstatus").alias("state"),
    )
    old = rows.where(F.col("o_orderkey") % 2 == 0)
    new = rows.where(F.col("o_orderkey") % 2 == 1)
    return old, new


_HALVES = """with o as (select o_custkey::varchar repo_id, o_orderkey, o_orderstatus state from orders),
  old as (select * from o where o_orderkey % 2 = 0),
  new as (select * from o where o_orderkey % 2 = 1)"""


@query(
    "q_replace_by_key",
    f"""{_HALVES}, seen as (select repo_id from o where o_orderkey % 2 = 1)
        select * from old where repo_id not in (select repo_id from seen) union all select * from new""",
)
def q_replace_by_key(t: Tables) -> DataFrame:
    old, new = _halves(t)
    processed = t.orders.where(F.col("o_orderkey") % 2 == 1).select(text("o_custkey").alias("repo_id"))
    return replace_by_key(old, new, processed, "clear")


@query(
    "q_replace_keep_empty",
    f"""{_HALVES} select * from old where repo_id not in (select repo_id from new) union all select * from new""",
)
def q_replace_keep_empty(t: Tables) -> DataFrame:
    old, new = _halves(t)
    processed = t.orders.where(F.col("o_orderkey") % 2 == 1).select(text("o_custkey").alias("repo_id"))
    return replace_by_key(old, new, processed, "keep")


def _tools(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = t.lineitem.select(
        text("l_suppkey").alias("repo_id"),
        F.col("l_returnflag").alias("tool"),
        F.when(F.col("l_linenumber") < 6, text("l_linenumber")).alias("tool_version"),
        F.substring("l_linestatus", 1, 1).alias("runtime_version"),
        "l_linestatus",
    )
    old = rows.where(F.col("l_linestatus") == "O").drop("l_linestatus").distinct()
    new = rows.drop("l_linestatus")
    return old, new


_TOOLS = """with r as (select l_suppkey::varchar repo_id, l_returnflag tool,
    case when l_linenumber < 6 then l_linenumber::varchar end tool_version, l_linestatus runtime_version
    from lineitem),
  old as (select distinct repo_id, tool, tool_version, runtime_version from r where runtime_version = 'O'),
  new as (select repo_id, tool, tool_version, runtime_version from r)"""
_TOOL_KEY = ["repo_id", "tool", "tool_version", "runtime_version"]


@query(
    "q_insert_ignore",
    f"""{_TOOLS} select * from old
        union all select distinct n.* from new n anti join old o on n.repo_id = o.repo_id and n.tool = o.tool
          and n.tool_version = o.tool_version and n.runtime_version = o.runtime_version
          where n.tool_version is not null
        union all select * from new where tool_version is null""",
)
def q_insert_ignore(t: Tables) -> DataFrame:
    old, new = _tools(t)
    return insert_ignore(old, new, _TOOL_KEY)


@query("q_insert_ignore_null_safe", f"{_TOOLS} select * from old union select * from new")
def q_insert_ignore_null_safe(t: Tables) -> DataFrame:
    old, new = _tools(t)
    return insert_ignore(old, new, _TOOL_KEY, null_safe=True)


@query(
    "q_upsert",
    """select c_custkey::varchar repo_id,
              case when c_acctbal > 0 then '{"balance":"positive","segment":"' || c_mktsegment || '"}'
                   else c_name end profile_json from customer""",
)
def q_upsert(t: Tables) -> DataFrame:
    repo = text("c_custkey").alias("repo_id")
    old = t.customer.select(repo, F.col("c_name").alias("profile_json"))
    document = F.to_json(F.struct(F.lit("positive").alias("balance"), F.col("c_mktsegment").alias("segment")))
    new = t.customer.where(F.col("c_acctbal") > 0).select(repo, document.alias("profile_json"))
    return upsert(old, new)


@query(
    "q_last_writer",
    """select user_id::varchar repo_id, event_type section, event_id, props from events
       qualify row_number() over (partition by user_id, event_type order by event_id desc) = 1""",
)
def q_last_writer(t: Tables) -> DataFrame:
    rows = t.events.select(text("user_id").alias("repo_id"), F.col("event_type").alias("section"), "event_id", "props")
    return last_writer_wins(rows, ["repo_id", "section"], ["event_id"])


# --- derived tables ---------------------------------------------------------


def combined_inputs(t: Tables) -> dict[str, DataFrame]:
    metrics = history.commit_stats(commits(t), AS_OF).select(
        "repo_id",
        "activity_status",
        "number_of_contributors",
        (F.col("total_commits") * 400000).cast("double").alias("repo_size_bytes"),
        F.lit(None).cast("timestamp").alias("updated_at"),
    )
    spoken = t.orders.groupBy(text("o_custkey").alias("repo_id"), F.col("o_orderpriority").alias("language")).agg(
        F.count(F.lit(1)).cast("double").alias("percent_usage")
    )
    cloc = t.orders.select(text("o_custkey").alias("repo_id"), (F.col("o_orderkey") % 50).cast("int").alias("code"))
    return {"inventory": inventory(t), "metrics": metrics, "languages": spoken, "cloc": cloc}


def _combined_from_tables(t: Tables) -> DataFrame:
    return derived.combined_repo_metrics(**combined_inputs(t))


_COMBINED_FULL = f"""
  with i as ({_INVENTORY_SQL}),
  a as (select o_custkey::varchar repo_id, o_orderpriority p, count(*) n, max(o_orderdate) l,
               sum(o_orderkey % 50) loc from orders group by all),
  m as (select repo_id, sum(n) total, count(*) authors, max(l) l, sum(loc)::bigint loc from a group by all),
  w as (select repo_id, p from a qualify row_number() over (partition by repo_id order by n desc, p) = 1),
  c as (select i.repo_id, host_name,
        case when l is null then null when date_diff('day', l, timestamp '{AS_OF}') > 365 then 'INACTIVE'
             else 'ACTIVE' end activity_status,
        status, tc, p main_language,
        case when coalesce(loc, 0) < 100 and coalesce(total, 0) * 400000 < 1000000 then 'Empty/Minimal'
             when coalesce(loc, 0) < 100 then 'Docs/Data' when total * 400000 < 1000000 then 'Tiny'
             when total * 400000 < 10000000 then 'Small' else 'Medium' end classification_label,
        app_id, authors number_of_contributors, clone_url_ssh
  from i left join m using (repo_id) left join w using (repo_id))"""


@query("q_combined_metrics", f"{_COMBINED_FULL} select * from c")
def q_combined_metrics(t: Tables) -> DataFrame:
    rows = _combined_from_tables(t).drop("updated_at")
    return rows.withColumn("number_of_contributors", F.col("number_of_contributors").cast("bigint"))


@query(
    "q_late_columns",
    f"""{_COMBINED_FULL} select c.repo_id, c.main_language, i.repo_name, i.project_key, i.repo_slug, i.browse_url
        from c join i using (repo_id) where lower(activity_status) = 'active'""",
)
def q_late_columns(t: Tables) -> DataFrame:
    chosen = selection.select_repositories(_combined_from_tables(t), {"activity_status": ["Active"]}, ordered=False)
    full = derived.with_inventory_columns(chosen, inventory(t))
    return full.select("repo_id", "main_language", "repo_name", "project_key", "repo_slug", "browse_url")


@query(
    "q_fetch_repositories",
    f"""{_COMBINED_FULL} select i.repo_id, repo_name, repo_slug, host_name, c.status, project_key,
          (row_number() over (order by i.repo_id) - 1) // 70 + 1 batch_no
        from c join (select repo_id, repo_name, repo_slug, project_key from i) i using (repo_id)
        where lower(main_language) in ('1-urgent', '2-high') and lower(status) = 'success'""",
)
def q_fetch_repositories(t: Tables) -> DataFrame:
    payload = {"payload": {"main_language": ["1-urgent", "2-HIGH"], "status": ["Success"]}}
    rows = derived.fetch_repositories(_combined_from_tables(t), inventory(t), payload, 70)
    return rows.select("repo_id", "repo_name", "repo_slug", "host_name", "status", "project_key", "batch_no")


@query(
    "q_component_map",
    f"""select s_suppkey component_id, s_name component_name, project_key, repo_slug, repo_id, app_id
        from supplier join ({_INVENTORY_SQL}) i on i.repo_slug = 'slug-' || s_suppkey and i.project_key = 'MACHINERY'""",
)
def q_component_map(t: Tables) -> DataFrame:
    components = t.supplier.select(
        F.col("s_suppkey").alias("component_id"),
        F.col("s_name").alias("component_name"),
        F.lit("MACHINERY").alias("project_key"),
        F.concat(F.lit("slug-"), text("s_suppkey")).alias("repo_slug"),
    )
    joined = derived.component_repositories(components, inventory(t))
    return joined.select("component_id", "component_name", "project_key", "repo_slug", "repo_id", "app_id")
