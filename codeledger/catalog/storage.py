"""Sources and sinks end to end: written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeledger import schemas
from codeledger.catalog.portfolio import (
    _COMBINED_FULL,
    _HALVES,
    _ROLLUP_SQL,
    _TOOL_KEY,
    _TOOLS,
    _halves,
    _tools,
    combined_inputs,
    execution_log,
    text,
)
from codeledger.catalog.registry import Tables, query
from codeledger.operators import reports as r
from codeledger.operators.history import size_totals
from codeledger.plans import derived
from codeledger.plans.refresh import IncrementalTable
from codeledger.session import ensure_checkpoint_dir
from codeledger.sinks.pages import paged
from codeledger.sinks.tables import DerivedTable, KeyedTable
from codeledger.sources.files import read_repo_files
from codeledger.sources.reports import read_reports, write_report_files
from codeledger.streaming.ingest import ReportIngest, report_table_stream
from codeledger.streaming.status import StatusStream, log_table_stream


def folder(t: Tables, name: str) -> str:
    """A new folder that all executors share."""
    return f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/codeledger-{name}-{uuid.uuid4().hex}"


@query(
    "q_file_corpus",
    """select 'repo-' || (page_id % 20) repo_id, (sum(strlen(html) + 1))::bigint repo_size_bytes,
              sum(len(regexp_extract_all(html, '<h1>')))::bigint headings from pages group by all""",
)
def q_file_corpus(t: Tables) -> DataFrame:
    root = folder(t, "corpus")
    repo = F.concat(F.lit("repo-"), (F.col("page_id") % 20).cast("string")).alias("repo_id")
    t.pages.select(repo, "html").write.option("maxRecordsPerFile", 1000).partitionBy("repo_id").text(root)
    files = read_repo_files(t.spark, root, "*.txt")
    sizes = size_totals(files).select("repo_id", "repo_size_bytes")
    headings = files.groupBy("repo_id").agg(F.sum(F.regexp_count("content", F.lit("<h1>"))).alias("headings"))
    return sizes.join(headings, "repo_id")


def _vulnerabilities(*ids: Column) -> Column:
    found = F.array(*[F.struct(i.alias("VulnerabilityID"), F.lit("HIGH").alias("Severity")) for i in ids])
    result = F.struct(F.lit("pom.xml").alias("Target"), found.alias("Vulnerabilities"))
    return F.to_json(F.struct(F.array(result).alias("Results")))


def _matches(*ids: Column) -> Column:
    found = [F.struct(F.struct(i.alias("id")).alias("vulnerability")) for i in ids]
    return F.to_json(F.struct(F.array(*found).alias("matches")))


def _cve(prefix: str) -> Column:
    return F.concat(F.lit(prefix), text("s_suppkey"))


@query(
    "q_report_files",
    """select s_suppkey::varchar repo_id, p || s_suppkey vulnerability_id, 'pom.xml' target
       from supplier, (values ('CVE-a-'), ('CVE-b-')) v(p)""",
)
def q_report_files(t: Tables) -> DataFrame:
    root = folder(t, "reports")
    body = _vulnerabilities(_cve("CVE-a-"), _cve("CVE-b-"))
    reports = t.supplier.select(F.lit("trivy").alias("tool"), text("s_suppkey").alias("repo_id"), body.alias("body"))
    write_report_files(reports, root)
    return r.parse_trivy(read_reports(t.spark, root)).select("repo_id", "vulnerability_id", "target")


@query(
    "q_incremental_ingest",
    """with s as (select s_suppkey k, s_suppkey::varchar repo_id from supplier)
       select repo_id, 'trivy' tool, 'CVE-1-' || k finding from s where k % 3 <> 0
       union all select repo_id, 'trivy', 'CVE-1b-' || k from s where k % 3 <> 0
       union all select repo_id, 'trivy', 'CVE-2-' || k from s where k % 3 = 0 and k % 2 = 1
       union all select repo_id, 'grype', 'CVE-1-' || k from s where k % 3 <> 0 or k % 2 = 0
       union all select repo_id, 'grype', 'CVE-2-' || k from s where k % 3 = 0 and k % 2 = 1""",
)
def q_incremental_ingest(t: Tables) -> DataFrame:
    """Two deliveries: the second replaces a third of the repositories, partly with nothing."""
    incoming, tables, checkpoint = (folder(t, n) for n in ("incoming", "tables", "ingest"))
    ingest = ReportIngest(t.spark, tables)

    def deliver(suppliers: DataFrame, tool: str, body: Column, day: str) -> DataFrame:
        return suppliers.select(
            text("s_suppkey").alias("repo_id"),
            F.lit(tool).alias("tool"),
            body.alias("body"),
            F.to_timestamp(F.lit(day)).alias("modified"),
        )

    again = t.supplier.where(F.col("s_suppkey") % 3 == 0)
    odd = F.col("s_suppkey") % 2 == 1
    new, none = _vulnerabilities(_cve("CVE-2-")), F.lit('{"Results": []}')
    new_match, no_match = _matches(_cve("CVE-2-")), F.lit('{"matches": []}')
    first = [
        deliver(t.supplier, "trivy", _vulnerabilities(_cve("CVE-1-"), _cve("CVE-1b-")), "2024-01-01"),
        deliver(t.supplier, "grype", _matches(_cve("CVE-1-")), "2024-01-01"),
    ]
    second = [
        deliver(again, "trivy", F.lit("{broken"), "2024-01-02"),
        deliver(again, "trivy", F.when(odd, new).otherwise(none), "2024-01-03"),
        deliver(again, "grype", F.when(odd, new_match).otherwise(no_match), "2024-01-03"),
    ]
    for delivery in (first, second):
        for reports in delivery:
            reports.write.mode("append").parquet(incoming)
        ingest.start(report_table_stream(t.spark, incoming), checkpoint).awaitTermination()
    trivy, grype = ingest.table("trivy").read(), ingest.table("grype").read()
    return trivy.select(
        "repo_id", F.lit("trivy").alias("tool"), F.col("vulnerability_id").alias("finding")
    ).unionByName(grype.select("repo_id", F.lit("grype").alias("tool"), F.col("cve").alias("finding")))


@query("q_status_stream", _ROLLUP_SQL)
def q_status_stream(t: Tables) -> DataFrame:
    """The log in three deliveries, out of order and a third of it twice, each read by a stream started anew."""
    log = execution_log(t)
    incoming, root, checkpoint = (folder(t, n) for n in ("log", "status", "status-checkpoint"))
    delivery = F.pmod(F.xxhash64(*log.columns), F.lit(3))
    statuses = StatusStream(t.spark, root, delay="3650 days")
    for batch in range(3):
        log.where((delivery == batch) | (delivery == (batch + 1) % 3)).write.mode("append").parquet(incoming)
        statuses.start(log_table_stream(t.spark, incoming), checkpoint).awaitTermination()
    return statuses.rollup()


@query(
    "q_page_by_range",
    "select o_orderkey, o_custkey, o_orderstatus from orders order by o_orderkey limit 2000 offset 11000",
)
def q_page_by_range(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    return paged(orders, folder(t, "pages"), "o_orderkey", part_rows=2_500).page(11_000, 2_000)


@query(
    "q_late_reports",
    """with d as (select s_suppkey k, unnest([0, 1, 2]) batch from supplier),
       r as (select k, batch, case batch when 0 then 10 when 1 then 5 + k % 11 else 8 + k % 5 end as day from d where batch = 0 or k % (batch + 1) = 0)
       select k::varchar repo_id, 'CVE-' || batch || '-' || k finding from r
       qualify row_number() over (partition by k order by day desc, batch desc) = 1""",
)
def q_late_reports(t: Tables) -> DataFrame:
    """Three deliveries, each read by a stream started anew; many reports are older than the stored ones."""
    incoming, tables, checkpoint = (folder(t, n) for n in ("incoming", "tables", "ingest"))
    key = F.col("s_suppkey")
    for batch, day in enumerate((F.lit(10), 5 + key % 11, 8 + key % 5)):
        t.supplier.where(key % (batch + 1) == 0).select(
            text("s_suppkey").alias("repo_id"),
            F.lit("trivy").alias("tool"),
            _vulnerabilities(_cve(f"CVE-{batch}-")).alias("body"),
            F.make_timestamp(F.lit(2024), F.lit(1), day.cast("int"), F.lit(0), F.lit(0), F.lit(0)).alias("modified"),
        ).write.mode("append").parquet(incoming)
        ReportIngest(t.spark, tables).start(report_table_stream(t.spark, incoming), checkpoint).awaitTermination()
    stored = ReportIngest(t.spark, tables).table("trivy").read()
    return stored.select("repo_id", F.col("vulnerability_id").alias("finding"))


@query(
    "q_keyed_table",
    f"""{_HALVES}, seen as (select repo_id from o where o_orderkey % 2 = 1)
        select * from old where repo_id not in (select repo_id from seen) union all select * from new""",
)
def q_keyed_table(t: Tables) -> DataFrame:
    old, new = _halves(t)
    processed = t.orders.where(F.col("o_orderkey") % 2 == 1).select(text("o_custkey").alias("repo_id"))
    table = KeyedTable(t.spark, folder(t, "keyed"), "repo_id string, o_orderkey bigint, state string")
    table.append(old)
    for _ in range(2):  # repeating the write changes nothing
        table.replace(new, processed, "clear")
    return table.read()


@query(
    "q_keyed_insert",
    f"""{_TOOLS} select * from old
        union all select distinct n.* from new n anti join old o on n.repo_id = o.repo_id and n.tool = o.tool
          and n.tool_version = o.tool_version and n.runtime_version = o.runtime_version
          where n.tool_version is not null
        union all select * from new where tool_version is null
        union all select * from new where tool_version is null""",
)
def q_keyed_insert(t: Tables) -> DataFrame:
    old, new = _tools(t)
    table = KeyedTable(t.spark, folder(t, "tools"), schemas.BUILD_TOOLS)
    for rows in (old, new, new):
        table.insert_ignore(rows, _TOOL_KEY)
    return table.read()


@query(
    "q_refresh_table",
    "select l_suppkey::varchar repo_id, count(distinct l_orderkey) n from lineitem group by all",
)
def q_refresh_table(t: Tables) -> DataFrame:
    table = DerivedTable(t.spark, folder(t, "derived"))
    for n in (F.count(F.lit(1)), F.countDistinct("l_orderkey")):
        table.refresh(t.lineitem.groupBy(text("l_suppkey").alias("repo_id")).agg(n.alias("n")))
    return table.read()


@query(
    "q_incremental_refresh",
    f"""{_COMBINED_FULL} select c.*,
          case when repo_id::bigint % 5 = 0 and number_of_contributors is not null then 2 when repo_id::bigint % 7 = 0 then 1 else 0 end as refresh from c""",
)
def q_incremental_refresh(t: Tables) -> DataFrame:
    """Three refreshes: in the second a seventh of the inventory is new, in the third a fifth has other metrics."""
    inputs = combined_inputs(t)
    number = F.col("repo_id").cast("bigint")
    older = {**inputs, "metrics": inputs["metrics"].withColumn("number_of_contributors", F.when(number % 5 == 0, -1).otherwise(F.col("number_of_contributors")))}
    gone = {name: df.where(number % 7 != 0) for name, df in older.items()}
    extra = gone["inventory"].limit(1).withColumn("repo_id", F.lit("999999999"))  # a repository that is dropped later
    gone["inventory"] = gone["inventory"].unionByName(extra)
    # a repository without metrics has nothing that changes in the third
    table = IncrementalTable(DerivedTable(t.spark, folder(t, "incremental")), lambda i: derived.combined_repo_metrics(**i))
    for state in (gone, older, inputs):
        table.refresh(state)
    rows = table.read(with_refresh=True).withColumnRenamed("_refresh", "refresh").drop("updated_at")
    return rows.withColumn("number_of_contributors", F.col("number_of_contributors").cast("bigint"))


@query(
    "q_keyed_foreign_keys",
    """select o_custkey k, o_orderkey v from orders where o_custkey % 3 = 0
       union all select o_custkey, -o_orderkey from orders where o_custkey % 3 = 2
       union all select -c_custkey - 1, c_custkey from customer""",
)
def q_keyed_foreign_keys(t: Tables) -> DataFrame:
    """New rows of keys that were not processed, a bigint key given as text, and keys that end empty."""
    table = KeyedTable(t.spark, folder(t, "foreign"), "k bigint, v bigint", key="k")
    rows = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"))
    table.append(rows)
    new = rows.where("k % 3 = 2").select("k", (-F.col("v")).alias("v"))
    unseen = t.customer.select((-F.col("c_custkey") - 1).alias("k"), F.col("c_custkey").alias("v"))
    processed = t.customer.where("c_custkey % 3 = 1").select(text("c_custkey").alias("k"))
    for _ in range(2):  # a repeated batch is stored once
        table.replace(new.unionByName(unseen), processed, label="batch-1")
    table.compact()
    return table.read()


@query(
    "q_upsert_table",
    """select c_custkey::varchar repo_id,
              case when c_acctbal > 0 then c_mktsegment else c_name end profile_json from customer""",
)
def q_upsert_table(t: Tables) -> DataFrame:
    table = KeyedTable(t.spark, folder(t, "cache"), schemas.PROFILE_CACHE)
    repo = text("c_custkey").alias("repo_id")
    table.upsert(t.customer.select(repo, F.col("c_name").alias("profile_json")))
    table.upsert(t.customer.where("c_acctbal > 0").select(repo, F.col("c_mktsegment").alias("profile_json")))
    return table.read()
