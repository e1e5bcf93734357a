"""WARC archives of pages, and their index merged from sorted runs.

Archives are written by Spark, a file or more per partition, and read back.  The
records of an archive, sorted by URL key and time, are a capture run.  Ranges of
(URL key, time, page) are dealt to tasks; each task merges its piece of every
run with a loser tree, so the pieces in order are the capture history of all URLs.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeledger.llm.tables import pieces
from codeledger.session import checkpointed, ensure_checkpoint_dir

#: Bytes in an archive on average, and index rows in a range of the merge.
ARCHIVE_BYTES = 32 << 20
RANGE_ROWS = 100_000
#: What the decisions on revisits may hold to be broadcast, and bytes of one.
BROADCAST_BYTES = 64 << 20
DECISION_BYTES = 128
#: Shorter payloads are always stored in full.
LEAST_REVISIT = 100
#: Pages without a time were captured a second apart, by page id, from here.
EPOCH = "2024-01-01T00:00:00"
END_OF_RECORD = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = (
    "url_key string, captured string, page_id long, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, archive string, offset long, length long"
)
NAMES = [part.split()[0] for part in INDEX.split(", ")]


def write_archives(pages: DataFrame) -> str:
    """Write a record for each row of ``pages`` to the shared folder; returns its folder.

    The payload is the html in UTF-8; a null html is empty.  Of records with equal
    payloads of at least LEAST_REVISIT bytes, that with the least page_id is
    stored, the others refer to it.  A null page_id is later than any other; payloads
    of null ids only are all stored, and so are repeated rows of the least id.  A
    null url has no target.  ``captured``, if there is such a column, is the time in UTC.  Other
    columns are not written.  An empty table gives no records.
    """
    spark = pages.sparkSession
    html = F.coalesce(F.col("html"), F.lit(""))
    captured = F.col("captured").cast("timestamp") if "captured" in pages.columns else _captured()
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        html.alias("html"),
        F.date_format(captured, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"),
        F.sha2(html, 256).alias("digest"),
    )
    size = rows.agg(F.avg(F.octet_length("html")).alias("n")).first()["n"] or 0
    rows = _decided(rows)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    # written where the join leaves them: an archive is a partition, or a piece of a large one
    writer = rows.select(_record().alias("record")).write.option("maxRecordsPerFile", max(1, int(ARCHIVE_BYTES / (size + 500))))
    writer.option("lineSep", END_OF_RECORD).text(folder)
    return folder


def _decided(rows: DataFrame) -> DataFrame:
    """``rows`` with ``first``, the id of the page that a revisit refers to.

    Decided on narrow rows, once per page, and written, so that the size is known before the join is planned: up to
    BROADCAST_BYTES go to the pages where they are, beyond that the pages are shuffled to them by id and digest.
    """
    keys = rows.select("page_id", F.unhex("digest").alias("digest"), F.octet_length("html").alias("n"))
    keys = keys.where(F.col("n") >= LEAST_REVISIT)
    stored = keys.groupBy("digest").agg(F.min("page_id").alias("first"))
    revisits = keys.join(stored, "digest").where("first is not null and (page_id is null or page_id > first)")
    revisits = checkpointed(revisits.select(F.col("page_id").alias("id"), F.col("digest").alias("same"), "first").distinct())
    if revisits.count() * DECISION_BYTES <= BROADCAST_BYTES:
        revisits = F.broadcast(revisits)
    same = F.col("page_id").eqNullSafe(F.col("id")) & (F.unhex("digest") == F.col("same"))
    return rows.join(revisits, same, "left").drop("id", "same")


def _captured() -> Column:
    return F.timestamp_seconds(F.unix_timestamp(F.lit(EPOCH).cast("timestamp")) + F.coalesce("page_id", F.lit(0)))


def _record() -> Column:
    """A row as the text of its record, without the record's end."""
    revisit = F.col("first").isNotNull()
    body = F.when(revisit, "").otherwise(F.col("html"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("html").cast("string"),
        F.lit("\r\n\r\n"),
    )

    def record_id(page: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(page).cast("string"), F.lit("")), F.lit(">"))

    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.when(revisit, "WARC-Type: revisit").otherwise("WARC-Type: response"),
        F.concat(F.lit("WARC-Record-ID: "), record_id("page_id")),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Date: "), F.col("captured")),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), record_id("first"))),
        F.when(revisit, f"WARC-Profile: {PROFILE}"),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), (F.octet_length(http) + F.octet_length(body)).cast("string")),
    )
    return F.concat(head, F.lit("\r\n\r\n"), http, body)


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The index of every archive, each sorted by URL key, time and page: a run per archive."""
    files = spark.read.format("binaryFile").load(folder).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                name = path.rpartition("/")[2]
                yield _batch(sorted(_records(content.as_py(), name), key=_order))

    return files.mapInArrow(run, INDEX)


def merged_index(runs: DataFrame) -> DataFrame:
    """All runs as one index: partitions in order, rows in order within each.

    The ranges are over key, time and page, so the captures of one URL may fill many of them.
    """
    runs = checkpointed(runs)
    ranges = pieces(runs.count(), RANGE_ROWS)
    dealt = runs.repartitionByRange(ranges, "url_key", "captured", "page_id")
    pieces_of_runs = dealt.sortWithinPartitions("archive", "url_key", "captured", "page_id")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_run: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in NAMES), strict=True):
                by_run.setdefault(row[NAMES.index("archive")], []).append(row)
        merged = loser_tree_merge(list(by_run.values()), _order)
        while rows := [row for _, row in zip(range(10_000), merged, strict=False)]:
            yield _batch(rows)

    return pieces_of_runs.mapInArrow(merge, INDEX)


def loser_tree_merge(runs: list[list[tuple]], key) -> Iterator[tuple]:
    """The rows of sorted ``runs`` in order; equal keys by run.

    Inner nodes hold the loser of the match below them; the winner of all stands at 0.
    Replacing a winner replays only the matches on its way up.
    """
    size = len(runs)
    at = [0] * size
    # (done, key, run): an exhausted run loses to all others
    heads = [(False, key(r[0]), i) if r else (True, None, i) for i, r in enumerate(runs)]

    def beats(a: int, b: int) -> bool:
        x, y = heads[a], heads[b]
        if x[0] or y[0]:
            return (x[0], x[2]) < (y[0], y[2])
        return x < y

    tree = [0] * max(1, size)
    winners = [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], tree[node] = (a, b) if beats(a, b) else (b, a)
    if size:
        tree[0] = winners[1] if size > 1 else 0
    while size and not heads[tree[0]][0]:
        run = tree[0]
        yield runs[run][at[run]]
        at[run] += 1
        heads[run] = (False, key(runs[run][at[run]]), run) if at[run] < len(runs[run]) else (True, None, run)
        node = (run + size) // 2
        while node:
            if beats(tree[node], run):
                tree[node], run = run, tree[node]
            node //= 2
        tree[0] = run


def _order(row: tuple) -> tuple:
    """Sort key of an index row, nulls first as Spark sorts them."""
    key, captured, page = row[0], row[1], row[2]
    return key is not None, key or "", captured is not None, captured or "", page is not None, page or 0


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    long = {"page_id", "payload_bytes", "refers_to", "offset", "length"}
    columns = zip(*rows, strict=True) if rows else [[]] * len(NAMES)
    kinds = [pa.int64() if n in long else pa.string() for n in NAMES]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], NAMES)


def _records(data: bytes, archive: str) -> Iterator[tuple]:
    """The index rows of an archive's records; digests of stored payloads are computed from them."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = _headers(data[at:end])
        body = data[end + 4 : end + 4 + int(head["content-length"])]
        http_end = body.index(b"\r\n\r\n") + 4
        revisit = head["warc-type"] == "revisit"
        payload = body[http_end:]
        http = _headers(body[:http_end])
        digest = head["warc-payload-digest"].partition(":")[2] if revisit else hashlib.sha256(payload).hexdigest()
        size = int(http["content-length"]) if revisit else len(payload)
        length = end + 4 - at + len(body) + len(END_OF_RECORD)
        key = url_key(head.get("warc-target-uri"))
        refers = _page(head["warc-refers-to"]) if revisit else None
        yield key, head["warc-date"], _page(head["warc-record-id"]), head["warc-type"], size, digest, refers, archive, at, length
        at += length


def _headers(data: bytes) -> dict[str, str]:
    lines = (line.partition(": ") for line in data.decode().split("\r\n")[1:])
    return {name.lower(): value for name, _, value in lines if name}


def _page(record_id: str) -> int | None:
    number = record_id.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def url_key(url: str | None) -> str | None:
    """The host's labels in reverse, then path and query: urls of a domain sort together."""
    found = re.match(r"[^:/?#]*://([^/?#]*)([^#]*)", url or "")
    if not found:
        return url
    labels = found[1].lower().split(".")
    if len(labels) > 1 and labels[0] == "www":
        labels = labels[1:]
    return f"{','.join(reversed(labels))}){found[2] or '/'}"
