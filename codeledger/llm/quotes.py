"""Quotations in messages, linked to the messages they quote.

Lines that begin with ``>`` are quotations, one level for each mark.  A passage is
a run of lines of one level; its normalised hash, and those of its lines, are
joined to the passages that messages say themselves.  What is left of a message
without its quotations, put in order of replies, is the conversation: every message
has its place in a walk through the tree of replies, found by doubling pointers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeledger.operators.selection import number_rows
from codeledger.session import checkpointed

MARKS = re.compile(r"(?:[ \t]{0,3}>)+")
#: How a line ends that announces the quotation below it, before its colon, and how such an announcement begins.
ANNOUNCES = ("wrote", "writes", "schrieb", "a écrit", "escribió")
BEGINS = re.compile(r"[ \t]*(?:On|Am|Le|El)[ \t]")
MAX_ROUNDS = 64

MESSAGE = "conv_id long, turn long, role string, body string, n_quotes int, max_level int, said array<long>, "
MESSAGE += "quotes array<struct<no:int,level:int,passage:long,lines:array<long>>>"


def link_quotes(messages: DataFrame) -> DataFrame:
    """The messages without quotations, each with the one it replies to.

    Returns conv_id, turn, role, body, n_quotes (quoted passages), n_linked,
    max_level, reply_conv, reply_turn, thread_conv, thread_turn, depth, position.  A passage
    belongs to the first message that says it: the first of its own conversation
    if that is earlier, else the first of all conversations with a smaller conv_id.
    The whole passage is looked up first, then its lines.  A message replies to the
    original of its first linked passage of the lowest level.  thread and depth lead
    to the message at the start of the chain of replies, itself without one.  position is
    the place in reply order, 0 for the start: after a message come its replies by conv_id
    and turn, each with all that follows it before the next.

    A null text is empty.  A message with a null conv_id or turn is linked to none.
    Repeated rows each give a row, and links are those of all rows with that
    conv_id and turn.  Other columns are not read.  Empty table: no rows.
    """
    rows = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    parsed = checkpointed(rows.mapInArrow(_parse, MESSAGE))
    linked = checkpointed(_linked(parsed))
    first = linked.groupBy("conv_id", "turn").agg(
        F.min(F.struct("level", "no", "to_conv", "to_turn")).alias("best"), F.count(F.lit(1)).alias("n")
    )
    first = first.select("conv_id", "turn", F.col("best.to_conv").alias("reply_conv"), F.col("best.to_turn").alias("reply_turn"))
    replies = _positions(first.join(_chains(first), ["conv_id", "turn"]))
    copies = parsed.select("conv_id", "turn", F.explode("quotes").alias("q")).select("conv_id", "turn", "q.no", "q.passage")
    counts = linked.select("conv_id", "turn", "no", "passage").distinct()
    counts = copies.join(counts, ["conv_id", "turn", "no", "passage"]).distinct()
    counts = counts.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n_linked"))
    out = parsed.drop("said", "quotes").join(replies, ["conv_id", "turn"], "left").join(counts, ["conv_id", "turn"], "left")
    return out.select(
        "conv_id",
        "turn",
        "role",
        "body",
        "n_quotes",
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        "max_level",
        "reply_conv",
        "reply_turn",
        F.coalesce("thread_conv", "conv_id").alias("thread_conv"),
        F.coalesce("thread_turn", "turn").alias("thread_turn"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        F.coalesce("position", F.lit(0)).cast("long").alias("position"),
    )


def _linked(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, no, level, passage, to_conv, to_turn) of every passage with an original."""
    said = parsed.where("conv_id is not null and turn is not null")
    said = said.select("conv_id", "turn", F.explode("said").alias("hash"))
    # the first speaker of a passage: partial minima, so a common line is one row per task
    in_conv = said.groupBy("hash", "conv_id").agg(F.min("turn").alias("own_turn"))
    overall = in_conv.groupBy("hash").agg(F.min(F.struct("conv_id", "own_turn")).alias("of_all"))
    asked = parsed.where("conv_id is not null and turn is not null")
    asked = asked.select("conv_id", "turn", F.explode("quotes").alias("q")).select("conv_id", "turn", "q.*")
    # rank 0 is the whole passage, then its lines in order
    each = F.concat(F.array("passage"), "lines")
    asked = asked.select("conv_id", "turn", "no", "level", "passage", F.posexplode(each).alias("rank", "hash"))
    asked = asked.distinct()
    near = asked.join(in_conv, ["hash", "conv_id"], "left").join(overall, "hash", "left")
    own = F.when(F.col("own_turn") < F.col("turn"), F.struct(F.col("conv_id").alias("to_conv"), F.col("own_turn").alias("to_turn")))
    other = F.when(
        F.col("of_all.conv_id") < F.col("conv_id"),
        F.struct(F.col("of_all.conv_id").alias("to_conv"), F.col("of_all.own_turn").alias("to_turn")),
    )
    found = near.withColumn("to", F.coalesce(own, other)).where("to is not null")
    best = found.groupBy("conv_id", "turn", "no", "level", "passage").agg(F.min_by("to", "rank").alias("to"))
    return best.select("conv_id", "turn", "no", "level", "passage", "to.to_conv", "to.to_turn")


def _chains(first: DataFrame) -> DataFrame:
    """(conv_id, turn, thread_conv, thread_turn, depth): reply chains followed to their start.

    Every round doubles the length of the pointers.  A reply points to a smaller
    turn of its conversation or to a smaller conv_id, so chains end.
    """
    pointers = first.select(
        "conv_id", "turn", F.col("reply_conv").alias("thread_conv"), F.col("reply_turn").alias("thread_turn"), F.lit(1).alias("depth")
    )
    pointers = checkpointed(pointers)
    for _ in range(MAX_ROUNDS):
        ahead = pointers.select(
            F.col("conv_id").alias("thread_conv"),
            F.col("turn").alias("thread_turn"),
            F.col("thread_conv").alias("next_conv"),
            F.col("thread_turn").alias("next_turn"),
            F.col("depth").alias("more"),
        )
        moved = pointers.join(ahead, ["thread_conv", "thread_turn"], "left")
        moved = moved.select(
            "conv_id",
            "turn",
            F.coalesce("next_conv", "thread_conv").alias("thread_conv"),
            F.coalesce("next_turn", "thread_turn").alias("thread_turn"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("more").isNotNull().alias("moved"),
        )
        moved = checkpointed(moved)
        pointers = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return pointers
    raise RuntimeError(f"reply chains do not end within {MAX_ROUNDS} rounds")


def _positions(replies: DataFrame) -> DataFrame:
    """``replies`` with their place in reply order, from 1 in each thread.

    A walk around the tree enters and leaves every reply once.  Entries point to the
    next one; every round doubles the length of the pointers and adds up how many replies
    are entered from there on, until all have come to the end of their thread.  No task
    holds a thread: entries are rows, whatever the number of replies to one message.
    """
    parent = ["reply_conv", "reply_turn"]
    # replies to one message are numbered side by side, in the order in which they are read
    keyed = replies.withColumn("edge", F.struct(*parent, "conv_id", "turn"))
    edges = checkpointed(number_rows(keyed, "edge").drop("edge"))
    ends = edges.groupBy(*parent).agg(F.min("row_no").alias("first_no"), F.max("row_no").alias("last_no"))
    below = ends.select(F.col("reply_conv").alias("conv_id"), F.col("reply_turn").alias("turn"), "first_no")
    above = edges.select(F.col("conv_id").alias("reply_conv"), F.col("turn").alias("reply_turn"), F.col("row_no").alias("parent_no"))
    walk = edges.join(ends.drop("first_no"), parent).join(above, parent, "left").join(below, ["conv_id", "turn"], "left")
    enter, leave = 2 * F.col("row_no"), 2 * F.col("row_no") + 1
    on = F.when(F.col("row_no") < F.col("last_no"), enter + 2).otherwise(2 * F.col("parent_no") + 1)
    entries = walk.select(
        F.explode(
            F.array(
                F.struct(enter.alias("entry"), F.coalesce(2 * F.col("first_no"), leave).alias("next"), F.lit(1).cast("long").alias("after")),
                F.struct(leave.alias("entry"), on.alias("next"), F.lit(0).cast("long").alias("after")),
            )
        ).alias("e")
    ).select("e.*")
    entries = checkpointed(entries)
    for _ in range(MAX_ROUNDS):
        running = entries.where("next is not null")
        if running.isEmpty():
            break
        ahead = entries.select(F.col("entry").alias("next"), F.col("next").alias("next_but_one"), F.col("after").alias("more"))
        moved = running.join(ahead, "next").select("entry", F.col("next_but_one").alias("next"), (F.col("after") + F.col("more")).alias("after"))
        entries = checkpointed(moved.union(entries.where("next is null")))
    else:
        raise RuntimeError(f"reply order does not settle within {MAX_ROUNDS} rounds")
    ranked = entries.where("entry % 2 = 0").select(F.expr("entry div 2").alias("row_no"), "after")
    ranked = edges.join(ranked, "row_no").drop("row_no")
    thread = ["thread_conv", "thread_turn"]
    whole = ranked.groupBy(*thread).agg(F.max("after").alias("whole"))
    return ranked.join(whole, thread).withColumn("position", F.col("whole") - F.col("after") + 1).drop("whole", "after")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parsed = [parse_message(t or "") for t in batch.column("text").to_pylist()]
        said = [sorted({passage_hash(p) for p in passages(body)} - {0}) for body, _ in parsed]
        quotes = [
            [
                {
                    "no": i,
                    "level": level,
                    "passage": passage_hash(" ".join(lines)),
                    "lines": [h for h in map(passage_hash, lines) if h],
                }
                for i, (level, lines) in enumerate(found)
            ]
            for _, found in parsed
        ]
        kind = pa.struct([("no", pa.int32()), ("level", pa.int32()), ("passage", pa.int64()), ("lines", pa.list_(pa.int64()))])
        columns = {
            "conv_id": batch.column("conv_id"),
            "turn": batch.column("turn"),
            "role": batch.column("role"),
            "body": pa.array([body for body, _ in parsed], pa.string()),
            "n_quotes": pa.array([len(q) for q in quotes], pa.int32()),
            "max_level": pa.array([max((q["level"] for q in own), default=0) for own in quotes], pa.int32()),
            "said": pa.array(said, pa.list_(pa.int64())),
            "quotes": pa.array(quotes, pa.list_(kind)),
        }
        yield pa.RecordBatch.from_pydict(columns)


def parse_message(text: str) -> tuple[str, list[tuple[int, list[str]]]]:
    """(what the message says itself, its quoted passages as (level, lines)).

    Blank quoted lines part passages.  What announces a quotation goes with it: the line above, and
    if an announcement begins further up in the same paragraph, all lines from there.
    """
    body, found, level_before, since = [], [], 0, 0
    for line in text.split("\n"):
        marks = MARKS.match(line)
        level = marks.group().count(">") if marks else 0
        if not level:
            body.append(line)
        else:
            if not level_before:
                while body and not body[-1].strip():
                    body.pop()
                del body[_announcement(body, since) :]
                since = len(body)
            content = line[marks.end() :].strip()
            if not content:
                level_before = -level  # the passage is over, the quotation is not
                continue
            if level != level_before:
                found.append((level, []))
            found[-1][1].append(content)
        level_before = level
    return "\n".join(body).strip("\n"), found


def _announcement(body: list[str], since: int) -> int:
    """The line, from ``since`` on, where an announcement at the end of ``body`` begins; the end if there is none."""
    line = body[-1].rstrip() if len(body) > since else ""
    if not (line.endswith(":") and line[:-1].rstrip().endswith(ANNOUNCES)):
        return len(body)
    for at in range(len(body) - 1, since - 1, -1):
        if not body[at].strip():
            break
        if BEGINS.match(body[at]):
            return at
    return len(body) - 1


def passages(body: str) -> Iterator[str]:
    """What a quotation may repeat: the whole text, its paragraphs and its lines."""
    yield body
    yield from re.split(r"\n\s*\n", body)
    yield from body.split("\n")


def passage_hash(text: str) -> int:
    """Hash of the words, case folded; 0 for a passage without a word."""
    words = re.findall(r"\w+", text.casefold())
    return xxhash.xxh64_intdigest(" ".join(words)) - (1 << 63) or 1 if words else 0
