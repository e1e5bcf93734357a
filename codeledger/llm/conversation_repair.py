"""Conversations repaired by the cheapest edits, as a stream of turns in order.

Turns are dealt out by conversation and sorted within partitions, so a task sees each conversation as a
run of rows.  It carries the state of a dynamic program over the edits from row to row, across Arrow
batches; a row leaves two bytes behind, the number of the step that was taken, from which the edits are
traced back at the end of the conversation.  Those steps and the rows wait in memory up to SPOOL_BYTES and
then in a temporary file of the task, which goes with the task: a lost executor costs its tasks, no data.
"""

from __future__ import annotations

import hashlib
import struct
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from tempfile import SpooledTemporaryFile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: What a conversation holds in memory of its rows, and of its steps, before they go to a file.
SPOOL_BYTES = 8 << 20
#: Rows and bytes of text in a batch of output.
OUT_ROWS, OUT_BYTES = 5_000, 8 << 20

SUMMARY = (
    "conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)
TURNS = "conv_id {id}, place long, turn long, edit string, role string, text string"


@dataclass(frozen=True)
class Costs:
    """What an edit costs; ``truncated`` is added to each truncated row that stays.  Inserts must cost something."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


DEFAULT_COSTS = Costs()

# States of the roles so far: nothing, a system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
#: The role that may be inserted, or given to a row, in a state.
NEXT_ROLE = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
ACCEPTED = (START, ASSISTANT)
#: More inserts in a row would come back to a state at a cost.
MOST_INSERTS = 2
EDITS = "DIKR"
CLEAN, TRUNCATED, UNFIT = range(3)


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with planted faults, told by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the row, 4 makes its role user.
    A null id, turn, role or text counts as one space; ids and turns stay null.  Other columns are left out.
    """

    def spaced(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        spaced("role").alias("role"),
        spaced("text").alias("text"),
        (F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20).alias("fault"),
    ).where("fault <> 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "")
        .when(F.col("fault") == 2, F.translate("text", ENDS, ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.expr("if(fault = 3, array(0, 1), array(0))")).alias("copy"),
    ).drop("copy")


def repair(turns: DataFrame, ids: DataFrame | None = None, costs: Costs = DEFAULT_COSTS) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text): its faults and its cheapest edits.

    Rows count in the order of turn, nulls first; rows of one turn in the order of a digest of role and text.
    The first of these is a row's fault: blank (no text but white space), duplicate (role and text stand in an
    earlier row), truncated (does not end in ``.!?``).  ``illegal`` counts neighbours whose role initials are not
    system-user, user-assistant or assistant-user, ``gaps`` the turns missing between the least and the greatest.

    Edits are K keep, R another role, D delete, I insert an empty turn; blank and duplicate rows must go.  The
    roles that are left read ``(s?(ua)+)?``.  ``audit`` has the initials of the cheapest edits, of equal costs the
    least in ASCII, ``repaired_sha256`` the digest of the ``role:text`` lines that are left.

    A null role or text is one space.  A null conv_id is a conversation of its own.  Conversations of ``ids``
    (conv_id) without rows have zeros, an empty audit and the digest of nothing.  Other columns of both are
    ignored.  No rows give none.
    """
    return _streamed(turns, ids, costs, SUMMARY, _summaries)


def repaired_turns(turns: DataFrame, costs: Costs = DEFAULT_COSTS) -> DataFrame:
    """The turns that the edits of ``repair`` leave: (conv_id, place, turn, edit, role, text), edit one of K, R, I.

    ``place`` counts from 0 within a conversation; an inserted turn has no turn number and an empty text.
    """
    return _streamed(turns, None, costs, TURNS, _left)


def _streamed(turns: DataFrame, ids: DataFrame | None, costs: Costs, schema: str, emit: Callable) -> DataFrame:
    told = F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
    ).withColumn("same", F.unhex(F.sha2(told, 256)))
    # which rows repeat an earlier turn is found on narrow rows, one per turn and text, in parts by text: a conversation's
    # texts are never held together; the finding travels as a mark in front of its row
    places = rows.select("conv_id", "same", F.coalesce("turn", F.lit(-(2**63))).alias("at")).distinct()
    first = places.groupBy("conv_id", "same").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = first.withColumnsRenamed({"conv_id": "id", "same": "told"})
    later = places.join(
        first, F.col("conv_id").eqNullSafe(F.col("id")) & (F.col("same") == F.col("told")) & (F.col("at") > F.col("first"))
    )
    empty = [F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text")]
    columns = ["conv_id", "turn", "same", "kind", "role", "text"]
    marks = later.select("conv_id", F.col("at").alias("turn"), "same", F.lit(1).alias("kind"), *empty)
    stream = rows.withColumn("kind", F.lit(2)).select(*columns).union(marks.select(*columns))
    if ids is not None:
        none = [F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("same"), F.lit(0).alias("kind")]
        stream = stream.union(ids.select("conv_id").distinct().select("conv_id", *none, *empty).select(*columns))
    stream = stream.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "same", "kind")
    given = T.StructType.fromDDL(schema.format(id=turns.schema["conv_id"].dataType.simpleString()))
    wanted = to_arrow_schema(given)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(emit(_conversations(batches, costs)), wanted)

    return stream.mapInArrow(run, given)


@cache
def _moves(costs: Costs, role: str, fault: int) -> tuple:
    """(from, to, cost, number of inserts, edit) for a row whose role begins with ``role``."""
    moves = []
    for start in range(4):
        state = start
        for inserts in range(MOST_INSERTS + 1):
            spent = inserts * costs.insert
            moves.append((start, state, spent + costs.delete, inserts, "D"))
            if fault != UNFIT:
                stays = spent + (costs.truncated if fault == TRUNCATED else 0)
                if (state, role) in AFTER:
                    moves.append((start, AFTER[state, role], stays, inserts, "K"))
                moves.append((start, AFTER[state, NEXT_ROLE[state][0]], stays + costs.rerole, inserts, "R"))
            state = AFTER[state, NEXT_ROLE[state][0]]
    return tuple(moves)


class _Steps:
    """The steps of the dynamic program that have been met so far.

    For each state there are the least cost of edits that lead to it, less the least of all states, and the
    place of the least such audit among those of the other states.  Audits of equally many rows that end in
    a row's edit are no prefixes of each other, so these places decide between longer audits.  Only so
    many combinations exist; each pair of one and a kind of row is worked out once and then has a number.
    """

    def __init__(self, costs: Costs) -> None:
        self.costs = costs
        self.numbers: dict[tuple, int] = {}
        self.steps: list[tuple] = []

    def take(self, at: tuple, role: str, fault: int) -> int:
        key = (at, role, fault)
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.steps)
            if number >= 1 << 16:
                raise OverflowError("more kinds of steps than two bytes can number")
            self.steps.append(self._step(at, role, fault))
        return number

    def _step(self, at: tuple, role: str, fault: int) -> tuple:
        best: dict[int, tuple] = {}
        for start, end, cost, inserts, edit in _moves(self.costs, role, fault):
            if at[start] is not None:
                spent, rank = at[start]
                found = (spent + cost, rank, "I" * inserts + edit, start, inserts)
                best[end] = min(best.get(end, found), found)
        least = min(found[0] for found in best.values())
        order = sorted(best, key=lambda state: best[state][1:3])
        after = tuple((best[s][0] - least, order.index(s)) if s in best else None for s in range(4))
        # one byte tells the way into a state: the state before, the inserts, the edit
        back = bytes(
            best[s][3] | best[s][4] << 2 | EDITS.index(best[s][2][-1]) << 4 if s in best else 0 for s in range(4)
        )
        return after, least, back


@cache
def _steps(costs: Costs) -> _Steps:
    return _Steps(costs)


class _Conversation:
    """Faults so far, the state of the dynamic program, and what is needed to trace its edits back."""

    def __init__(self, conv_id, costs: Costs) -> None:
        self.conv_id = conv_id
        self.steps = _steps(costs)
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.least = self.last = self.mark = self.same = None
        self.turns = 0
        self.before: str | None = None
        self.at: tuple = ((0, 0), None, None, None)
        self.cost = 0
        self.rows = SpooledTemporaryFile(SPOOL_BYTES)  # noqa: SIM115 - closed by close()
        self.taken = SpooledTemporaryFile(SPOOL_BYTES)  # noqa: SIM115
        self.numbers = array("H")

    def close(self) -> None:
        self.rows.close()
        self.taken.close()

    def add(self, turn: int | None, same: bytes, role: str, text: str) -> None:
        duplicate = self.mark == (turn, same) or self.same == (turn, same)
        self.same = (turn, same)
        if turn is not None:
            self.turns += self.last != turn
            self.least = turn if self.least is None else self.least
            self.last = turn
        said = text.rstrip(SPACES)
        fault = UNFIT
        if not said:
            self.blank += 1
        elif duplicate:
            self.duplicate += 1
        elif said[-1] not in ENDS:
            self.truncated += 1
            fault = TRUNCATED
        else:
            fault = CLEAN
        first = role[:1]
        if self.before is not None:
            self.illegal += self.before + first not in ("su", "ua", "au")
        self.before = first
        number = self.steps.take(self.at, first if first in ("s", "u", "a") else "", fault)
        self.at, spent, _ = self.steps.steps[number]
        self.cost += spent
        self.numbers.append(number)
        if len(self.numbers) >= 65_536:
            self._put_steps()
        for value in (role.encode(), text.encode()):
            self.rows.write(struct.pack("<I", len(value)))
            self.rows.write(value)
        self.rows.write(struct.pack("<?q", turn is None, turn or 0))

    def _put_steps(self) -> None:
        self.taken.write(self.numbers.tobytes())
        del self.numbers[:]

    def edits(self) -> Iterator[tuple[str, int | None, str, str]]:
        """(edit, turn, role, text) in order; sets ``cost`` to that of all."""
        ends = []
        for start, told in enumerate(self.at):
            state = start
            for inserts in range(MOST_INSERTS + 1):
                if told is not None and state in ACCEPTED:
                    ends.append((told[0] + inserts * self.steps.costs.insert, told[1], inserts, start))
                state = AFTER[state, NEXT_ROLE[state][0]]
        spent, _, inserts, state = min(ends)
        self.cost += spent
        self._put_steps()
        with SpooledTemporaryFile(SPOOL_BYTES) as ways:
            for block in _backwards(self.taken):
                numbers = array("H")
                numbers.frombytes(block)
                found = bytearray()
                for number in reversed(numbers):
                    way = self.steps.steps[number][2][state]
                    found.append(way)
                    state = way & 3
                ways.write(found)
            self.rows.seek(0)
            state = START
            for block in _backwards(ways):
                for way in reversed(block):
                    role, text = (self._value().decode() for _ in range(2))
                    unknown, turn = struct.unpack("<?q", self.rows.read(9))
                    for _ in range(way >> 2 & 3):
                        yield "I", None, NEXT_ROLE[state], ""
                        state = AFTER[state, NEXT_ROLE[state][0]]
                    edit = EDITS[way >> 4]
                    if edit == "R":
                        role = NEXT_ROLE[state]
                    if edit != "D":
                        state = AFTER[state, role[0]]
                    yield edit, None if unknown else turn, role, text
            for _ in range(inserts):
                yield "I", None, NEXT_ROLE[state], ""
                state = AFTER[state, NEXT_ROLE[state][0]]

    def _value(self) -> bytes:
        return self.rows.read(struct.unpack("<I", self.rows.read(4))[0])


def _backwards(file, size: int = 1 << 16) -> Iterator[bytes]:
    """The blocks of a file, the last first."""
    end = file.seek(0, 2)
    while end:
        start = max(0, end - size)
        file.seek(start)
        yield file.read(end - start)
        end = start


def _conversations(batches: Iterator[pa.RecordBatch], costs: Costs) -> Iterator[_Conversation]:
    """Each conversation of a sorted stream, once all of its rows are in; closed when the next one is asked for."""
    now: _Conversation | None = None
    for batch in batches:
        for conv_id, turn, same, kind, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield now
                    now.close()
                now = _Conversation(conv_id, costs)
            if kind == 1:
                now.mark = (turn, same)
            elif kind == 2:
                now.add(turn, same, role, text)
    if now is not None:
        yield now
        now.close()


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows, the last two values of which are texts, in batches of bounded size."""

    def batch() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema.names)

    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[-1]) + len(row[-2])
        if len(held) >= OUT_ROWS or size >= OUT_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _summaries(conversations: Iterator[_Conversation]) -> Iterator[tuple]:
    for c in conversations:
        digest = hashlib.sha256()
        audit = bytearray()
        lines = 0
        for edit, _, role, text in c.edits():
            audit += edit.encode()
            if edit != "D":
                digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                lines += 1
        gaps = 0 if c.least is None else c.last - c.least + 1 - c.turns
        faults = (gaps, c.blank, c.duplicate, c.truncated, c.illegal)
        yield c.conv_id, *faults, c.cost, audit.decode(), digest.hexdigest()


def _left(conversations: Iterator[_Conversation]) -> Iterator[tuple]:
    for c in conversations:
        place = 0
        for edit, turn, role, text in c.edits():
            if edit != "D":
                yield c.conv_id, place, turn, edit, role, text
                place += 1
