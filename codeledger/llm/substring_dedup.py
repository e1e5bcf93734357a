"""Repeated passages: automata of phrases that recur, run over all documents.

Documents are dealt to shards by ranges of ``doc_id``.  Every shard sends the
distinct hashes (80 bits) of its windows, as sorted blocks, to the part of the
hash range they belong to; each part answers which of them an earlier shard
holds.  This confirms the recurring passages, runs of recurring windows.  Each
shard then compiles phrases of its passages, spaced so that every window holds one
whole, into Aho-Corasick automata of bounded size and streams all its documents
through them.  The matches decide what is looked at: around each, the windows that
hold it are compared word by word with the confirmed window of their hash; the
words of equal ones go.  A window without a match stays.

A window is sent once per shard, whatever the number of its copies, so no
phrase makes a task grow.  Texts are shuffled once, for both passes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from codeledger.llm.packing import (
    BASES,
    cut,
    distinct,
    index_words,
    pack,
    pack_sorted,
    rolling,
    unpack,
    unpack_sorted,
)
from codeledger.llm.tables import aside, pieces, text_bytes, with_fields

#: Bytes of text in a shard and window keys in a part: what a task holds.
SHARD_BYTES = 8 << 20
PART_KEYS = 1_000_000
#: Phrases of one automaton.
AUTOMATON_PHRASES = 32_000
#: A word of a phrase is written as three letters of 64 each, so that no state has many branches.
LETTERS, DIGITS = 64, 3

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
    ]
)
SHARD, PART = "__shard", "__part"


def remove_repeats(docs: DataFrame, window: int = 13, keep_text: bool = True) -> DataFrame:
    """``docs`` without the words of passages that an earlier document holds.

    A word goes when a ``window`` of consecutive words covers it whose words
    also start in a document with a smaller ``doc_id``, judged on the input.
    Adds n_words, n_removed and kept_sha256 (of the kept words, joined by one
    space).  With ``keep_text`` the column text holds what is kept, with its own
    white space; without it there is no column text.

    A null text counts as empty and stays null.  Repeated rows and equal ids:
    rows of one id are never earlier than each other.  A null ``doc_id`` is
    later than every other and not earlier than another null.  Other columns
    pass through; one named like a result is replaced.  Empty table: no rows.
    """
    if {SHARD, PART} & {c.lower() for c in docs.columns}:
        # the caller uses the names that are used here: its columns stand aside under others
        given = docs.drop(*[c for c in docs.columns if c.lower() in RESULT.fieldNames()])
        hidden, _ = aside(given, "doc_id", "text")
        rows = remove_repeats(hidden, window, keep_text)
        return rows.withColumnsRenamed(dict(zip(hidden.columns, given.columns, strict=True)))
    size = text_bytes(docs)
    shards = pieces(size, SHARD_BYTES)
    parts = pieces(size // 6, PART_KEYS)
    bounds = _bounds(docs, shards)
    nulls = len(bounds) + 1
    later = F.lit(nulls) + F.pmod(F.xxhash64("text"), F.lit(shards))
    dealt = docs.withColumn(SHARD, F.when(F.col("doc_id").isNull(), later).otherwise(_range_of(bounds)).cast("long"))

    sent = dealt.groupBy(SHARD).applyInArrow(_sender(window, parts), f"{PART} long, {SHARD} long, keys binary, checks binary")
    known = sent.groupBy(PART).applyInArrow(_confirmer(nulls), f"{SHARD} long, {PART} long, earlier binary")
    fields = [f for f in docs.schema if keep_text or f.name.lower() != "text"]
    schema = with_fields(T.StructType(fields), RESULT)
    return dealt.groupBy(SHARD).cogroup(known.groupBy(SHARD)).applyInArrow(_remover(window, parts, schema, keep_text), schema)


def _bounds(docs: DataFrame, shards: int) -> list[int]:
    """Least ids of all ranges but the first: one number per shard."""
    if shards < 2:
        return []
    at = F.percentile_approx("doc_id", [i / shards for i in range(1, shards)], min(1_000_000, 100 * shards))
    return sorted(set(docs.agg(at.alias("at")).first()["at"] or []))


def _range_of(bounds: list[int]):
    """How many bounds are at most ``doc_id``: a binary search."""
    if not bounds:
        return F.lit(0)
    steps = len(bounds).bit_length()
    table = ",".join(map(str, bounds))
    middle = "shiftright(s.lo + s.hi, 1)"
    return F.expr(
        f"aggregate(sequence(1, {steps}), struct(0 as lo, {len(bounds)} as hi), (s, i) -> if(s.lo >= s.hi, s, "
        f"if(doc_id >= element_at(array({table}), {middle} + 1), "
        f"struct({middle} + 1 as lo, s.hi as hi), struct(s.lo as lo, {middle} as hi))), s -> s.lo)"
    )


class _Shard:
    """The words and windows of one shard's documents, in order of doc_id."""

    def __init__(self, rows: pa.Table, window: int):
        ids = rows.column("doc_id")
        known = ids.is_valid().to_numpy()
        self.ids = np.where(known, ids.fill_null(0).to_numpy(), np.iinfo(np.int64).max)
        self.texts = [t.encode() if t is not None else None for t in rows.column("text").to_pylist()]
        self.words, self.lengths, hashes = index_words(self.texts)
        self.doc_of = np.repeat(np.arange(len(self.texts)), self.lengths)
        last = max(0, len(self.words) - window + 1)
        self.at = np.flatnonzero(self.doc_of[:last] == self.doc_of[len(self.words) - last :])
        self.vocabulary = len(hashes)
        per_word = [np.ascontiguousarray(hashes[:, i])[self.words] for i in (0, 1)]
        self.keys = rolling(per_word[0], window, BASES[0])[self.at]
        self.checks = (rolling(per_word[1], window, BASES[1])[self.at] >> np.uint64(48)).astype(np.uint16)
        self.docs = self.doc_of[self.at]
        self.order, self.first = distinct(self.keys, self.checks)


def _in_order(rows: pa.Table) -> pa.Table:
    return rows.sort_by([("doc_id", "ascending")])


def _sender(window: int, parts: int):
    def send(rows: pa.Table) -> pa.Table:
        number = rows.column(SHARD)[0].as_py()
        shard = _Shard(_in_order(rows), window)
        at = shard.order[shard.first]
        keys, checks = shard.keys[at], shard.checks[at]
        blocks = cut(keys, parts)
        return pa.table(
            {
                PART: pa.array([p for p, _, _ in blocks], pa.int64()),
                SHARD: pa.array([number] * len(blocks), pa.int64()),
                "keys": pa.array([pack_sorted(keys[a:b]) for _, a, b in blocks], pa.binary()),
                "checks": pa.array([pack(checks[a:b]) for _, a, b in blocks], pa.binary()),
            }
        )

    return send


def _confirmer(nulls: int):
    def confirm(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(SHARD, "ascending")])
        shards = rows.column(SHARD).to_numpy()
        keys = [unpack_sorted(k) for k in rows.column("keys").to_pylist()]
        checks = [unpack(c, np.uint16) for c in rows.column("checks").to_pylist()]
        sizes = [len(k) for k in keys]
        all_keys, owner = np.concatenate(keys), np.repeat(np.arange(len(keys)), sizes)
        order, first = distinct(all_keys, np.concatenate(checks))
        holder = owner[order[first]][np.cumsum(first) - 1]
        earlier = np.zeros(len(all_keys), bool)
        earlier[order] = (holder < owner[order]) & (shards[holder] < nulls)
        ends = np.cumsum(sizes)
        bits = [pack(np.packbits(earlier[e - n : e])) for e, n in zip(ends, sizes, strict=True)]
        return pa.table({SHARD: rows.column(SHARD), PART: rows.column(PART), "earlier": pa.array(bits, pa.binary())})

    return confirm


def _remover(window: int, parts: int, schema: T.StructType, keep_text: bool):
    names = schema.names

    def remove(rows: pa.Table, known: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({n: pa.nulls(0, to_arrow_type(schema[n].dataType)) for n in names})
        rows = _in_order(rows)
        shard = _Shard(rows, window)
        gone = _covered(shard, _answers(shard, known, parts), window)
        ends = np.cumsum(shard.lengths)
        removed = np.add.reduceat(np.append(gone, False), ends - shard.lengths, dtype=np.int64) * (shard.lengths > 0)
        digests, texts = [], []
        for text, n, end, lost in zip(shard.texts, shard.lengths, ends, removed, strict=True):
            words = (text or b"").split()
            if lost:
                mask = gone[end - n : end]
                if keep_text:
                    texts.append(_kept_text(text, mask))
                words = [w for w, out in zip(words, mask, strict=True) if not out]
            elif keep_text:
                texts.append(text)
            digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
        new = {"n_words": shard.lengths, "n_removed": removed, "kept_sha256": digests}
        if keep_text:
            new["text"] = [t.decode() if t is not None else None for t in texts]
        columns = {c.lower(): c for c in rows.column_names}
        return pa.table(
            {
                name: pa.array(new[name.lower()], to_arrow_type(schema[name].dataType))
                if name.lower() in new
                else rows.column(columns[name.lower()])
                for name in names
            }
        )

    return remove


def _answers(shard: _Shard, known: pa.Table, parts: int) -> np.ndarray:
    """For each distinct key of the shard, whether an earlier shard holds it."""
    keys = shard.keys[shard.order[shard.first]]
    earlier = np.zeros(len(keys), bool)
    blocks = dict(zip(known.column(PART).to_pylist(), known.column("earlier").to_pylist(), strict=True))
    for part, low, high in cut(keys, parts):
        earlier[low:high] = np.unpackbits(unpack(blocks[part], np.uint8), count=high - low)
    return earlier


def _covered(shard: _Shard, earlier: np.ndarray, window: int) -> np.ndarray:
    """Per word, whether a recurring window of an earlier document covers it."""
    gone = np.zeros(len(shard.words), bool)
    if not len(shard.at):
        return gone
    # the distinct windows, each where it stands first and last in the order of ids
    starts = np.flatnonzero(shard.first)
    first, last = shard.order[starts], shard.order[np.append(starts[1:], len(shard.order)) - 1]
    holder = shard.ids[shard.docs[first]]
    confirmed = earlier | (holder < shard.ids[shard.docs[last]])
    keys, places = shard.keys[first][confirmed], shard.at[first[confirmed]]
    # documents with a larger id lose the window
    after = np.where(earlier, np.iinfo(np.int64).min, holder)[confirmed]

    length = _phrase_length(window)
    near = np.concatenate([[0], np.cumsum(_occurrences(shard, _phrases(np.sort(places), window), length))])
    around = np.flatnonzero(near[shard.at + window - length + 1] > near[shard.at])
    at = shard.at[_equal_windows(shard, around, keys, places, after, window)]
    cover = np.bincount(at, minlength=len(gone) + 1) - np.bincount(at + window, minlength=len(gone) + 1)
    return np.cumsum(cover)[:-1] > 0


def _equal_windows(
    shard: _Shard, around: np.ndarray, keys: np.ndarray, places: np.ndarray, after: np.ndarray, window: int
) -> np.ndarray:
    """Those of the windows ``around`` matches whose words are the words at one of ``places``, in a document after it.

    ``keys``, in order, are the hashes of the windows at ``places``: they name the place to compare with, the words decide.
    """
    found, to = [around[:0]], np.searchsorted(keys, shard.keys[around])
    while len(around):
        held = np.flatnonzero(to < len(keys))
        held = held[keys[to[held]] == shard.keys[around[held]]]
        around, to = around[held], to[held]
        equal = np.ones(len(around), bool)
        for word in range(window):
            equal &= shard.words[shard.at[around] + word] == shard.words[places[to] + word]
        found.append(around[equal & (shard.ids[shard.docs[around]] > after[to])])
        # another window of the same hash may follow
        around, to = around[~equal], to[~equal] + 1
    return np.concatenate(found)


def _phrase_length(window: int) -> int:
    """Phrases as far apart as they are long: every window holds a whole one."""
    return (window + 1) // 2


def _phrases(begin: np.ndarray, window: int) -> np.ndarray:
    """Places of phrases that cut each passage, given the sorted places of its windows."""
    if not len(begin):
        return begin
    length = _phrase_length(window)
    breaks = np.flatnonzero(np.diff(begin) > 1) + 1
    first, last = begin[np.append(0, breaks)], begin[np.append(breaks - 1, len(begin) - 1)]
    counts = (last - first + window - length) // length + 1
    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(first, counts) + length * number


def _occurrences(shard: _Shard, places: np.ndarray, length: int) -> np.ndarray:
    """For every word, whether one of the phrases at ``places`` begins there.

    An automaton's words are numbered and written in DIGITS letters, each digit from letters of its
    own, so matches begin at words; words of no phrase are one more letter.
    """
    located = np.zeros(len(shard.words), bool)
    for low in range(0, len(places), AUTOMATON_PHRASES):
        some = places[low : low + AUTOMATON_PHRASES]
        used = np.unique(shard.words[some[:, None] + np.arange(length)])
        code = np.full((shard.vocabulary, DIGITS), LETTERS * DIGITS, np.uint8)
        for digit in range(DIGITS):
            code[used, digit] = np.arange(len(used)) // LETTERS**digit % LETTERS + LETTERS * digit
        line = code[shard.words].tobytes().decode("latin-1")
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for at in some.tolist():
            automaton.add_word(line[DIGITS * at : DIGITS * (at + length)])
        automaton.make_automaton()
        ends = np.fromiter((end for end, _ in automaton.iter(line)), np.int64)
        located[(ends + 1) // DIGITS - length] = True
    return located


def _kept_text(text: bytes, gone: np.ndarray) -> bytes:
    """The kept words with the white space before each; what follows a removed word goes with it."""
    kept = [m.group() for m, out in zip(re.finditer(rb"[ \t-\r]*[^ \t-\r]+", text), gone, strict=True) if not out]
    return b"".join(kept).strip()
