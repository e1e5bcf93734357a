"""Stupid-backoff scores of documents under n-gram counts of the whole corpus.

Every shard of documents counts its n-grams and sends the distinct ones, as
sorted blocks of hashes with counts, to the part of the hash range they belong to.
The parts add the counts up: together they are the count tables, partitioned by
hash.  Each block gets its totals back, joined in place, and the shard sums the
scores of its documents.  An n-gram travels once per shard however common it is;
one of three words or more only if both n-grams within it are common enough, as
it cannot be so otherwise.
"""

from __future__ import annotations

from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeledger.llm.packing import BASES, cut, index_words, pack, pack_sorted, rolling, unpack, unpack_sorted
from codeledger.llm.tables import pieces, text_bytes
from codeledger.session import checkpointed

SHARD_BYTES = 12 << 20
PART_KEYS = 1_000_000
#: Logarithms are whole millionths, so that sums do not depend on their order.
MICRO = 1_000_000
SHARD, PART = "__shard", "__part"
SENT = f"{PART} long, {SHARD} long, n int, keys binary, counts binary"


def score(docs: DataFrame, order: int = 3, min_count: int = 2, backoff: float = 0.4) -> DataFrame:
    """(doc_id, n_words, n_unigram, score_micro) of every document.

    A word scores c(n-gram) / c(its context) for the longest n-gram, up to
    ``order`` words of the same document, that the corpus holds at least ``min_count``
    times; each shortening costs the factor ``backoff``; a single word scores c(word) / N.
    score_micro is the sum of natural logarithms in millionths, each logarithm
    rounded on its own; n_unigram counts the words scored alone.

    Words are cut at ASCII white space and unchanged.  A null, empty or blank text scores 0 with 0 words.
    Repeated rows count each time and each give a row; null ids are kept.  Other
    columns are not read.  Empty table: no rows.  N-grams are told apart by 64-bit hashes.
    """
    size = text_bytes(docs)
    shards, parts = pieces(size, SHARD_BYTES), pieces(size // 4, PART_KEYS)
    kind = docs.schema["doc_id"].dataType.simpleString()
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards))
    dealt = docs.select(shard.alias(SHARD), "doc_id", "text")

    def sum_up(rows: pa.Table, known: pa.Table) -> pa.Table:
        corpus = _Shard(rows)
        alone, score = _scores(corpus, _totals(corpus, known, parts, order, min_count), order, backoff)
        columns = [rows.column("doc_id"), pa.array(corpus.lengths), pa.array(alone), pa.array(score)]
        return pa.Table.from_arrays(columns, ["doc_id", "n_words", "n_unigram", "score"])

    known = _counted(dealt.groupBy(SHARD).applyInArrow(_first_sender(min(order, 2), parts), SENT), min_count)
    for n in range(3, order + 1):
        asked = dealt.groupBy(SHARD).cogroup(known.groupBy(SHARD))
        known = known.union(_counted(asked.applyInArrow(_sender(n, parts, min_count), SENT), min_count))
    joined = dealt.groupBy(SHARD).cogroup(known.groupBy(SHARD))
    scored = checkpointed(joined.applyInArrow(sum_up, f"doc_id {kind}, n_words long, n_unigram long, score long"))
    # the logarithm of the number of all words is taken off last: one number
    words = scored.agg(F.sum("n_words").alias("n")).first()["n"] or 1
    score_micro = F.col("score") - F.col("n_unigram") * _micro_of(words)
    return scored.select("doc_id", "n_words", "n_unigram", score_micro.alias("score_micro"))


def _micro_of(number: float) -> int:
    return round(MICRO * log(number))


def _micro(counts: np.ndarray) -> np.ndarray:
    return np.rint(MICRO * np.log(np.maximum(counts, 1).astype(np.float64))).astype(np.int64)


class _Shard:
    """The words of a shard's documents in a row."""

    def __init__(self, rows: pa.Table):
        texts = [t.encode() if t is not None else None for t in rows.column("text").to_pylist()]
        words, self.lengths, hashes = index_words(texts)
        self.hashes = np.ascontiguousarray(hashes[:, 0])[words]
        starts = np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        #: Words of the same document before each word.
        self.before = np.arange(len(words)) - starts
        self.doc_of = np.repeat(np.arange(len(texts)), self.lengths)

    def keys(self, n: int, ends: np.ndarray) -> np.ndarray:
        """Hashes of the n-grams whose last words are at ``ends``."""
        return rolling(self.hashes, n, BASES[0])[ends - (n - 1)]

    def candidates(self, n: int, shorter: np.ndarray | None, min_count: int) -> np.ndarray:
        """Last words of the n-grams that are counted; ``shorter``: totals of the (n-1)-grams."""
        whole = self.before >= n - 1
        if n > 2:
            common = shorter >= min_count
            whole[1:] &= common[1:] & common[:-1]
        return np.flatnonzero(whole)


def _blocks(number: int, n: int, keys: np.ndarray, parts: int) -> list[tuple]:
    keys, counts = np.unique(keys, return_counts=True)
    counts = counts.astype(np.uint32)
    return [(p, number, n, pack_sorted(keys[a:b]), pack(counts[a:b])) for p, a, b in cut(keys, parts)]


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    kinds = [pa.int32() if n == "n" else pa.binary() if n in ("keys", "counts", "totals") else pa.int64() for n in names]
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _first_sender(order: int, parts: int):
    def send(rows: pa.Table) -> pa.Table:
        number, corpus = rows.column(SHARD)[0].as_py(), _Shard(rows)
        out = []
        for n in range(1, order + 1):
            out += _blocks(number, n, corpus.keys(n, corpus.candidates(n, None, 0)), parts)
        return _table(out, [PART, SHARD, "n", "keys", "counts"])

    return send


def _sender(n: int, parts: int, min_count: int):
    def send(rows: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows:
            corpus = _Shard(rows)
            shorter = _totals(corpus, known, parts, n - 1, min_count)[-1]
            keys = corpus.keys(n, corpus.candidates(n, shorter, min_count))
            out = _blocks(rows.column(SHARD)[0].as_py(), n, keys, parts)
        return _table(out, [PART, SHARD, "n", "keys", "counts"])

    return send


def _counted(sent: DataFrame, min_count: int) -> DataFrame:
    """Every block's totals over the corpus; those of two words or more that are too rare are 0."""

    def add(rows: pa.Table) -> pa.Table:
        out = []
        for n in sorted(set(rows.column("n").to_pylist())):
            own = rows.filter(pc.equal(rows.column("n"), n))
            keys = [unpack_sorted(k) for k in own.column("keys").to_pylist()]
            counts = np.concatenate([unpack(c, np.uint32) for c in own.column("counts").to_pylist()])
            _, group = np.unique(np.concatenate(keys), return_inverse=True)
            totals = np.bincount(group, counts).astype(np.uint64)[group]
            if n > 1:
                totals[totals < min_count] = 0
            ends = np.cumsum([len(k) for k in keys]).tolist()
            places = zip(own.column(SHARD).to_pylist(), own.column(PART).to_pylist(), keys, ends, strict=True)
            out += [(shard, part, n, pack(totals[end - len(k) : end])) for shard, part, k, end in places]
        return _table(out, [SHARD, PART, "n", "totals"])

    return sent.groupBy(PART).applyInArrow(add, f"{SHARD} long, {PART} long, n int, totals binary")


def _totals(corpus: _Shard, known: pa.Table, parts: int, order: int, min_count: int) -> list[np.ndarray]:
    """For n up to ``order``, the total of the n-gram that ends at each word; 0 if too rare or none."""
    blocks = zip(known.column("n").to_pylist(), known.column(PART).to_pylist(), known.column("totals"), strict=True)
    answers = {(n, part): data for n, part, data in blocks}
    out: list[np.ndarray] = []
    for n in range(1, order + 1):
        ends = corpus.candidates(n, out[-1] if out else None, min_count)
        keys, group = np.unique(corpus.keys(n, ends), return_inverse=True)
        totals = np.zeros(len(keys), np.int64)
        for part, low, high in cut(keys, parts):
            totals[low:high] = unpack(answers[n, part].as_py(), np.uint64)
        own = np.zeros(len(corpus.hashes), np.int64)
        own[ends] = totals[group]
        out.append(own)
    return out


def _scores(corpus: _Shard, totals: list[np.ndarray], order: int, backoff: float) -> tuple[np.ndarray, np.ndarray]:
    """Per document: words scored alone, and the sum of millionths but for the corpus size."""
    score, length = np.zeros(len(corpus.hashes), np.int64), np.zeros(len(corpus.hashes), np.int64)
    for n, own in enumerate(totals, 1):
        held = np.flatnonzero(own)
        context = totals[n - 2][held - 1] if n > 1 else np.ones(len(held), np.int64)
        score[held] = _micro(own[held]) - _micro(context)
        length[held] = n
    score += (np.minimum(corpus.before + 1, order) - length) * _micro_of(backoff)
    docs = len(corpus.lengths)
    # whole numbers up to 2**53 are exact as weights
    total = np.bincount(corpus.doc_of, score, docs).astype(np.int64)
    return np.bincount(corpus.doc_of[length == 1], minlength=docs).astype(np.int64), total
