"""Phrases that occur together, from stripes: a counter of next words for each prefix.

One level for each length of prefix, none to the longest.  A task counts the stripes of its documents, millions of
words at a time, and sends them on; stripes of one prefix are then merged element by element, in a stream sorted
by prefix.  The merged stripes of all levels hold every count that scores
need: an entry is the count of prefix and next word, which is the total of that longer prefix one level on.

A phrase is no more frequent than its parts, so the next level counts only phrases whose two parts are frequent.
That is told by a bit array of fixed size, made from the merged stripes; a false bit costs work, not results.
The stripe of a hot prefix is dealt out in parts by its next word, as many as its total asks for.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codeledger.session import checkpointed

#: Ends of a piece become full stops, other characters stay; A to Z are lower-cased.
_CUTS = bytes(46 if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))
MAX_WORDS = 3
MIN_COUNT = 10
#: A longer phrase with this share of the occurrences of a shorter one stands for it.
SUBSUMED_PERCENT = 50
TOP = 2_000
#: Words that a task holds, as numbers, before it sends their stripes on.
HELD = 3_000_000
#: A prefix with over one in this many occurrences is hot, so there are fewer hot ones than that.
SHARES = 1_024
#: Bits that tell frequent phrases, 2 to the power of this: 16 MB, whatever the input.
FILTER_BITS = 27
#: Joins the hashes of a phrase's words to one.
_FACTOR = 1_000_003
#: Candidates are first ranked in this many parts of a language.
RANK_PARTS = 64

STRIPE = "lang string, prefix string, part int, words string, counts string"
MERGED = "lang string, prefix string, total long, words array<string>, counts array<long>"


def stripes(
    docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, filter_bits: int = FILTER_BITS
) -> list[DataFrame]:
    """The merged stripes (lang, prefix, total, words, counts), for prefixes of 0 to ``max_words`` - 1 words.

    ``total`` sums the whole stripe, or that of one part of a hot prefix; ``words`` are the next words that occur
    ``min_count`` times or more, all of a prefix in one row, or in one row for each part.  From a prefix of
    one word on, a stripe counts only where prefix and extension can be that frequent.
    """
    texts = docs.select(
        F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    )
    levels: list[DataFrame] = []
    for length in range(max_words):
        if length:
            hot, bits = _hot(levels[-1], total), _frequent(levels[-1], filter_bits)
        else:
            hot, bits = {}, b""
        dealt = _local_stripes(texts, length, hot, bits, filter_bits).repartition("lang", "prefix", "part")
        merged = dealt.sortWithinPartitions("lang", "prefix", "part").mapInArrow(_merge(min_count), MERGED)
        levels.append(checkpointed(merged))
        if not length:
            total = levels[0].agg(F.sum("total")).first()[0] or 0
    return levels


def _entries(level: DataFrame) -> DataFrame:
    """(lang, phrase, n) of merged stripes."""
    phrase = F.concat_ws(" ", F.when(F.col("prefix") != "", F.col("prefix")), F.col("e.words"))
    rows = level.select("lang", "prefix", F.explode(F.arrays_zip("words", "counts")).alias("e"))
    return rows.select("lang", "prefix", phrase.alias("phrase"), F.col("e.counts").alias("n"))


def _hot(level: DataFrame, total: int) -> dict[tuple[str, str], int]:
    """The parts that the stripes of the hottest prefixes are dealt to; fewer than SHARES prefixes."""
    found = _entries(level).where(F.col("n") * SHARES > total)
    return {(r.lang, r.phrase): -(-r.n * SHARES // total) for r in found.collect()}


def _frequent(level: DataFrame, filter_bits: int) -> bytes:
    """A bit for each frequent phrase, by its hash: 2^filter_bits bits, gathered in buckets of 4 kB."""
    # bitmap functions count bits, and buckets of 2^15 of them, from 1
    hashed = f"aggregate(split(phrase, ' '), crc32(lang), (h, w) -> (h * {_FACTOR} + crc32(w)) % {1 << filter_bits}) + 1"
    slots = _entries(level).select(F.expr(hashed).alias("slot"))
    buckets = slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    filled = bytearray(max(4096, (1 << filter_bits) // 8))
    for row in buckets.collect():
        filled[(row.bucket - 1) * 4096 : row.bucket * 4096] = row.bits
    return bytes(filled)


def _merge(min_count: int):
    """Stripes of one key, which lie side by side, added element by element."""

    def done(key: tuple, stripe: dict[str, int]) -> tuple:
        kept = sorted((w, n) for w, n in stripe.items() if n >= min_count)
        return *key[:2], sum(stripe.values()), [w for w, _ in kept], [n for _, n in kept]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        key, stripe = None, {}
        for batch in batches:
            for lang, prefix, part, words, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != (lang, prefix, part):
                    if key is not None:
                        yield done(key, stripe)
                    key, stripe = (lang, prefix, part), {}
                if not stripe:
                    stripe = dict(zip(words.split(" "), map(int, counts.split(" ")), strict=True))
                    continue
                for word, n in zip(words.split(" "), map(int, counts.split(" ")), strict=True):
                    stripe[word] = stripe.get(word, 0) + n
        if key is not None:
            yield done(key, stripe)

    types = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
    return lambda batches: _batches(rows(batches), ["lang", "prefix", "total", "words", "counts"], types)


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    while held := [row for _, row in zip(range(size), rows, strict=False)]:
        columns = zip(*held, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _local_stripes(texts: DataFrame, length: int, hot: dict, bits: bytes, filter_bits: int) -> DataFrame:
    """The stripes of each task's own texts, for prefixes of ``length`` words."""
    shared = texts.sparkSession.sparkContext.broadcast((hot, bits))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        hot, bits = shared.value
        filled = np.frombuffer(bits, np.uint8)
        held: dict[str, _Words] = {}
        size = 0

        def sent() -> Iterator[tuple]:
            for lang, words in held.items():
                yield from words.stripes(lang, length, hot, filled, filter_bits)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if lang not in held:
                    held[lang] = _Words()
                size += held[lang].add(text.as_py())
                if size >= HELD:
                    yield from sent()
                    held, size = {}, 0
        yield from sent()

    types = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.string()]
    return texts.mapInArrow(
        lambda batches: _batches(rows(batches), ["lang", "prefix", "part", "words", "counts"], types), STRIPE
    )


class _Numbers(dict):
    """A number for each word, as they come."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class _Words:
    """The words of texts of one language, as numbers; 0 ends a piece."""

    def __init__(self) -> None:
        self.numbers = _Numbers({b".": 0})
        self.places = array("i")

    def add(self, text: bytes) -> int:
        before = len(self.places)
        # no word holds a full stop, so one alone is the end of a piece
        self.places.extend(map(self.numbers.__getitem__, text.translate(_CUTS).replace(b".", b" . ").split()))
        self.places.append(0)
        return len(self.places) - before

    def stripes(self, lang: str, length: int, hot: dict, filled: np.ndarray, filter_bits: int) -> Iterator[tuple]:
        """The stripe of each prefix of ``length`` words, in parts if it is hot, as rows."""
        words = list(self.numbers)
        at = np.frombuffer(self.places, np.int32).astype(np.int64)
        if not length:
            counts = np.bincount(at, minlength=len(words))
            counts[0] = 0
            found = np.flatnonzero(counts)
            yield from _dealt(lang, b"", [words[i] for i in found.tolist()], counts[found].tolist(), SHARES)
            return
        # phrases of ``length`` words that can be frequent, by their first place
        hashes = np.fromiter(map(crc32, words), np.int64, len(words))[at]
        n = max(0, len(at) - length + 1)
        slot = np.full(n, crc32(lang.encode()), np.int64)
        known = np.ones(n, bool)
        for k in range(length):
            slot = (slot * _FACTOR + hashes[k : k + n]) & ((1 << filter_bits) - 1)
            known &= at[k : k + n] != 0
        known &= (filled[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
        # a longer phrase can only be where two such follow each other
        place = np.flatnonzero(known[:-1] & known[1:])
        prefix, first = at[place], None
        for k in range(1, length):
            _, first, prefix = np.unique(prefix << 32 | at[place + k], return_index=True, return_inverse=True)
        pairs, counts = np.unique(prefix << 32 | at[place + length], return_counts=True)
        if not len(pairs):
            return
        starts = np.flatnonzero(np.diff(pairs >> 32, prepend=-1)).tolist()
        prefixes = (pairs >> 32)[starts]
        if first is None:
            named = [words[i] for i in prefixes.tolist()]
        else:
            begin = place[first[prefixes]]
            named = [b" ".join(words[i] for i in numbers) for numbers in at[begin[:, None] + np.arange(length)].tolist()]
        following = [words[i] for i in (pairs & 0xFFFFFFFF).tolist()]
        times = counts.tolist()
        for prefix, start, end in zip(named, starts, [*starts[1:], len(times)], strict=True):
            yield from _dealt(lang, prefix, following[start:end], times[start:end], hot.get((lang, prefix.decode()), 1))


def _dealt(lang: str, prefix: bytes, words: list[bytes], counts: list[int], parts: int) -> Iterator[tuple]:
    """A stripe as a row for each of its parts, told by the hash of the next word."""
    name = prefix.decode()
    if parts == 1:
        yield lang, name, 0, b" ".join(words).decode(), " ".join(map(str, counts))
        return
    split: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        split.setdefault(crc32(word) % parts, []).append(i)
    for part, chosen in split.items():
        yield lang, name, part, b" ".join([words[i] for i in chosen]).decode(), " ".join([str(counts[i]) for i in chosen])


def collocations(
    docs: DataFrame,
    max_words: int = MAX_WORDS,
    min_count: int = MIN_COUNT,
    subsumed_percent: int = SUBSUMED_PERCENT,
    top: int = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language (null: und) of ``docs`` (lang, text).

    Texts, in which A to Z are lower-cased, are cut into pieces at ``.,;:!?`` and line ends, and those into words at
    spaces and tabs; a null or empty text has none.  Phrases of 2 to ``max_words`` words that occur ``min_count`` times
    or more within pieces are candidates, with ``a`` occurrences.  Cut in two, its parts occur l and r times, and
    a phrase scores the whole part of 1,000,000 a a / (l r) at its worst cut, of equal ones the first.  A phrase within a
    longer candidate that occurs ``subsumed_percent`` % as often, or more, is left out.  Higher score, higher a, lesser
    phrase in UTF-8 first.  A language without such phrases has no rows; other columns of ``docs`` are ignored, repeated
    rows count each time.
    """
    levels = stripes(docs, max_words, min_count)
    counts = _entries(levels[0])
    for level in levels[1:]:
        counts = counts.union(_entries(level))
    counts = checkpointed(counts.select("lang", "phrase", "n", F.split("phrase", " ").alias("w")))
    found = counts.where(F.size("w") > 1).withColumnRenamed("n", "a")
    inside = F.expr(
        "filter(flatten(transform(sequence(2, size(w) - 1), k -> transform(sequence(1, size(w) - k + 1), "
        "i -> array_join(slice(w, i, k), ' ')))), p -> p <> phrase)"
    )
    longer = found.where(F.size("w") > 2).select("lang", F.explode(inside).alias("phrase"), "a")
    longest = longer.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = found.join(longest, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * subsumed_percent)
    )
    cuts = kept.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k")).select(
        "lang",
        "phrase",
        "a",
        "k",
        F.expr("array_join(slice(w, 1, k), ' ')").alias("left"),
        F.expr("array_join(slice(w, k + 1, size(w)), ' ')").alias("right"),
    )
    parts = counts.select(F.col("lang").alias("of"), F.col("phrase").alias("part"), F.col("n").alias("times"))
    for side, name in (("left", "l"), ("right", "r")):
        at = (F.col("lang") == F.col("of")) & (F.col(side) == F.col("part"))
        cuts = cuts.join(parts, at).select(*[c for c in cuts.columns if c != side], F.col("times").alias(name))
    # a, l and r have up to 15 digits at 10^15 words: a a 1,000,000 stays below 10^38
    wide = {c: f"cast({c} as decimal(16,0))" for c in "alr"}
    score = F.expr(f"cast(({wide['a']} * {wide['a']} * 1000000bd) div ({wide['l']} * {wide['r']}) as bigint)")
    cuts = cuts.withColumn("score", score)
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    rows = scored.select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = rows.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    ranked = first.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    words = levels[0].groupBy("lang").agg(F.sum("total").alias("n"))
    return (
        ranked.where(F.col("rank") <= top)
        .join(words, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
