"""Benchmark passages in documents, found through spaced seeds.

A seed is a hash of the words that a mask shows; the words it hides may differ.
Seeds of the test items are joined with the seeds at every position of every
document, and each alignment that a hit proposes is verified word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeledger.llm.tables import aside, small
from codeledger.session import checkpointed

#: Shown offsets of each mask.  Together they find every window of 13 words with
#: up to two words replaced: for any two places, one mask fits beside them.
MASKS = ((0, 1, 2, 3, 6, 7), (0, 1, 3, 5, 6, 7))
#: More masks for items of SPAN to 12 words, where a window has fewer places to slide to: with
#: them, any one replaced word of 8 or 9, and any two of 10 to 12, leave a mask that fits.
SHORT_MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 2, 3, 4, 6), (0, 1, 3, 4, 5, 6), (0, 1, 4, 5, 7, 8))
SPAN = 8
WINDOW = 13
SIMILARITY = 0.8
#: Seeds of test items that are broadcast: 20 bytes each.  More are joined by a shuffle.
BROADCAST_SEEDS = 2_000_000


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, n_equal): documents that hold a passage of a test item.

    Words are runs of letters and digits, lower-cased.  A document holds a passage
    when 13 consecutive words of it stand against 13 consecutive words of an item
    and at least ``similarity`` of them are equal, place by place; for an item
    of 8 to 12 words the whole item is the window.  Every such window with up to two
    replaced words is found, of 8 or 9 words with up to one.  n_equal is the most equal words of a window.

    Shorter items, null and empty texts match nothing.  Each pair of ids comes
    once, whatever the number of passages, ties or repeated rows; null ids are
    ids of their own.  Other columns are not read.  Empty tables: no rows.
    """
    items = checkpointed(_hashed(benchmark.select("item_id", "text")).distinct())
    short = F.size("words").between(SPAN, WINDOW - 1)
    tests = _seeds(items, "item_id", MASKS)
    masks = MASKS
    if items.where(short).limit(1).count():
        masks = MASKS + SHORT_MASKS
        tests = _seeds(items.where(~short), "item_id", MASKS).union(_seeds(items.where(short), "item_id", masks))
    tests = checkpointed(tests.select("item_id", "seed", F.col("at").alias("item_at")).distinct())
    if tests.count() <= BROADCAST_SEEDS:
        tests = F.broadcast(tests)
    hits = _seeds(_hashed(docs.select("doc_id", "text")), "doc_id", masks).join(tests, "seed")
    hits = checkpointed(hits.select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct())
    return _verified(docs, items, hits, similarity)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the documents that hold a passage of a test item; all columns stay as they are, whatever their names.

    All rows of a contaminated id go, null ids are one id.  A null or empty text holds nothing.  An empty benchmark keeps
    all rows, an empty table gives none.  The ids are written, and come to the texts if they are few.
    """
    hidden, back = aside(docs, "doc_id", "text")
    found = checkpointed(contaminated(hidden, benchmark, similarity).select(F.col("doc_id").alias("__found")).distinct())
    return back(hidden.join(small(found), F.col("doc_id").eqNullSafe(F.col("__found")), "left_anti"))


def _hashed(rows: DataFrame) -> DataFrame:
    """The rows with their words, as hashes, in place of the text; an empty text has one empty word."""
    clean = F.regexp_replace(F.lower("text"), "[^\\p{L}\\p{N}]+", " ")
    return rows.withColumn("words", F.transform(F.split(F.trim(clean), " "), lambda w: F.xxhash64(w))).drop("text")


def _seeds(rows: DataFrame, key: str, masks: tuple[tuple[int, ...], ...]) -> DataFrame:
    """(key, seed, at) for every mask and place; a mask that reaches past the last word gives no seed."""

    def seed(i: int, mask: tuple[int, ...], at: Column) -> Column:
        return F.xxhash64(F.lit(i), *(F.get("words", at + o) for o in mask))

    spans = [mask[-1] + 1 for mask in masks]

    def seeds(at: Column) -> Column:
        each = ((span, seed(i, mask, at)) for i, (span, mask) in enumerate(zip(spans, masks, strict=True)))
        return F.array(*(s if span == min(spans) else F.when(at + span <= F.size("words"), s) for span, s in each))

    places = F.sequence(F.lit(0), F.size("words") - min(spans))
    places = F.when(F.size("words") >= SPAN, places).otherwise(F.array().cast("array<int>"))
    # no filter on the length: it would be pushed down and cut every text into words once more
    rows = rows.select(key, F.posexplode(F.flatten(F.transform(places, seeds))).alias("at", "seed"))
    return rows.select(key, "seed", F.floor(F.col("at") / len(masks)).cast("int").alias("at"))


def _verified(docs: DataFrame, items: DataFrame, hits: DataFrame, similarity: float) -> DataFrame:
    shifts = hits.select(F.col("doc_id").alias("id"), "item_id", "shift")
    tests = items.select(F.col("item_id").alias("test"), F.col("words").alias("item_words"))
    rows = docs.select("doc_id", "text").join(shifts, F.col("doc_id").eqNullSafe(F.col("id")))
    rows = _hashed(rows.select("doc_id", "text", "item_id", "shift")).join(tests, F.col("item_id").eqNullSafe(F.col("test")))
    rows = rows.withColumn("low", F.greatest(F.lit(0), -F.col("shift")))
    rows = rows.withColumn("high", F.least(F.size("item_words"), F.size("words") - F.col("shift")) - 1)
    rows = rows.withColumn("window", F.least(F.lit(WINDOW), F.size("item_words")))
    equal = "if(words[t + shift] = item_words[t], 1, 0)"
    fits = "high - low + 1 >= window"
    rows = rows.withColumn("equal", F.expr(f"if({fits}, transform(sequence(low, high), t -> {equal}), array())"))
    sums = "transform(sequence(1, size(equal) - window + 1), s -> aggregate(slice(equal, s, window), 0, (a, x) -> a + x))"
    rows = rows.withColumn("n_equal", F.expr(f"if(size(equal) < window, 0, array_max({sums}))"))
    pairs = rows.groupBy("doc_id", "item_id").agg(F.max("n_equal").cast("long").alias("n_equal"), F.max("window").alias("window"))
    return pairs.where(F.col("n_equal") >= F.ceil(F.col("window") * F.lit(similarity))).drop("window")
