"""Stupid backoff as joins: n-gram count tables, exploded n-grams, one sum per document.

The score of a word under its longest n-gram that the corpus holds is the score
under its last word alone, plus what each longer n-gram that is held adds.
What an n-gram adds depends on its count and those of the n-grams within it,
not on the place, so it stands in a table partitioned by hash; the exploded
n-grams of the documents are joined to it and summed, in any order.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeledger.llm.tables import WORD
from codeledger.session import checkpointed

#: Logarithms are whole millionths, so that sums do not depend on their order.
MICRO = 1_000_000
ROW = "__row"


def score(docs: DataFrame, order: int = 3, min_count: int = 2, backoff: float = 0.4) -> DataFrame:
    """(doc_id, n_words, n_unigram, score_micro) of every document, as ``lm_scores.score`` defines them.

    Words are cut at ASCII white space and unchanged.  A null, empty or blank text scores 0 with 0 words.
    Repeated rows count each time and each give a row; null ids are kept.  Other
    columns are not read.  Empty table: no rows.  N-grams are told apart by 64-bit hashes.
    """
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    hashes = F.transform(words, lambda w: F.xxhash64(w)).alias("words")
    # written, so that the numbers of rows stay what they are
    rows = checkpointed(docs.select("doc_id", hashes, F.monotonically_increasing_id().alias(ROW)))
    total = rows.agg(F.sum(F.size("words")).alias("n")).first()["n"] or 1
    step = round(MICRO * log(backoff))

    added = _added(_counted(rows, order, min_count), round(MICRO * log(total)), step)
    grams = rows.select(ROW, F.explode(F.concat(*(_keys(n) for n in range(1, order + 1)))).alias("key"))
    sums = grams.join(added, "key").groupBy(ROW).agg(F.sum("adds").alias("adds"), F.count_if("pair").alias("n_pairs"))

    n_words = F.size("words").cast("long")
    full = F.least(n_words, F.lit(order).cast("long"))
    shorter = F.expr("full * (full + 1) div 2") + (F.col("n_words") - F.col("full")) * order - F.col("n_words")
    base = rows.select("doc_id", ROW, n_words.alias("n_words"), full.alias("full"))
    return base.join(sums, ROW, "left").select(
        "doc_id",
        "n_words",
        (F.col("n_words") - F.coalesce("n_pairs", F.lit(0))).alias("n_unigram"),
        (F.coalesce("adds", F.lit(0)) + shorter * step).alias("score_micro"),
    )


def _key(n: int, first: Column) -> Column:
    """Hash of the ``n`` words from ``first``, counted from 1."""
    return F.xxhash64(F.lit(n), F.slice("words", first, F.lit(n)))


def _places(n: int) -> Column:
    return F.when(F.size("words") >= n, F.sequence(F.lit(1), F.size("words") - (n - 1))).otherwise(F.array().cast("array<int>"))


def _keys(n: int) -> Column:
    return F.transform(_places(n), lambda at: _key(n, at))


def _gram(n: int) -> Callable[[Column], Column]:
    def gram(at: Column) -> Column:
        parts = {"key": _key(n, at)}
        if n > 1:
            parts |= {"context": _key(n - 1, at), "rest": _key(n - 1, at + 1)}
        return F.struct(*(key.alias(name) for name, key in parts.items()))

    return gram


def _counted(rows: DataFrame, order: int, min_count: int) -> dict[int, DataFrame]:
    """For each n, the n-grams that are held: (key, context, rest, n_seen); context: all words but the last, rest: all but the first."""
    out = {}
    for n in range(1, order + 1):
        names = ["key"] if n == 1 else ["key", "context", "rest"]
        counts = rows.select(F.inline(F.transform(_places(n), _gram(n)))).groupBy(*names).agg(F.count(F.lit(1)).alias("n_seen"))
        out[n] = checkpointed(counts.where(F.col("n_seen") >= min_count) if n > 1 else counts)
    return out


def _added(counts: dict[int, DataFrame], all_words: int, step: int) -> DataFrame:
    """(key, adds, pair): what each held n-gram adds to a document's sum where it stands."""

    def own() -> Column:
        return F.round(MICRO * F.log("n_seen")).cast("long")

    value = counts[1].select("key", (own() - all_words).alias("value"))
    added = value.select("key", F.col("value").alias("adds"), F.lit(False).alias("pair"))
    for n in list(counts)[1:]:
        contexts = counts[n - 1].select(F.col("key").alias("context"), own().alias("context_log"))
        rests = value.select(F.col("key").alias("rest"), F.col("value").alias("rest_value"))
        value = counts[n].join(contexts, "context").join(rests, "rest")
        value = value.select("key", (own() - F.col("context_log")).alias("value"), "rest_value")
        adds = F.col("value") - F.col("rest_value") - step
        added = added.union(value.select("key", adds.alias("adds"), F.lit(n == 2).alias("pair")))
    return checkpointed(added)
