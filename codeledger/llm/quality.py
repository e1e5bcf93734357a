"""Quality rules with thresholds that follow each language and source.

Every measure is put into bins of bounded relative width; the counts per bin
are a quantile sketch that merges by addition.  Quartiles of the sketch of a language
and source set the limits that documents of it must keep.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codeledger.llm.tables import aside, small
from codeledger.session import checkpointed

SPACES = " \t\n\x0b\x0c\r"
GAP = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
RUN = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Measures and the least quartile distance that their limits allow for.
MEASURES = {"symbols": 50, "dup_lines": 150, "repeats": 50, "word_length": 60}
#: A limit lies this many quartile distances beyond a quartile.
REACH = 3
#: Numbers below are bins of their own; above, a bin spans a sixteenth of its value.
EXACT_BELOW = 32

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the base measures, base_failed, and the integer measures that are judged.

    Words are cut at ASCII white space, lines at \\n.  A null or empty text has
    no words, so base_failed is true.  Other columns pass through; one
    named like a measure is replaced.
    """
    passed = [c for c in docs.columns if c.lower() not in {*BASE, "kept"}]
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACES))
    rows = docs.select(
        *passed,
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP)).alias("__words"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("__lines"),
        F.char_length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
    )
    hashes = ", ".join(f"__words[i + {k}]" for k in range(RUN))
    rows = rows.select(
        *passed,
        "n_symbols",
        F.size("__words").cast("long").alias("n_words"),
        F.char_length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.size("__lines").cast("long").alias("__n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            f"if(size(__words) < {RUN}, array(), transform(sequence(0, size(__words) - {RUN}), i -> xxhash64({hashes})))"
        ).alias("__runs"),
    )
    # only texts with an equal pair are sorted: places of equal runs come to lie side by side
    pairs = "array_sort(transform(__runs, (x, i) -> struct(x as h, i as at)))"
    rows = rows.withColumn("__runs", F.expr(f"if(size(array_distinct(__runs)) = size(__runs), null, {pairs})"))
    twice = "(i > 0 and __runs[i - 1].h = x.h) or (i < size(__runs) - 1 and __runs[i + 1].h = x.h)"
    places = f"array_sort(transform(filter(__runs, (x, i) -> {twice}), x -> x.at))"
    covered = (
        f"aggregate({places}, struct(0L as n, 0 as stop), (s, at) -> "
        f"struct(s.n + at + {RUN} - greatest(at, s.stop) as n, at + {RUN} as stop), s -> s.n)"
    )
    rows = rows.withColumn("n_repeat_words", F.when(F.col("__runs").isNull(), F.lit(0).cast("long")).otherwise(F.expr(covered)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    words = "greatest(n_words, 1)"
    measures = {
        "symbols": f"n_symbols * 1000 div {words}",
        "dup_lines": "n_dup_lines * 1000 div greatest(__n_lines, 1)",
        "repeats": f"n_repeat_words * 1000 div {words}",
        "word_length": f"word_chars * 100 div {words}",
    }
    return rows.withColumn("base_failed", failed).select(
        *passed, *BASE, *(F.expr(sql).alias(f"__{name}") for name, sql in measures.items())
    )


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, measure, bin, n) of the documents that pass the base rules.

    Sketches of more documents are the sums of n.
    """
    each = F.array(*(F.struct(F.lit(m).alias("measure"), F.col(f"__{m}").alias("value")) for m in MEASURES))
    # counted, not filtered: a filter would be pushed down and measure every text once more
    rows = rows.select("lang", "source", "base_failed", F.explode(each).alias("m"))
    rows = rows.select("lang", "source", "base_failed", "m.measure", _bin(F.col("m.value")).alias("bin"))
    counted = rows.groupBy("lang", "source", "measure", "bin").agg(F.count_if(~F.col("base_failed")).alias("n"))
    return counted.where("n > 0")


def _bin(value: Column) -> Column:
    """The least number of the bin that holds ``value``: its five leading binary digits."""
    return F.when(value < EXACT_BELOW, value).otherwise(value - value % _width(value))


def _width(value: Column) -> Column:
    """How many numbers the bin of ``value`` holds."""
    return F.pow(F.lit(2), F.greatest(F.char_length(F.bin(value)) - 5, F.lit(0))).cast("long")


def thresholds(sketch: DataFrame) -> DataFrame:
    """(lang, source) and, for each measure, its low and high limit.

    The quartiles are lower edges of bins, so a limit lies at least a bin's width beyond: all of the
    bin that holds the upper quartile is within.
    """
    group = ["lang", "source", "measure"]
    so_far = Window.partitionBy(*group).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    rows = sketch.withColumn("below", F.sum("n").over(so_far))
    rows = rows.withColumn("total", F.sum("n").over(Window.partitionBy(*group)))
    rows = rows.groupBy(*group).agg(
        F.min(F.expr("if(4 * below >= total, bin, null)")).alias("q1"),
        F.min(F.expr("if(4 * below >= 3 * total, bin, null)")).alias("q3"),
    )
    floor = F.expr("case measure " + " ".join(f"when '{m}' then {v}" for m, v in MEASURES.items()) + " end")
    spread = F.greatest(REACH * F.greatest(F.col("q3") - F.col("q1"), floor), _width(F.col("q3")))
    rows = rows.select(*group, (F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high"))
    limits = [
        F.max(F.when(F.col("measure") == m, F.col(side))).alias(f"__{m}_{side}") for m in MEASURES for side in ("low", "high")
    ]
    return rows.groupBy("lang", "source").agg(*limits)


def judged(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """``rows`` of ``measured`` with kept: the base rules and every limit of the language and source.

    Null languages and sources are groups of their own.
    """
    limits = limits.withColumnsRenamed({"lang": "__lang", "source": "__source"})
    same = F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source"))
    within = ~F.col("base_failed")
    for m in MEASURES:
        within &= F.col(f"__{m}").between(F.col(f"__{m}_low"), F.col(f"__{m}_high"))
    joined = rows.join(limits, same, "left").withColumn("kept", F.coalesce(within, F.lit(False)))
    return joined.select(*[c for c in rows.columns if not c.startswith("__")], "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with the columns of ``docs`` as they are, whatever their names.

    A null or empty text has no words and goes.  Repeated rows are judged one by one, and alike.  An empty table gives no rows.
    The measures are taken once and written beside the texts; the limits, a row per language and source, come to them.
    """
    hidden, back = aside(docs, "text", "lang", "source")
    rows = checkpointed(measured(hidden))
    limits = checkpointed(thresholds(sketches(rows)))
    return back(judged(rows, small(limits)).where("kept"))
