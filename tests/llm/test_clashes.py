"""Stages on tables whose columns are named like those the operators use inside, and like their results."""

import pytest
from pyspark.sql import functions as F

from codeledger.llm import decontamination, near_copies, quality, substring_dedup

PASSAGE = " ".join(f"word{i}" for i in range(40))
OTHER = " ".join(f"other{i}" for i in range(40))
TEXTS = [(1, PASSAGE), (2, PASSAGE + " end"), (3, OTHER), (4, None), (4, ""), (None, OTHER + " x"), (None, OTHER + " x")]


def table(llm, names):
    """Rows with a text column for each of ``names``, after and before the usual ones."""
    rows = llm.createDataFrame([(i, t, "en", "s") for i, t in TEXTS], "doc_id long, text string, lang string, source string").repartition(3)
    for n, name in enumerate(names):
        rows = rows.withColumn(name, F.concat(F.lit(f"own{n}-"), F.coalesce(F.length("text").cast("string"), F.lit("none"))))
    return rows.select(*names[::2], "doc_id", "text", "lang", "source", *names[1::2])


STAGES = {
    "quality": (quality.keep_good, "n_words kept base_failed word_chars n_symbols n_dup_lines n_repeat_words __words __lines __runs __n_lines __symbols __symbols_low __lang __source below total bin n m measure value low high"),
    "near": (near_copies.keep_first, "__gone component_id node component near a b first piece words shingles key lo hi c0 c1 c2 c3 run"),
    "repeats": (lambda d: substring_dedup.remove_repeats(d), "__shard __part keys checks earlier"),
    "leaks": (None, "__found words seed at item_at item_id shift id test low high window equal n_equal _extra_0"),
}


@pytest.mark.parametrize("name", sorted(STAGES))
def test_columns_of_the_caller_come_back(llm, name):
    stage, names = STAGES[name]
    names = names.split()
    if stage is None:
        benchmark = llm.createDataFrame([(7, OTHER)], "item_id long, text string")
        stage = lambda docs: decontamination.remove_contaminated(docs, benchmark)
    docs = table(llm, names)
    found, plain = stage(docs), stage(table(llm, []))
    assert [c for c in found.columns if c in docs.columns] == docs.columns
    key = ["doc_id", "text"]
    assert sorted(map(str, found.select(key).collect())) == sorted(map(str, plain.select(key).collect()))
    # every row still has the values it came with
    given = {(r.doc_id, tuple(r[n] for n in names)) for r in docs.collect()}
    rows = found.collect()
    assert rows and {(r.doc_id, tuple(r[n] for n in names)) for r in rows} <= given
    assert stage(docs.limit(0)).count() == 0


def test_what_the_stages_do_with_nulls_and_repeats(llm):
    docs = table(llm, ["__found", "__gone"])
    good = quality.keep_good(docs).collect()
    assert sorted(str(r.doc_id) for r in good) == ["1", "2", "3", "None", "None"]
    benchmark = llm.createDataFrame([(7, OTHER)], "item_id long, text string")
    left = decontamination.remove_contaminated(docs, benchmark).collect()
    assert sorted(str(r.doc_id) for r in left) == ["1", "2", "4", "4"]
    assert decontamination.remove_contaminated(docs, benchmark.limit(0)).count() == len(TEXTS)
    kept = near_copies.keep_first(docs).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "3", "4", "4", "None", "None"]


def test_texts_are_measured_once_and_not_shuffled(llm, monkeypatch):
    docs = table(llm, [])
    calls = []
    real = quality.measured
    monkeypatch.setattr(quality, "measured", lambda rows: calls.append(1) or real(rows))
    plan = quality.keep_good(docs)._jdf.queryExecution().executedPlan().toString()
    assert calls == [1] and "__words" not in plan and "Exchange hashpartitioning" not in plan
    benchmark = llm.createDataFrame([(7, OTHER)], "item_id long, text string")
    for left in (decontamination.remove_contaminated(docs, benchmark), near_copies.keep_first(docs)):
        assert "Exchange hashpartitioning" not in left._jdf.queryExecution().executedPlan().toString()
