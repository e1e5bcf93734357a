"""The registered queries over the smallest given tables, against their SQL."""

import pytest

import __spark_entry__ as contract
from codeledger.llm import queries
from oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(llm, duck, name):
    assert compare(llm, duck, SF_DIR, queries.QUERIES[name], queries.ORACLE[name]) is None


def test_quality_sql_reaches_as_far_as_the_operator(llm, tmp_path):
    """Long words in groups whose quartiles share a wide bin: none of them may go."""
    rows = [(g * 10 + i, " ".join(chr(0x4E00 + k) * (51 + 49 * g + i) for k in range(24)), "ja", f"s{g}", 0) for g in range(3) for i in range(g * 4 + 1)]
    rows += [(1000 + i, "a b c " * (9 + i), None, None, 0) for i in range(5)] + [(2000, None, "ja", "s0", 0), (2001, "", None, None, 0)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(1).write.parquet(str(tmp_path / "w"))
    (next((tmp_path / "w").glob("*.parquet"))).rename(tmp_path / "documents.parquet")
    name = "op8_adaptive_quality"
    assert compare(llm, connect(str(tmp_path)), str(tmp_path), queries.QUERIES[name], queries.ORACLE[name]) is None


ROWS = {
    "op2_sentencepiece_spans": "documents",
    "op4_quotation_links": "conversations",
    "op5_bit_sliced_simhash": "documents",
    "op9_seekable_token_frames": "documents",
    "op13_license_scan": "documents",
}


@pytest.mark.parametrize("name", sorted(ROWS))
def test_query_returns_every_row(llm, duck, name):
    found = queries.QUERIES[name](llm, SF_DIR).count()
    assert found == duck.execute(f"select count(*) from {ROWS[name]}").fetchone()[0]


def test_every_query_is_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(queries.ORACLE) <= set(contract.oracle_sql())


def test_native_operators_run_no_python(llm):
    for name in ("op3_redirect_equivalence", "op7_spaced_seed_decontamination", "op8_adaptive_quality"):
        plan = queries.QUERIES[name](llm, SF_DIR)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
