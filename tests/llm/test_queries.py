"""The registered queries against SQL or brute force on the smallest tables."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from simmart.llm import queries
from simmart.llm.decontaminate import normal
from simmart.llm.language_id import fit, identify
from tests.llm import brute
from tools.compare import compare, connect

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    assert set(queries.QUERIES) <= set(entry.queries()) and set(queries.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_and_sql(spark, name):
    ok, text = compare(spark, connect(SF), name, SF)
    assert ok, text


@pytest.fixture(scope="module")
def rows(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def test_byte_query(spark, rows):
    want = brute.strings(rows)
    for r in queries.QUERIES["op5_suffix_dedup"](spark, SF).collect():
        ((n, removed, spans, kept),) = want[r.doc_id, next(t for i, t in rows if i == r.doc_id).encode()]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, removed, spans, brute.sha(kept))


def test_jaccard_query(spark, rows):
    want = brute.similar(rows, 4, 85)
    assert {r.doc_id: r.component_id for r in queries.QUERIES["op10_ngram_jaccard"](spark, SF).collect()} == want


def test_benchmark_query(spark, rows):
    items = [normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    exact = {i for i, t in rows if any(x in normal(t) for x in items)}
    found = queries.QUERIES["op4_decontamination"](spark, SF).collect()
    assert exact and {r.doc_id for r in found if r.distance == 0} == exact


def test_other_queries_return_all_rows(spark, rows):
    for name in ("op1_token_counts", "op2_source_mixing", "op7_language_id"):
        assert sorted(r.doc_id for r in queries.QUERIES[name](spark, SF).collect()) == sorted(i for i, _ in rows)


def test_pipeline(spark, rows):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    found = identify(table, fit(table, "doc_id", "text", "lang")).collect()
    kept = [(r.doc_id, r.text) for r in found if r.lang_pred != "und" and r.score >= corpus_pipeline.MIN_SHARE]
    lines = brute.lines(kept)
    kept = [(i, lines[i, t.encode()][2].decode()) for i, t in kept]
    first = brute.similar(kept, 5, 80)
    kept = [(i, t) for i, t in kept if first[i] == i]
    items = [normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = sorted((i, t) for i, t in kept if not any(x in normal(t) for x in items))
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.text) for r in got) == want
    assert len({r.mix_slot for r in got}) <= len(got)
