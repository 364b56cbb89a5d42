"""Rows that earlier forms of the operators lost or stopped at."""

import time

import corpus_pipeline
from pyspark.sql import functions as F

from simmart.llm.binary_topk import nearest_codes
from simmart.llm.blocks import in_chunks
from simmart.llm.chat_format import BY_PRINT, MAPPINGS, fingerprint, format_chats, json_layout, read_loss, read_turns
from simmart.llm.language_id import fit, identify
from simmart.llm.substring_dedup import dedup_windows
from tests.llm import brute


def test_topk_of_queries_that_are_no_rows(spark):
    rows = spark.createDataFrame([(1, 0), (2, 3), (3, 7)], "vec_id long, code long")
    queries = spark.createDataFrame([(2, 3), (9, -1)], "vec_id long, code long")
    got = [tuple(r) for r in nearest_codes(rows, queries).orderBy("query_id", "rank").collect()]
    assert got == [(2, 1, 3, 1), (2, 2, 1, 2), (9, 1, 3, 61), (9, 2, 2, 62), (9, 3, 1, 64)]


def test_chunks_of_any_id(spark):
    ids = [-(2**63), 2**63 - 1, 0, -5, *((i * 0x9E3779B97F4A7C15 + 2**63) % 2**64 - 2**63 for i in range(2000))]
    docs = spark.createDataFrame([(i, "some words of a text " * 5) for i in ids], "doc_id long, text string")
    chunks, layout = in_chunks(docs, "doc_id", "text", ordered=True, chunk_bytes=200)
    rows = sorted((r.id, r.chunk) for r in chunks.select("id", "chunk").collect())
    assert layout.chunks > 500 and len({c for _, c in rows}) > 500
    assert [c for _, c in rows] == sorted(c for _, c in rows)
    found = {r.doc_id: r.n_removed for r in dedup_windows(docs.limit(50)).collect()}
    want = brute.windows([(r.doc_id, r.text) for r in docs.limit(50).collect()])
    assert found == {i: removed for (i, _), (_, removed, _) in want.items()}


def test_stages_with_their_own_names_as_columns(spark, tmp_path):
    text = "this line stands in all of these documents\nand this one "
    docs = spark.createDataFrame(
        [(i, text + " ".join(f"has{i}x{k}" for k in range(40)), "en", "s", 9, 1, "a", "b", "c") for i in range(6)],
        "doc_id long, text string, lang string, source string, n_chars long, n_dropped long, _kept string, carried string, kept_text string",
    )
    spark.createDataFrame([(0, "no such passage in any text")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() == 6, name
        assert {(r.n_dropped, r._kept, r.carried, r.kept_text) for r in out.collect()} == {(1, "a", "b", "c")}


def test_language_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "hello there", "en", 1, 2, 3)], "doc_id long, text string, lang string, found int, letters int, _found int")
    got = identify(docs, fit(docs, "doc_id", "text", "lang")).collect()[0]
    assert (got.found, got.letters, got._found, got.lang_pred) == (1, 2, 3, "en")


def test_long_conversation_is_read_in_linear_time(spark):
    n = 100_000
    said = F.concat(F.lit("﻿😀 turn [INST] "), F.col("id"), F.lit(" text" * 20))
    role = F.when(F.col("id") % 2 == 0, "user").otherwise("assistant")
    turns = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text"))
    chats = format_chats(turns).cache()
    started = time.time()
    read = chats.select(
        F.sha2(F.array_join(read_loss(F.col("formatted"), F.col("loss_spans")), ""), 256).alias("loss"),
        F.size(read_turns(F.col("formatted"))).alias("n"),
    ).collect()[0]
    assert time.time() - started < 60
    want = "".join(f"﻿😀 turn [INST] {i}" + " text" * 20 for i in range(1, n, 2))
    assert (read.n, read.loss) == (n, brute.sha(want))


def test_fingerprints_name_the_mappings(spark):
    records = ['{"messages": [{"role": "user", "content": "a"}]}', '{"prompt": "a", "response": "b"}', '{"other": 1}']
    prints = [r.p for r in spark.createDataFrame([(r,) for r in records], "j string").select(fingerprint(json_layout(F.col("j"))).alias("p")).collect()]
    assert [getattr(BY_PRINT.get(p), "name", None) for p in prints] == ["messages", "prompt", None]
    assert len(BY_PRINT) == len(MAPPINGS)
