"""A training corpus from ``documents``: language, repeated lines, near duplicates, benchmark passages, mixture.

Each stage takes all documents its predecessor kept. All but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simmart.llm.decontaminate import find_benchmark
from simmart.llm.jaccard_join import PERCENT, WORDS, join_similar
from simmart.llm.language_id import UNKNOWN, fit, identify
from simmart.llm.line_dedup import dedup_lines
from simmart.llm.mixing import mix_sources
from simmart.session import stage

# A document stays when at least this share of its letters is in its language: any, mixed texts are kept.
MIN_SHARE = 0.0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters (null and empty texts among them) go; texts in several languages stay."""
    model = fit(docs, "doc_id", "text", "lang")
    found = identify(docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("row"), "text"), model)
    known = found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_SHARE)) if model.langs else found
    return known.select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three or more documents share go from all but the last; ``n_chars`` follows the new text."""
    found = dedup_lines(docs, carry=tuple(docs.columns))
    own, changed = {c: F.col("carried")[c] for c in docs.columns}, F.col("n_dropped") > 0
    own["text"] = F.when(changed, F.col("kept_text")).otherwise(own["text"])
    if "n_chars" in docs.columns:
        size = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
        own["n_chars"] = F.when(changed, size).otherwise(own["n_chars"])
    return found.select(*(column.alias(c) for c, column in own.items()))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by word shingles the one with the smallest id stays; rows without id stay."""
    found = join_similar(docs.select("doc_id", "text"), words=WORDS, percent=PERCENT)
    gone = found.filter("component_id < doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, give or take a few edits, go."""
    found = find_benchmark(
        docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("row"), "text"),
        spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
    )
    return found.filter(F.size("matches") == 0).select("row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mixture of sources."""
    return mix_sources(docs)


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("mixture", mixture),
]

#: The language model and edit distances have no form in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
