"""Ranking of stored pairs: batches hand on few rows, and the same ones as a sort of all."""

import random

import pytest
from pyspark.sql import functions as F

import simmart as sm
from simmart.operators import similarity

SCHEMA = "chembl_id string, tanimoto_similarity_score double, target_chembl_id string"


@pytest.mark.parametrize("mode", ["within", "boundary"])
def test_top_of_pairs_with_ties_nulls_and_copies(spark, mode):
    rng = random.Random(5)
    rows = [(f"S{rng.randint(0, 400)}é", rng.choice([0.0, 0.25, 0.5, 0.5, 1.0]), f"T{rng.randint(0, 6)}") for _ in range(3000)]
    rows += [("N1", None, "T1"), ("N2", float("nan"), "T2"), (None, 0.5, "T3"), (None, 2.0, "T3"), ("S", 0.1, None), ("only", 0.3, "T9")]
    rows += [("M1", None, "T8"), ("I", float("inf"), "T8"), ("J", float("-inf"), "T8"), ("Z", -0.0, "T8"), ("Y", 0.0, "T8")]
    pairs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for k in (1, 3, 500):
        plain = similarity._rank(pairs.filter("target_chembl_id IS NOT NULL"), k, mode).distinct()
        assert sorted(map(repr, sm.top_k_similar(pairs, k, mode).collect())) == sorted(map(repr, plain.collect()))


def test_batches_hand_on_few_rows(spark):
    pairs = spark.range(50_000).select(
        F.concat(F.lit("S"), "id").alias("chembl_id"), (F.col("id") % 7 / 7).alias("tanimoto_similarity_score"), F.lit("T").alias("target_chembl_id")
    ).coalesce(1)
    assert similarity._first_of_batches(pairs, 11).count() <= 11 * 6
    plan = sm.top_k_similar(pairs)._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("MapInArrow") > plan.rindex("WindowGroupLimit")  # below what sorts


def test_a_new_store_of_buckets_is_written_in_one_go(spark, folder, monkeypatch):
    from simmart.sources import tables

    monkeypatch.setattr(tables, "stage", None)
    rows = [(f"S{i}", i / 50, f"T{i % 9}") for i in range(50)]
    sm.write_pair_buckets(spark.createDataFrame(rows, SCHEMA), f"{folder}/pairs", 4)
    assert sorted(map(tuple, sm.read_pair_buckets(spark, f"{folder}/pairs").collect())) == sorted(rows)
