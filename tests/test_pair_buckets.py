import os

import pytest

import simmart as sm


def frame(spark, rows):
    return spark.createDataFrame(rows, "chembl_id string, tanimoto_similarity_score double, target_chembl_id string")


def kept(spark, where, target=None):
    return sorted(map(tuple, sm.read_pair_buckets(spark, where, target).collect()))


def test_targets_are_replaced_and_others_stay(spark, folder):
    where = f"{folder}/pairs"
    first = [(f"S{i}", i / 100, f"T{t}") for t in range(40) for i in range(5)]
    sm.write_pair_buckets(frame(spark, first + [("S", 0.5, None)]), where, 8)
    assert kept(spark, where) == sorted(first)
    second = [("S0", 0.9, f"T{t}") for t in range(35, 45)]
    for _ in range(2):  # again after a lost run
        sm.write_pair_buckets(frame(spark, second), where, 8)
        assert kept(spark, where) == sorted([r for r in first if int(r[2][1:]) < 35] + second)
    assert len(os.listdir(f"{where}/of=8")) <= 8
    with pytest.raises(ValueError, match="another number of buckets"):
        sm.write_pair_buckets(frame(spark, second), where, 9)


def test_untouched_buckets_are_not_written(spark, folder):
    where = f"{folder}/pairs"
    sm.write_pair_buckets(frame(spark, [("S", 0.1, f"T{t}") for t in range(200)]), where, 16)
    before = {name: sorted(os.listdir(f"{where}/of=16/{name}")) for name in os.listdir(f"{where}/of=16")}
    sm.write_pair_buckets(frame(spark, [("S", 0.2, "T7")]), where, 16)
    after = {name: sorted(os.listdir(f"{where}/of=16/{name}")) for name in before}
    assert len(before) == 16 and sum(before[name] != after[name] for name in before) == 1


def test_a_lookup_reads_one_bucket(spark, folder):
    where = f"{folder}/pairs"
    rows = [(f"S{i}", 0.5, f"T{t}") for t in range(300) for i in range(3)]
    sm.write_pair_buckets(frame(spark, rows), where, 16)
    found = sm.read_pair_buckets(spark, where, "T123")
    assert sorted(map(tuple, found.collect())) == [(f"S{i}", 0.5, "T123") for i in range(3)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(target_chembl_id), EqualTo(target_chembl_id,T123)]" in plan
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert kept(spark, where, "nobody") == []
