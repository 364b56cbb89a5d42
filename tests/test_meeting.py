"""Blocks that meet by shuffle: what leaves a task, and how often rows travel."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import simmart as sm
from simmart.operators import meeting, postings, similarity
from simmart.session import stage
from tests.test_similarity import TARGET, brute, frames
from tests.test_strategies import pairs_of, plan_of


def near_copies():
    rng = random.Random(4)
    base = [set(rng.sample(range(300), rng.randint(1, 60))) for _ in range(12)]
    return [b ^ set(rng.sample(range(300), rng.randint(0, 8))) for b in base for _ in range(5)] + [set(base[0])] * 3


def test_only_pairs_with_the_score_leave_the_posting_lists(spark, monkeypatch):
    monkeypatch.setattr(postings, "OUT_ROWS", 5)
    sets = near_copies()
    fps = spark.createDataFrame([(f"s{i}", sorted(s)) for i, s in enumerate(sets)], "chembl_id string, on array<int>")
    want = sum(bool(a | b) and len(a & b) / len(a | b) >= 0.6 for a in sets for b in sets)
    one, other = (postings._rows(fps, "chembl_id", 300) for _ in range(2))
    found = postings.candidates(one, other, 0.6, 300).select("source", "target").collect()
    assert len(found) == len(set(found)) == want


def test_all_scores_by_blocks_merge_only_pairs_of_repeated_ids(spark):
    fps, tgt = frames(spark)
    once = tgt.filter(~F.col(TARGET).isin("T2", "T4"))
    assert "HashAggregate" not in plan_of(sm.score_targets(once, stage(fps, "fps"), strategy="blocks", max_block=20))
    twice = fps.union(fps.filter("chembl_id < 'CHEMBL3'").withColumn("on", F.array(F.lit(7), F.lit(8))))
    assert pairs_of(sm.score_targets(tgt, twice, strategy="blocks", max_block=20)) == pairs_of(sm.score_targets(tgt, twice))


@pytest.mark.parametrize("floor", [0.0, 0.05, 1 / 3, 1.0])
def test_rows_at_or_above_a_floor(floor):
    rng = random.Random(1)
    sets = [set(rng.sample(range(200), rng.randint(0, 90))) for _ in range(300)]
    sets += [set(sets[3]), set(range(200))]
    lists = pa.array([sorted(s) for s in sets], pa.list_(pa.int32()))
    names = pa.array([f"s{i:03}" for i in range(len(sets))])
    batch = similarity._Batch(pa.RecordBatch.from_arrays([names, lists], names=["id", "fp"]), 200)
    block = similarity._target_block(pa.table({"id": names[:40], "fp": lists[:40]}), 200)
    for t, own in enumerate(sets[:40]):
        at, scores = batch.best(block, t, 20, 290, floor, 0.0)
        got = dict(zip((batch.ids[int(20 + i)].as_py() for i in at), scores.tolist()))
        among = (int(batch.ids[i].as_py()[1:]) for i in range(20, 290))
        score = {i: len(own & sets[i]) / len(own | sets[i]) if own | sets[i] else 0.0 for i in among}
        assert got == {f"s{i:03}": s for i, s in score.items() if s >= floor}


def test_rows_travel_to_a_bounded_number_of_blocks():
    assert [meeting.block_count(n, 10, 100) for n in (0, 1, 10, 11, 120, 121, 1200, 1300)] == [1, 1, 1, 2, 12, 12, 12, 13]
    assert meeting.block_count(3_000_000, 20_000, 200_000) == 15
