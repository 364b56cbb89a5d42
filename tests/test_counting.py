"""Counters of common on-bits: the rows that reach a floor, and the k best of blocks, against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import simmart as sm
from simmart.functions.packing import pack
from simmart.operators import counting, meeting, postings, similarity
from tests.test_similarity import TARGET, brute_top, top_of


def mixed_sets(n=700, seed=3):
    rng = random.Random(seed)
    sets = [set(rng.sample(range(200), rng.choice([1, 3, 20, 40, 60, 150]))) | set(rng.sample(range(20), 6)) for _ in range(n)]
    sets += [s ^ set(rng.sample(range(200), rng.randint(0, 4))) for s in sets[:80]]
    return [s for s in sets if s]


def packed(sets):
    words = pack(pa.array([sorted(s) for s in sets], pa.list_(pa.int32())), 200)
    return words, np.bitwise_count(words).sum(axis=1, dtype=np.int64)


def small_parts(monkeypatch):
    for name, value in (("SEGMENT", 128), ("TOGETHER", 5), ("VERIFIED", 7), ("CHUNK", 64), ("ADDED", 100)):
        monkeypatch.setattr(counting, name, value)


def test_bitmaps_are_the_bits_of_the_rows():
    words, _ = packed(mixed_sets())
    words = np.ascontiguousarray(words)
    bits = np.unpackbits(words.view(np.uint8).reshape(len(words), -1), axis=1, bitorder="little")
    found = np.unpackbits(counting.row_bitmaps(words).view(np.uint8), axis=1, bitorder="little")
    assert (found[:, : len(words)] == bits.T).all() and not found[:, len(words) :].any()


@pytest.mark.parametrize("floor", [1e-300, 0.1, 1 / 3, 0.8, 1.0, None])
def test_all_rows_that_reach_the_floor(monkeypatch, floor):
    small_parts(monkeypatch)
    added = []
    monkeypatch.setattr(counting.Counters, "_add", lambda self, *a, add=counting.Counters._add: added.append(1) or add(self, *a))
    sets = sorted(mixed_sets(), key=len)
    words, pops = packed(sets)
    targets = random.Random(5).sample(range(len(sets)), 60)
    floors = np.full(60, floor) if floor else np.random.default_rng(1).uniform(0.05, 0.9, 60)
    found = counting.Counters(words, pops).search(words[targets], pops[targets], floors)
    got = [(t, r, c) for part in found for t, r, c in zip(*(x.tolist() for x in part))]
    want = {
        (t, r, len(sets[own] & s)) for t, own in enumerate(targets) for r, s in enumerate(sets)
        if len(sets[own] & s) / len(sets[own] | s) >= floors[t]
    }
    assert len(got) == len(want) and set(got) == want and added


@pytest.mark.parametrize("mode", ["within", "boundary"])
@pytest.mark.parametrize("copies", [False, True])
def test_best_of_blocks(spark, monkeypatch, mode, copies):
    small_parts(monkeypatch)
    monkeypatch.setattr(similarity, "SEED_ROWS", 20)
    sets = mixed_sets(150) + [set(), set(), {199}]
    rows = [(f"s{i // 2 if copies and i < 60 else i}", sorted(s)) for i, s in enumerate(sets)]
    fps = spark.createDataFrame(rows, "chembl_id string, on array<int>")
    targets = fps.withColumnRenamed("chembl_id", TARGET)
    pairs = {}
    for a, one in rows:
        for b, other in rows:
            if a != b:
                score = len(set(one) & set(other)) / len(set(one) | set(other)) if one or other else 0.0
                pairs[a, b] = max(score, pairs.get((a, b), 0.0))
    want = brute_top(pairs, 10, mode)
    rows = 60 if mode == "boundary" else 100_000  # of a block
    got = sm.score_top_k(targets, fps, 10, mode, include_self=False, n_bits=200, max_block=rows, strategy="blocks")
    assert top_of(got) == want


def test_a_target_is_not_compared_with_every_row():
    rng = np.random.default_rng(2)
    words = np.packbits(rng.random((20_000, 2048)) < 0.06, axis=1).view(np.uint64)
    compared = []
    table = pa.table({"id": [f"s{i:05}" for i in range(20_000)], "fp": list(words.view(np.int64)), "floor": np.zeros(20_000)})
    table = table.set_column(1, "fp", table["fp"].cast(pa.list_(pa.int64())))
    common, pairs = similarity._Batch.common, counting.Counters._common
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(similarity._Batch, "common", lambda self, q, low, high: compared.append(high - low) or common(self, q, low, high))
        patch.setattr(counting.Counters, "_common", lambda self, a, b: compared.append(len(a)) or pairs(self, a, b))
        out = list(similarity._top_k_of_blocks(2048, 10, 0.0, False)(table, table.slice(0, 100)))
    assert sum(b.num_rows for b in out) == 1_000
    assert sum(compared) < 100 * 20_000 / 4


def test_only_blocks_that_may_reach_the_score_meet(spark, monkeypatch):
    """Rows used to travel to every block of the other side, whatever their number of on-bits."""
    rng = random.Random(8)
    sets = [set(rng.sample(range(300), n)) for n in range(10, 210) for _ in range(2)] + [set(), set()]
    fps = spark.createDataFrame([(f"s{i}", sorted(s)) for i, s in enumerate(sets)], "chembl_id string, on array<int>")
    rows = postings._rows(fps, "chembl_id", 300)
    monkeypatch.setattr(postings, "LIST_ROWS", 40)
    monkeypatch.setattr(postings, "LEAST_ROWS", 40)
    met = []
    monkeypatch.setattr(meeting, "_met", lambda df, *_: met.append(df) or df)
    postings.candidates(rows, rows, 0.8, 300)
    assert met[0].count() < 2 * len(sets) * 11 / 2  # of 11 blocks on either side
    sides = met[0].groupBy("s", "t").agg(F.collect_set(F.when(F.col("is_left"), F.col("id"))).alias("a"), F.collect_set(F.when(~F.col("is_left"), F.col("id"))).alias("b"))
    together = {(a, b) for r in sides.collect() for a in r.a for b in r.b}
    near = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if min(len(a), len(b)) >= 0.8 * max(len(a), len(b))}
    assert all((f"s{i}", f"s{j}") in together for i, j in near)
