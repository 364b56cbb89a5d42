"""The strategies of scoring give the rows of one scan, and move what they say."""

import random

import pytest
from pyspark.sql import functions as F

import simmart as sm
from simmart.operators import postings
from simmart.session import stage
from tests.test_similarity import TARGET, brute, brute_top, frames, top_of


def pairs_of(df):
    rows = df.collect()
    found = {(r.chembl_id, r[TARGET]): r.tanimoto_similarity_score for r in rows}
    assert len(found) == len(rows)
    return found


def forms(fps, tgt, form):
    column = {"on": F.col("on"), "words": sm.bits_pack(F.col("on")), "morgan_fingerprint": sm.bits_encode(F.col("on"))}[form]
    return fps.select("chembl_id", column.alias(form)), tgt.select(TARGET, column.alias(form))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("form, empty_score", [("on", 0.0), ("words", 1.0), ("morgan_fingerprint", 0.0)])
def test_postings(spark, monkeypatch, form, empty_score):
    monkeypatch.setattr(postings, "LIST_ROWS", 7)  # many cuts of a list
    fps, tgt = forms(*frames(spark), form)
    for least in (0.01, 1 / 3):
        expected = {k: v for k, v in brute(empty=empty_score).items() if v >= least}
        assert pairs_of(sm.score_targets(tgt, fps, empty_score, min_score=least, strategy="postings")) == expected
    expected = {k: v for k, v in brute(empty=empty_score, include_self=False).items() if v >= 0.25}
    assert pairs_of(sm.score_targets(tgt, fps, empty_score, include_self=False, min_score=0.25, strategy="postings")) == expected


def test_postings_on_random_sets(spark):
    rng = random.Random(2)
    base = [set(rng.sample(range(300), rng.randint(1, 60))) for _ in range(30)]
    sets = [b ^ set(rng.sample(range(300), rng.randint(0, 8))) for b in base for _ in range(6)]
    fps = spark.createDataFrame([(f"s{i}", sorted(s)) for i, s in enumerate(sets)], "chembl_id string, on array<int>")
    own = fps.withColumnRenamed("chembl_id", TARGET)
    for least in (0.3, 0.8):
        want = {}
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                score = len(a & b) / len(a | b) if a | b else 0.0
                if score >= least:
                    want[f"s{i}", f"s{j}"] = score
        assert pairs_of(sm.score_targets(own, fps, n_bits=300, min_score=least, strategy="postings")) == want
    rows = postings._rows(fps, "chembl_id", 300)
    assert postings.candidates(rows, rows, 0.7, 300).count() < len(sets) ** 2 / 5
    for bad in (0.0, 1.5):
        with pytest.raises(ValueError):
            sm.score_targets(own, fps, min_score=bad, strategy="postings")


@pytest.mark.parametrize("rows", [20, 1000])
def test_blocks(spark, rows):
    fps, tgt = frames(spark)
    assert pairs_of(sm.score_targets(tgt, fps, strategy="blocks", max_block=rows)) == brute()
    for mode in ("within", "boundary"):
        assert top_of(sm.score_top_k(tgt, fps, 10, mode, strategy="blocks", max_block=rows)) == brute_top(brute(), 10, mode)
    got = sm.score_top_k(tgt, fps, 3, include_self=False, strategy="blocks", max_block=rows)
    assert top_of(got) == brute_top(brute(include_self=False), 3)
    assert sm.score_top_k(tgt.filter("false"), fps, strategy="blocks").count() == 0
    for call in (sm.score_targets, sm.score_top_k):
        with pytest.raises(ValueError):
            call(tgt, fps, strategy="other")


def test_pairs_are_shuffled_only_for_repeated_ids(spark):
    fps, tgt = frames(spark)
    fps = stage(fps, "fps")
    assert "Exchange" not in plan_of(sm.score_targets(tgt, fps))
    assert pairs_of(sm.score_targets(tgt, fps)) == brute()
    twice = fps.union(fps.filter("chembl_id < 'CHEMBL3'").withColumn("on", F.array(F.lit(7), F.lit(8))))
    found = pairs_of(sm.score_targets(tgt, twice))
    assert set(found) == set(brute()) and all(found[p] >= v for p, v in brute().items())
    assert found["CHEMBL2", "T1"] == 1.0
    # a name with very many structures is cut, and its pairs are merged
    assert pairs_of(sm.score_targets(tgt, fps, max_block=3)) == brute()


@pytest.mark.parametrize("k, mode, form", [(1, "within", "on"), (10, "boundary", "words"), (500, "within", "morgan_fingerprint")])
def test_bands(spark, folder, k, mode, form):
    fps, tgt = frames(spark)
    store = f"{folder}/store"
    sm.write_bands(fps.withColumn("pop", F.size("on")), store, rows_per_band=10)
    top, read = sm.search_bands(spark, forms(fps, tgt, form)[1], store, k, mode, max_block=3)
    assert top_of(top) == brute_top(brute(), k, mode)
    assert read.count() == len({t for _, t in brute()})
    if k == 10:
        got, _ = sm.search_bands(spark, tgt, store, k, mode, include_self=False, empty_score=1.0)
        assert top_of(got) == brute_top(brute(empty=1.0, include_self=False), k, mode)


def test_bands_that_are_not_needed_are_not_read(spark, folder):
    rng = random.Random(6)
    rows = [(f"s{i:04}", sorted(rng.sample(range(2048), 10 + i))) for i in range(1000)]
    fps = spark.createDataFrame(rows, "chembl_id string, on array<int>").withColumn("pop", F.size("on"))
    store = f"{folder}/store"
    sm.write_bands(fps, store, rows_per_band=20)
    own = fps.filter("pop % 100 = 0").withColumnRenamed("chembl_id", TARGET)
    top, read = sm.search_bands(spark, own, store, k=1)
    assert {(r.source_chembl_id, r[TARGET]) for r in top.collect()} == {(r[TARGET], r[TARGET]) for r in own.collect()}
    bands = {r.bands for r in read.collect()}
    assert max(bands) < 25  # of 50
    empty, none = sm.search_bands(spark, own.filter("false"), store)
    assert empty.count() == 0 and none.count() == 0


def test_state_after_loads_is_a_full_run(spark, folder):
    fps, tgt = frames(spark)
    fps = stage(fps.withColumn("load", F.pmod(F.xxhash64("chembl_id"), F.lit(3))), "fps")
    late = tgt.filter(F.col(TARGET).isin("T1", "CHEMBL5"))
    early = tgt.join(late, TARGET, "left_anti").select(*tgt.columns)
    for load in (0, 1, 1, 2):
        own, before = (fps.filter(c).drop("load") for c in (F.col("load") == load, F.col("load") < load))
        sm.update_top(spark, early if load < 2 else tgt, own, folder, load, 10, earlier=before)
    for mode in ("within", "boundary"):
        assert top_of(sm.read_top(spark, folder, 10, mode)) == brute_top(brute(), 10, mode)
    first = sm.read_top(spark, folder, 10, load=0)
    assert top_of(first) == top_of(sm.score_top_k(early, fps.filter("load = 0")))
    assert sm.read_top(spark, f"{folder}/none").count() == 0
