import random

import pytest
from pyspark.sql import functions as F

import simmart as sm

SOURCE, TARGET, SCORE = "source_chembl_id", "target_chembl_id", "tanimoto_similarity_score"
FLAG = "has_duplicates_of_last_largest_score"


def tanimoto(a, b, empty=0.0):
    union = len(a | b)
    return len(a & b) / union if union else empty


def cases():
    rng = random.Random(3)
    sources = {f"CHEMBL{i}": set(rng.sample(range(2048), rng.choice([1, 2, 3, 40, 300]))) for i in range(150)}
    sources["CHEMBL900"] = set()
    sources["CHEMBL901"] = set(sources["CHEMBL5"])
    sources["CHEMBL902"] = set(range(2048))
    for i in range(12):  # ties on purpose
        sources[f"CHEMBL95{i}"] = {7, 8, 100 + i}
    names = ["CHEMBL5", "CHEMBL900", "T1", "T2", "T2", "T3", "T4", "T4"]
    structures = [sources["CHEMBL5"], set(), {7, 8}, {1, 2, 3}, {7}, set(range(0, 2048, 2)), {9}, {9}]
    return sources, list(zip(names, structures))


def frames(spark):
    sources, targets = cases()
    fps = spark.createDataFrame([(n, sorted(s)) for n, s in sources.items()], "chembl_id string, on array<int>")
    tgt = spark.createDataFrame([(n, sorted(s)) for n, s in targets], f"{TARGET} string, on array<int>")
    return fps.repartition(5), tgt


def brute(empty=0.0, include_self=True):
    sources, targets = cases()
    scores = {}
    for target, t in targets:
        for source, s in sources.items():
            if include_self or source != target:
                key = (source, target)
                scores[key] = max(scores.get(key, 0.0), tanimoto(s, t, empty))
    return scores


def brute_top(scores, k, mode="within"):
    out = {}
    for target in {t for _, t in scores}:
        ranked = sorted((-v, s) for (s, t), v in scores.items() if t == target)
        top = ranked[:k]
        for neg, source in top:
            if mode == "within":
                flag = sum(v == neg for v, _ in top) > 1
            else:
                flag = neg == top[-1][0] and len(ranked) > k and ranked[k][0] == neg and len(top) == k
            out[source, target] = (-neg, flag)
    return out


def top_of(df):
    rows = df.collect()
    assert len({(r[SOURCE], r[TARGET]) for r in rows}) == len(rows)
    return {(r[SOURCE], r[TARGET]): (r[SCORE], r[FLAG]) for r in rows}


@pytest.mark.parametrize("form", ["on", "words", "morgan_fingerprint"])
@pytest.mark.parametrize("max_block", [100, 3])
def test_all_scores(spark, form, max_block):
    fps, tgt = frames(spark)
    column = {
        "on": F.col("on"), "words": sm.bits_pack(F.col("on")), "morgan_fingerprint": sm.bits_encode(F.col("on"))
    }[form]
    fps, tgt = fps.select("chembl_id", column.alias(form)), tgt.select(TARGET, column.alias(form))
    rows = sm.score_targets(tgt, fps, max_block=max_block).collect()
    assert {(r.chembl_id, r[TARGET]): r[SCORE] for r in rows} == brute()
    assert len(rows) == len(brute())


@pytest.mark.parametrize("k", [1, 10, 500])
@pytest.mark.parametrize("mode", ["within", "boundary"])
@pytest.mark.parametrize("max_block", [100, 3])
def test_top_k(spark, k, mode, max_block):
    fps, tgt = frames(spark)
    expected = brute_top(brute(), k, mode)
    assert top_of(sm.score_top_k(tgt, fps, k, mode, max_block=max_block)) == expected
    if max_block == 100:
        assert top_of(sm.top_k_similar(sm.score_targets(tgt, fps), k, mode)) == expected


def test_many_small_batches_and_partitions(spark):
    fps, tgt = frames(spark)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        assert top_of(sm.score_top_k(tgt, fps.repartition(23), 10)) == brute_top(brute(), 10)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def test_self_pairs_and_empty_score(spark):
    fps, tgt = frames(spark)
    assert top_of(sm.score_top_k(tgt, fps, 10, include_self=False)) == brute_top(brute(include_self=False), 10)
    assert top_of(sm.score_top_k(tgt, fps, 10, empty_score=1.0)) == brute_top(brute(empty=1.0), 10)
    rows = sm.score_targets(tgt, fps, include_self=False, keep_zero=False).collect()
    expected = {k: v for k, v in brute(include_self=False).items() if v > 0}
    assert {(r.chembl_id, r[TARGET]): r[SCORE] for r in rows} == expected


def test_missing_fingerprints_and_no_targets(spark):
    fps, tgt = frames(spark)
    gaps = fps.union(spark.createDataFrame([("CHEMBL_NULL", None), (None, [7, 8]), (None, [7, 8])], fps.schema))
    gaps_t = tgt.union(spark.createDataFrame([("T9", None), (None, [1])], tgt.schema))
    assert top_of(sm.score_top_k(gaps_t, gaps, 10)) == brute_top(brute(), 10)
    assert sm.score_top_k(tgt.filter("false"), fps).count() == 0
    assert sm.score_targets(tgt.filter("false"), fps).count() == 0


def test_numeric_ids(spark):
    fps = spark.createDataFrame([(1, [1]), (2, [1, 2])], "chembl_id long, on array<int>")
    tgt = spark.createDataFrame([(9, [1])], f"{TARGET} long, on array<int>")
    assert top_of(sm.score_top_k(tgt, fps)) == {("1", "9"): (1.0, False), ("2", "9"): (0.5, False)}


def test_ties_use_unrounded_scores_and_repeated_rows_collapse(spark):
    pairs = spark.createDataFrame(
        [("a", 0.5, "T"), ("b", 0.5 + 1e-12, "T"), ("c", 0.25, "T"), ("d", 0.25, "T"), ("e", 1.0, None)],
        "chembl_id string, tanimoto_similarity_score double, target_chembl_id string",
    )
    top = top_of(sm.top_k_similar(pairs, 3))
    assert top == {("b", "T"): (0.5 + 1e-12, False), ("a", "T"): (0.5, False), ("c", "T"): (0.25, False)}
    again = sm.top_k_similar(sm.top_k_similar(pairs, 3).withColumnRenamed(SOURCE, "chembl_id"), 3)
    assert set(top_of(again)) == set(top)
    doubled = sm.top_k_similar(pairs.union(pairs), 4)
    assert top_of(doubled) == {("b", "T"): (0.5 + 1e-12, True), ("a", "T"): (0.5, True)}
    with pytest.raises(ValueError):
        sm.top_k_similar(pairs, 3, "other")


def test_pairs_are_never_shuffled(spark):
    fps, tgt = frames(spark)
    plan = sm.score_top_k(tgt, fps)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("max_block", [1, 2, 7, 10_000])
def test_copies_of_an_id_count_once(spark, max_block):
    rng = random.Random(11)
    rows = [(f"s{rng.randint(0, 12):02}", sorted(rng.sample(range(64), rng.randint(1, 20)))) for _ in range(80)]
    fps = spark.createDataFrame(rows, "chembl_id string, on array<int>").repartition(2)
    tgt = spark.createDataFrame([(f"t{i % 5}", rows[i][1]) for i in range(9)], "target_chembl_id string, on array<int>")
    best = {}
    for t in tgt.collect():
        for s, on in rows:
            score = len(set(on) & set(t.on)) / len(set(on) | set(t.on))
            best[t.target_chembl_id, s] = max(score, best.get((t.target_chembl_id, s), 0))
    expected = set()
    for t in {t for t, _ in best}:
        expected |= {(s, t, -v) for v, s in sorted((-v, s) for (x, s), v in best.items() if x == t)[:3]}
    top = sm.score_top_k(tgt, fps, 3, n_bits=64, max_block=max_block)
    assert {tuple(r)[:3] for r in top.collect()} == expected
    pairs = sm.score_targets(tgt, fps, n_bits=64, max_block=max_block)
    assert sorted(map(tuple, sm.top_k_similar(pairs, 3).collect())) == sorted(map(tuple, top.collect()))


def test_rows_that_cannot_be_scored(spark):
    on = [("a", [0, 3]), ("b", [-1]), ("c", [4]), ("d", [None]), ("e", None), (None, [1]), ("f", [])]
    text = [("a", "0110"), ("b", "011"), ("c", "01100"), ("d", "012x"), ("e", None), (None, "0000"), ("f", "0110\n")]
    words = [("a", [1 << 62]), ("b", []), ("c", [1, 2]), ("d", [None]), ("e", None), (None, [0]), ("f", [1])]
    for rows, kind, malformed in (
        (on, "on array<int>", "bcd"), (text, "morgan_fingerprint string", "bcdf"), (words, "words array<bigint>", "bcdf")
    ):
        good, rejects = sm.split_fingerprints(spark.createDataFrame(rows, f"chembl_id string, {kind}"), n_bits=4)
        reasons = {(r.chembl_id, r.reject_reason) for r in rejects.collect()}
        assert reasons == {(c, "malformed") for c in malformed} | {("e", "null_fingerprint"), (None, "null_id")}
        assert good.count() == len(rows) - len(reasons)


@pytest.mark.parametrize("max_block", [1, 3, 100])
@pytest.mark.parametrize("mode", ["within", "boundary"])
def test_seed_changes_nothing(spark, max_block, mode):
    fps, tgt = frames(spark)
    seed = fps.filter(F.pmod(F.xxhash64("chembl_id"), F.lit(3)) == 0)
    for k in (1, 10):
        assert top_of(sm.score_top_k(tgt, fps, k, mode, max_block=max_block, seed=seed)) == brute_top(brute(), k, mode)
    got = sm.score_top_k(tgt, fps, 10, include_self=False, max_block=max_block, seed=seed)
    assert top_of(got) == brute_top(brute(include_self=False), 10)
    assert top_of(sm.score_top_k(tgt, fps, 10, seed=fps.filter("false"))) == brute_top(brute(), 10)


@pytest.mark.parametrize("empty_score", [0.0, 1.0])
def test_min_score(spark, folder, empty_score):
    fps, tgt = frames(spark)
    stored = f"{folder}/fps"
    sm.write_fingerprints(fps.withColumn("pop", F.size("on")), stored, layout="words")
    files = sm.scan_fingerprints(spark, stored)
    assert files.columns == ["chembl_id", "words", "pop"]
    words = tgt.select(TARGET, sm.bits_pack(F.col("on")).alias("words"))
    for least in (0.25, 1 / 3, 1.0):
        expected = {k: v for k, v in brute(empty=empty_score).items() if v >= least}
        for source, max_block in ((fps, 100), (files, 3), (files, 100)):
            target = tgt if source is fps else words
            rows = sm.score_targets(target, source, empty_score, max_block=max_block, min_score=least).collect()
            assert {(r.chembl_id, r[TARGET]): r[SCORE] for r in rows} == expected and len(rows) == len(expected)


def test_one_scan_for_several_blocks_and_a_filter_in_the_files(spark, folder):
    fps, tgt = frames(spark)
    sm.write_fingerprints(fps.withColumn("pop", F.size("on")), f"{folder}/fps", layout="words")
    files = sm.scan_fingerprints(spark, f"{folder}/fps")
    words = tgt.filter(F.size("on") > 0).select(TARGET, sm.bits_pack(F.col("on")).alias("words"))
    plan = sm.score_targets(words, files, max_block=1, min_score=0.5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "GreaterThanOrEqual(pop" in plan and "LessThanOrEqual(pop" in plan
    plan = sm.score_top_k(words, files, max_block=1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
