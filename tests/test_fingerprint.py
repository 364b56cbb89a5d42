import hashlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import simmart as sm

TEXTS = [
    ("a", "one two  two three"), ("b", None), ("c", ""), ("d", " \t\n "), ("e", " \x1f"), ("f", "x"), ("g", "bad")
]


def bit(feature, n_bits=2048):
    return int(hashlib.md5(feature.encode()).hexdigest()[:8], 16) % n_bits


def structures(spark):
    return spark.createDataFrame(TEXTS, "chembl_id string, canonical_smiles string")


def test_fold_and_rejects(spark):
    parse = lambda s: F.when(s != "bad", sm.text_tokens(s))
    good, rejects = sm.fingerprint_structures(structures(spark), features=parse)
    found = {r.chembl_id: (r.on, r["pop"]) for r in good.collect()}
    expected = sorted({bit("one"), bit("two"), bit("three")})
    assert found == {"a": (expected, 3), "f": ([bit("x")], 1)}
    reasons = {r.chembl_id: r.reject_reason for r in rejects.collect()}
    assert reasons == {"b": "empty", "c": "empty", "d": "empty", "e": "empty", "g": "invalid"}


def test_width(spark):
    row = sm.fold_fingerprint(structures(spark), "chembl_id", F.array(F.lit("one"), F.lit("two")), 16).first()
    assert row.on == sorted({bit("one", 16), bit("two", 16)})


@pytest.mark.parametrize("n_bits", [1, 16, 1000, 2048, 65536, 131072])
def test_any_width(spark, n_bits):
    words = [f"w{i}" for i in range(300)]
    df = spark.createDataFrame([("a", " ".join(words))], "chembl_id string, text string")
    row = sm.fold_fingerprint(df, "chembl_id", sm.text_tokens(F.col("text")), n_bits).first()
    assert row.on == sorted({bit(w, n_bits) for w in words})


def test_missing_column(spark):
    with pytest.raises(ValueError, match="canonical_smiles"):
        sm.fingerprint_structures(structures(spark).drop("canonical_smiles"))


def test_user_function_sees_only_filled_structures(spark):
    def toolkit(structure):
        assert structure.strip()
        return None if structure == "bad" else [5000, 5000 - 2048, 1]

    good, rejects = sm.fingerprint_with(structures(spark), "chembl_id", "canonical_smiles", sm.per_structure(toolkit))
    on = sorted({5000 % 2048, 1})
    assert {r.chembl_id: (r.on, r["pop"]) for r in good.collect()} == {"a": (on, len(on)), "f": (on, len(on))}
    assert {r.chembl_id: r.reject_reason for r in rejects.collect()} == {
        "b": "empty", "c": "empty", "d": "empty", "e": "empty", "g": "invalid"
    }


def test_user_function_of_a_batch(spark):
    lengths = lambda batch: pa.array([[len(s)] for s in batch.to_pylist()], pa.list_(pa.int32()))
    good, _ = sm.fingerprint_with(structures(spark), "chembl_id", "canonical_smiles", lengths)
    assert {r.chembl_id: r.on for r in good.collect()} == {"a": [18], "f": [1], "g": [3]}
    with pytest.raises(Exception, match="one entry for each structure"):
        sm.fingerprint_with(structures(spark).coalesce(1), "chembl_id", "canonical_smiles", lambda batch: [[1]])


def test_features(spark):
    row = spark.sql("SELECT 'a b  c a b' AS t, 'abcab' AS s, array(0.5, -1.0, 0.0, 2.0) AS v").select(
        sm.text_tokens(F.col("t")).alias("tokens"),
        sm.token_ngrams(F.col("t"), 2).alias("pairs"),
        sm.token_ngrams(F.col("s"), 2).alias("none"),
        sm.char_ngrams(F.col("s"), 2).alias("chars"),
        sm.sign_bits(F.col("v")).alias("signs"),
    ).first()
    assert row.tokens == ["a", "b", "c"]
    assert row.pairs == ["a b", "b c", "c a"]
    assert row.none == []
    assert row.chars == ["ab", "bc", "ca"]
    assert row.signs == [0, 3]


def test_plan_folds_each_row_once(spark):
    fps, _ = sm.build_fingerprints(structures(spark))
    plan = fps._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1 and plan.count("split(") == 1
