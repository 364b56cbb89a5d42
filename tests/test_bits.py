import random

from pyspark.sql import functions as F

import simmart as sm


def sets(spark):
    rng = random.Random(7)
    cases = [[], [0], [63], [64], [2047], [0, 63, 64, 127, 2047], list(range(2048))]
    cases += [sorted(rng.sample(range(2048), rng.randint(1, 400))) for _ in range(40)]
    return cases, spark.createDataFrame(list(enumerate(cases)), "i int, on array<int>").repartition(4)


def test_text_and_words_round_trip(spark):
    cases, df = sets(spark)
    bits = sm.bits_encode(F.col("on"))
    words = sm.bits_pack(F.col("on"))
    rows = df.select(
        "i",
        bits.alias("bits"),
        sm.bits_decode(bits).alias("back"),
        words.alias("words"),
        sm.bits_unpack(words).alias("unpacked"),
        sm.popcount(words).alias("pop"),
    ).collect()
    for row in rows:
        on = cases[row.i]
        assert row.bits == "".join("1" if b in set(on) else "0" for b in range(2048))
        assert row.back == on and row.unpacked == on and row.pop == len(on)
        packed = [int(row.bits[w : w + 64], 2) for w in range(0, 2048, 64)]
        assert [w % 2**64 for w in row.words] == packed


def test_null_stays_null(spark):
    row = spark.sql("SELECT CAST(NULL AS ARRAY<INT>) AS on, CAST(NULL AS STRING) AS bits").select(
        sm.bits_encode(F.col("on")).alias("a"),
        sm.bits_decode(F.col("bits")).alias("b"),
        sm.bits_pack(F.col("on")).alias("c"),
    ).first()
    assert row.a is None and row.b is None and row.c is None


def test_other_width(spark):
    row = spark.sql("SELECT array(0, 99) AS on").select(
        sm.bits_encode(F.col("on"), 100).alias("bits"), sm.bits_pack(F.col("on"), 100).alias("words")
    ).first()
    assert row.bits == "1" + "0" * 98 + "1"
    assert [w % 2**64 for w in row.words] == [1 << 63, 1 << 28]


def test_tanimoto_column(spark):
    pairs = [([1, 2], [1, 2], 1.0), ([1], [2], 0.0), ([], [1], 0.0), ([], [], 0.25), ([1], [1, 2], 0.5),
             ([1, 2], [1, 2, 3, 4], 0.5), ([63, 2047], [63, 2047, 0], 2 / 3)]
    df = spark.createDataFrame([(a, b, s) for a, b, s in pairs], "a array<int>, b array<int>, s double")
    score = sm.tanimoto(sm.bits_pack(F.col("a")), F.size("a"), sm.bits_pack(F.col("b")), F.size("b"), empty_score=0.25)
    back = sm.tanimoto(sm.bits_pack(F.col("b")), F.size("b"), sm.bits_pack(F.col("a")), F.size("a"), empty_score=0.25)
    for row in df.select(score.alias("t"), back.alias("u"), "s").collect():
        assert row.t == row.s and row.u == row.s
