import random

from pyspark.sql import functions as F

import simmart as sm
from simmart.functions.text import is_blank
from simmart.operators.records import typed_number


def test_same_as_columns(spark):
    rng = random.Random(3)
    sets = [[], [0], [63, 64], [2047], None] + [sorted(rng.sample(range(2048), rng.randrange(1, 90))) for _ in range(20)]
    rows = [(a, b) for a in sets for b in sets]
    df = spark.createDataFrame(rows, "a ARRAY<INT>, b ARRAY<INT>").select(
        sm.bits_encode(F.col("a")).alias("bits"), sm.bits_pack(F.col("a")).alias("a"), sm.bits_pack(F.col("b")).alias("b")
    )
    names = sm.register_sql_functions(spark, "t_")
    assert "t_tanimoto" in names
    mine = spark.sql(
        "SELECT t_popcount(a), t_tanimoto(a, b), t_bits_pack_text(bits), t_bits_unpack(a) FROM {df}", df=df
    )
    score = sm.tanimoto(F.col("a"), sm.popcount(F.col("a")), F.col("b"), sm.popcount(F.col("b")))
    theirs = df.select(sm.popcount(F.col("a")), score, sm.bits_pack_text(F.col("bits")), sm.bits_unpack(F.col("a")))
    assert [tuple(r) for r in mine.collect()] == [tuple(r) for r in theirs.collect()]
    plan = mine._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert "bit_count(" in plan


def test_text_functions(spark):
    sm.register_sql_functions(spark)
    values = ["", " ", "0.00", " 1.5 ", "x", " \t", None, "-0", "123456789", "7.005"]
    df = spark.createDataFrame([(v,) for v in values], "v STRING")
    mine = spark.sql("SELECT zero_as_null(v), is_blank(v) FROM {df}", df=df).collect()
    theirs = df.select(typed_number(F.col("v"), "decimal(9,2)", True), is_blank(F.col("v"))).collect()
    assert [tuple(r) for r in mine] == [tuple(r) for r in theirs]
    assert spark.sql("SELECT month_stamp(DATE '2024-07-31')").first()[0] == "07_2024"
