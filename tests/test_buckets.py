import glob
import os
import re
import uuid

import pytest

import simmart as sm
from simmart.operators.mart import SOURCE, TARGET, new_fact_rows
from simmart.schemas import DICTIONARY, DIMENSION, FACT, PROPERTIES
from simmart.sources.buckets import bucket_spec
from simmart.sources.tables import read_table
from tests.test_mart import TOP, pairs, staging

N = 8


@pytest.fixture
def star(spark, folder):
    """Names of the staging tables, the dimension and the fact, all in buckets."""
    names = {}
    for label, schema, key in (
        ("dictionary", DICTIONARY, ["chembl_id"]), ("props", PROPERTIES, ["chembl_id"]),
        ("dim", DIMENSION, ["chembl_id"]), ("fact", FACT, [SOURCE, TARGET]),
    ):
        names[label] = f"{label}_{uuid.uuid4().hex}"
        sm.create_buckets(spark, names[label], schema, key, N, path=f"{folder}/{label}")
    for label, rows in zip(("dictionary", "props"), staging(spark)):
        sm.refresh_table(rows, names[label])
    yield names
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled_tables(text):
    """For each exchange of a plan, the tables scanned below it."""
    lines, out = text.split("\n"), []
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            depth = line.index("Exchange")
            for below in lines[i + 1:]:
                start = re.search(r"[A-Za-z*(]", below)
                if not start or start.start() <= depth - 2:
                    break
                out += re.findall(r"FileScan parquet \S*?\.?(\w+_[0-9a-f]{32})", below)
    return out


def test_same_star_as_without_buckets(spark, folder, star):
    months = [
        [("A", "T1", 0.9, False), ("B", "T1", 0.8, False), ("NOPROPS", "T1", 0.5, False)],
        [("A", "T2", 0.7, False), ("A", "T1", 0.9, False), ("C", "T2", 0.6, False)],
    ]
    plain = f"{folder}/plain_dim", f"{folder}/plain_fact"
    for rows in months:
        top = spark.createDataFrame(rows, TOP)
        one = sm.append_mart(top, spark.table(star["dictionary"]), spark.table(star["props"]), star["dim"], star["fact"])
        two = sm.append_mart(top, *staging(spark), *plain)
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    for name, path in zip((star["dim"], star["fact"]), plain):
        mine, other = spark.table(name), read_table(spark, path)
        assert sorted(map(tuple, mine.collect()), key=repr) == sorted(map(tuple, other.select(*mine.columns).collect()), key=repr)
    assert bucket_spec(spark, star["fact"]) == (N, [SOURCE, TARGET])


def test_stored_rows_are_not_shuffled(spark, star, no_broadcast):
    top = spark.createDataFrame([("A", "T1", 0.9, False)], TOP)
    dim, fact = spark.table(star["dim"]), spark.table(star["fact"])
    new = plan(new_fact_rows(top, dim, fact))
    assert "Bucketed: true" in new and "Exchange" in new and not shuffled_tables(new)
    ids = top.select(top[SOURCE].alias("chembl_id"))
    joined = spark.table(star["dictionary"]).join(ids, "chembl_id", "left_semi").join(
        spark.table(star["props"]).join(ids, "chembl_id", "left_semi"), "chembl_id"
    )
    both = plan(joined.groupBy("chembl_id").count())
    assert both.count("Bucketed: true") == 2 and not shuffled_tables(both)
    # the helper does see a table that is shuffled
    assert shuffled_tables(plan(fact.groupBy(TARGET).count())) == [star["fact"]]


def test_a_load_touches_only_buckets_of_its_rows(spark, folder, star):
    def files():
        return {f: os.path.getmtime(f) for f in glob.glob(f"{folder}/fact/*.parquet")}

    many = spark.createDataFrame([(f"S{i}", "T1", 0.5, False) for i in range(200)], TOP).select(*FACT.names)
    sm.append_table(many.withColumn(FACT.names[2], many[FACT.names[2]].cast(FACT[FACT.names[2]].dataType)), star["fact"])
    before = files()
    assert len(before) == N
    top = spark.createDataFrame([("A", "T1", 0.9, False)], TOP)
    sm.append_mart(top, spark.table(star["dictionary"]), spark.table(star["props"]), star["dim"], star["fact"])
    after = files()
    assert before.items() <= after.items() and len(after) == len(before) + 1
    assert pairs(spark.table(star["fact"])) == {("A", "T1")} | {(f"S{i}", "T1") for i in range(200)}


def test_refresh_keeps_buckets(spark, star):
    name = star["dictionary"]
    for n in (5, 3):
        rows = spark.createDataFrame([(f"X{i}", "t") for i in range(n)], DICTIONARY)
        sm.refresh_table(rows, name)
        assert bucket_spec(spark, name) == (N, ["chembl_id"]) and spark.table(name).count() == n
        assert spark.table(name).filter("chembl_id = 'X1'").count() == 1
    # other columns: overwritten, still in buckets
    sm.refresh_table(spark.createDataFrame([("Y", 1)], "chembl_id string, other int"), name)
    assert bucket_spec(spark, name) == (N, ["chembl_id"]) and [tuple(r) for r in spark.table(name).collect()] == [("Y", 1)]


def test_bad_keys_are_refused(spark):
    for key, n in ((["nope"], 4), ([], 4), (["chembl_id"], 0)):
        with pytest.raises(ValueError):
            sm.create_buckets(spark, "never", DICTIONARY, key, n)
