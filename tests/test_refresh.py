import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import simmart as sm
from simmart.sources.tables import VERSION, read_table


@pytest.fixture
def table(spark, folder):
    """A managed table in a schema of its own."""
    spark.sql(f"CREATE DATABASE refreshed LOCATION '{folder}/db'")
    yield "refreshed.t"
    spark.sql("DROP DATABASE refreshed CASCADE")


@pytest.fixture(params=["table", "path"])
def place(request, folder):
    return request.getfixturevalue("table") if request.param == "table" else f"{folder}/t"


def rows(spark, place):
    return sorted(r[0] for r in read_table(spark, place).collect())


def test_replaces(spark, place):
    for n in (3, 5, 0, 2):
        sm.refresh_table(spark.range(n), place)
        assert rows(spark, place) == list(range(n))


def test_a_lost_job_leaves_the_old_rows(spark, place):
    sm.refresh_table(spark.range(3), place)
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(PySparkException, match="lost"):
        sm.refresh_table(broken, place)
    assert rows(spark, place) == [0, 1, 2]
    sm.refresh_table(spark.range(4), place)
    assert rows(spark, place) == [0, 1, 2, 3]


def test_rows_made_from_the_table_itself(spark, place):
    sm.refresh_table(spark.range(3), place)
    for _ in range(3):
        sm.refresh_table(read_table(spark, place).select((F.col("id") + 1).alias("id")), place)
    assert rows(spark, place) == [3, 4, 5]


def test_a_reader_that_has_started_keeps_its_rows(spark, table):
    for n in (3, 4):
        sm.refresh_table(spark.range(n), table)
    started = spark.read.parquet(*spark.table(table).inputFiles())
    sm.refresh_table(spark.range(9), table)
    assert started.count() == 4 and len(rows(spark, table)) == 9


def test_old_versions_go(spark, table, folder):
    for n in range(1, 7):
        sm.refresh_table(spark.range(n), table)
    kept = [name for name in os.listdir(f"{folder}/db") if not name.startswith(".")]
    assert len(kept) == 2 and all(name.startswith(f"t{VERSION}") for name in kept)


def test_other_columns(spark, table):
    sm.refresh_table(spark.range(3), table)
    sm.refresh_table(spark.range(2).select(F.lit("a").alias("name")), table)
    assert rows(spark, table) == ["a", "a"]


def test_a_job_that_died_between_the_renames(spark, folder):
    path = f"{folder}/t"
    sm.refresh_table(spark.range(3), path)
    os.rename(path, f"{path}{VERSION}before")
    sm.refresh_table(spark.range(5), path)
    assert rows(spark, path) == [0, 1, 2, 3, 4]
