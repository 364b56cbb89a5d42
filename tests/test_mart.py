from decimal import Decimal

import pytest

import simmart as sm
from simmart.operators import mart
from simmart.schemas import DICTIONARY, DIMENSION, FACT, PROPERTIES
from simmart.session import empty
from simmart.sources.tables import read_table

TOP = "source_chembl_id string, target_chembl_id string, tanimoto_similarity_score double, has_duplicates_of_last_largest_score boolean"


def staging(spark):
    ids = ["A", "B", "C", "T1", "T2"]
    dictionary = spark.createDataFrame([(i, "Small") for i in [*ids, "NOPROPS"]], DICTIONARY)
    props = spark.createDataFrame(
        [(i, Decimal("1.00"), None, None, None, None, None, n, 3) for n, i in enumerate([*ids, "NODICT"])], PROPERTIES
    )
    return dictionary, props


def pairs(df):
    return {(r.source_chembl_id, r.target_chembl_id) for r in df.collect()}


def test_dimension_before_fact_and_foreign_keys(spark):
    top = spark.createDataFrame(
        [("A", "T1", 0.1234567, False), ("B", "T1", 0.5, True), ("NOPROPS", "T1", 0.5, True), ("C", "NODICT", 1.0, False)], TOP
    )
    dim, fact, rejects = sm.load_mart(top, *staging(spark), empty(spark, DIMENSION), empty(spark, FACT))
    assert {r.chembl_id for r in dim.collect()} == {"A", "B", "C", "T1"}
    assert dim.columns == DIMENSION.names and fact.schema == FACT
    assert pairs(fact) == {("A", "T1"), ("B", "T1")}
    assert {r.tanimoto_similarity_score for r in fact.collect()} == {Decimal("0.123457"), Decimal("0.500000")}
    assert {(r.source_chembl_id, r.reject_reason) for r in rejects.collect()} == {
        ("NOPROPS", "fk:source_chembl_id"), ("C", "fk:target_chembl_id")
    }


def two_loads(spark, folder, fact_filter):
    dim, fact = f"{folder}/dim", f"{folder}/fact"
    first = spark.createDataFrame([("A", "T1", 0.9, False), ("B", "T1", 0.8, False)], TOP)
    second = spark.createDataFrame([("A", "T2", 0.7, False), ("A", "T1", 0.9, False), ("C", "T2", 0.6, False)], TOP)
    for top in (first, second):
        sm.append_mart(top, *staging(spark), dim, fact, fact_filter)
    return read_table(spark, dim), read_table(spark, fact)


def test_known_source_with_new_target(spark, folder):
    dim, fact = two_loads(spark, folder, "new_pairs")
    assert sorted(pairs(fact)) == [("A", "T1"), ("A", "T2"), ("B", "T1"), ("C", "T2")] and fact.count() == 4
    assert sorted(r.chembl_id for r in dim.collect()) == ["A", "B", "C", "T1", "T2"]


def test_new_sources_loses_it(spark, folder):
    dim, fact = two_loads(spark, folder, "new_sources")
    assert sorted(pairs(fact)) == [("A", "T1"), ("B", "T1"), ("C", "T2")]


def test_same_month_twice_changes_nothing(spark, folder):
    dim, fact = f"{folder}/dim", f"{folder}/fact"
    top = spark.createDataFrame([("A", "T1", 0.9, False), ("B", "T1", 0.8, False)], TOP)
    for _ in range(2):
        sm.append_mart(top, *staging(spark), dim, fact)
    assert read_table(spark, dim).count() == 3 and read_table(spark, fact).count() == 2


def test_rerun_after_a_crash_between_the_two_writes(spark, folder):
    dim, fact = f"{folder}/dim", f"{folder}/fact"
    top = spark.createDataFrame([("A", "T1", 0.9, False)], TOP)
    new_dim, _, _ = sm.load_mart(top, *staging(spark), empty(spark, DIMENSION), empty(spark, FACT))
    sm.append_table(new_dim, dim)
    sm.append_mart(top, *staging(spark), dim, fact)
    assert read_table(spark, dim).count() == 2 and pairs(read_table(spark, fact)) == {("A", "T1")}


@pytest.mark.parametrize("fact_filter, dies_at", [("new_sources", "fact"), ("new_sources", "mark"), ("new_pairs", "dim")])
def test_named_batch_is_loaded_once(spark, folder, monkeypatch, fact_filter, dies_at):
    first = spark.createDataFrame([("A", "T1", 0.9, False), ("B", "T1", 0.8, False)], TOP)
    second = spark.createDataFrame([("A", "T2", 0.7, False), ("C", "T2", 0.6, False), ("NOPROPS", "T2", 0.5, False)], TOP)

    def load(root, top, batch):
        return sm.append_mart_once(top, *staging(spark), f"{root}/dim", f"{root}/fact", f"{root}/ledger", batch, fact_filter)

    def star(root):
        return sorted(map(tuple, read_table(spark, f"{root}/dim").collect()), key=repr), sorted(map(tuple, read_table(spark, f"{root}/fact").collect()))

    for batch, top in (("1", first), ("2", second)):
        load(f"{folder}/whole", top, batch)
    append, ranges, seen = mart.append_table, type(spark).range, []

    def dying(rows, table):
        if table.endswith(f"/{dies_at}") and not seen:
            seen.append(table)
            raise OSError("lost")
        append(rows, table)

    def dying_mark(self, *args):
        seen.append("mark")
        if len(seen) == 2:
            raise OSError("lost")
        return ranges(self, *args)

    root = f"{folder}/crashed"
    load(root, first, "1")
    with monkeypatch.context() as m:
        m.setattr(mart, "append_table", dying)
        if dies_at == "mark":
            m.setattr(type(spark), "range", dying_mark)
        if dies_at:
            with pytest.raises(OSError):
                load(root, second, "2")
    for batch, top in (("2", second), ("1", first), ("2", second)):
        rejects = load(root, top, batch)
    assert star(root) == star(f"{folder}/whole")
    assert [r.reject_reason for r in rejects.collect()] == ["fk:source_chembl_id"]
