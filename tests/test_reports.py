import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import simmart as sm
from simmart.plans.reports import _range
from simmart.schemas import DIMENSION, FACT


def fact_of(spark, rows):
    return spark.createDataFrame([(s, t, None if v is None else Decimal(v), False) for s, t, v in rows], FACT)


def dim_of(spark, rows):
    return spark.createDataFrame(
        [(i, None, None, None if a is None else Decimal(a), None, None, None, None, r, h) for i, a, r, h in rows], DIMENSION
    )


@pytest.fixture(scope="module")
def small(spark):
    fact = fact_of(
        spark,
        [("A", "T1", "0.9"), ("A", "T2", "0.5"), ("A", "T3", "0.5"), ("A", "T4", None), ("B", "T1", "0.4"), ("C", "T2", "0.2")],
    )
    dim = dim_of(
        spark,
        [("A", "1.50", 2, 7), ("B", None, None, 7), ("C", "-1.00", 1, None), ("T1", "3.00", 0, 0), ("T2", "0.50", 0, 0),
         ("T3", None, 0, 0), ("T4", "1.50", 0, 0)],
    )
    return fact, dim


def test_averages(small):
    fact, dim = small
    means = {r[0]: r[1] for r in sm.avg_similarity_per_source(fact).collect()}
    assert means == {"A": pytest.approx(1.9 / 3), "B": 0.4, "C": 0.2}
    by_target = {r[0]: r[1] for r in sm.avg_similarity_per_source(fact, by="target_chembl_id").collect()}
    assert by_target["T4"] is None and by_target["T2"] == pytest.approx(0.35)


def test_property_deviation(small):
    fact, dim = small
    rows = {r[0]: r[1] for r in sm.avg_property_deviation(fact, dim).collect()}
    assert rows == {"A": pytest.approx((1.5 + 1.0 + 0.0) / 3), "B": None, "C": 1.5}
    heavy = {r[0]: r[1] for r in sm.avg_property_deviation(fact, dim, "heavy_atoms").collect()}
    assert heavy == {"A": 7.0, "B": 7.0, "C": None}


def test_next_most_similar(small):
    rows = {(r[0], r[1]): (r[3], r[4]) for r in sm.next_most_similar(small[0]).collect()}
    assert rows == {
        ("A", "T4"): ("T1", "T2"), ("A", "T1"): ("T2", "T3"), ("A", "T2"): ("T3", None), ("A", "T3"): (None, None),
        ("B", "T1"): (None, None), ("C", "T2"): (None, None),
    }


@pytest.mark.parametrize("bands", [1, 3, 200])
def test_leads_across_bands(spark, bands):
    rng = random.Random(bands)
    rows = [(None if i % 2 else "HOT", f"T{i}", rng.choice(["0.5", "0.25", "1.0", "0.33", None])) for i in range(400)]
    rows += [(f"S{i % 40}", f"T{i}", rng.choice(["0.5", "0.1"])) for i in range(200)]
    sources = {}
    for source, target, score in rows:
        sources.setdefault(source, []).append((score is not None, -float(score or 0), target))
    expected = {}
    for source, own in sources.items():
        own = [t for _, _, t in sorted(own)] + [None, None]
        expected |= {(source, t): (own[i + 1], own[i + 2]) for i, t in enumerate(own[:-2])}
    found = sm.next_most_similar(fact_of(spark, rows), bands=bands).collect()
    assert {(r[0], r[1]): (r[3], r[4]) for r in found} == expected and len(found) == len(rows)


def test_leads_show_later_rows(spark, folder):
    fact_of(spark, [("A", "T1", "0.5"), ("A", "T2", "0.4")]).write.parquet(f"{folder}/fact")
    spark.read.parquet(f"{folder}/fact").createOrReplaceTempView("growing_fact")
    fact_of(spark, [("A", "T3", "0.3"), ("B", "T1", "0.2")]).write.mode("append").parquet(f"{folder}/fact")
    assert sm.next_most_similar(spark.read.parquet(f"{folder}/fact")).count() == 4


def test_categories(small):
    rows = [tuple(r) for r in sm.similarity_categories(*small, with_grouping_id=True).collect()]
    found = {(r[0], r[1], r[2], r[4]): r[3] for r in rows}
    assert len(found) == len(rows) == 9
    assert found["TOTAL", "TOTAL", "TOTAL", 7] == pytest.approx(2.5 / 5)
    assert found["A", None, None, 3] == pytest.approx(1.9 / 3)
    assert found[None, "2", "7", 4] == pytest.approx(1.9 / 3)
    assert found[None, None, "7", 4] == 0.4  # NULL aromatic rings
    assert found[None, None, "7", 6] == pytest.approx(2.3 / 4)  # rolled up
    assert found[None, None, None, 6] == 0.2  # NULL heavy atoms
    assert sm.similarity_categories(*small).columns == ["source_chembl_id", "aromatic_rings", "heavy_atoms", "avg_similarity_score"]


def test_views(spark, small):
    sm.register_report_views(spark, *small)
    assert spark.sql("SELECT count(*) FROM avg_similarity_per_source").first()[0] == 3
    assert spark.sql("SELECT avg_alogp_deviation FROM avg_alogp_deviation WHERE source_chembl_id = 'C'").first()[0] == 1.5
    assert spark.sql("SELECT count(*) FROM next_most_similar").first()[0] == 6
    assert spark.sql("SELECT count(*) FROM avg_similarity_score_categories").first()[0] == 9


def leads_of(rows):
    """(source, target, score, next, second) of every row, in order of score and target."""
    sources = {}
    for source, target, score in rows:
        sources.setdefault(source, []).append((score is not None, -float(score or 0), target or "", target))
    out = []
    for source, own in sources.items():
        own = [t for *_, t in sorted(own, key=lambda r: r[:3])] + [None, None]
        out += [(source, t, own[i + 1], own[i + 2]) for i, t in enumerate(own[:-2])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("ranges", [1, 2, 7, 200])
def test_leads_across_cuts(spark, ranges):
    rng = random.Random(ranges)
    rows = [("HOT", f"T{rng.randrange(150)}", rng.choice(["0.5", None])) for _ in range(500)]  # with repeated rows
    rows += [(None if i % 2 else 'S"1', f'"T{i}', "0.25") for i in range(90)] + [(f"S{i}", "T", "0.1") for i in range(50)]
    fact = fact_of(spark, rows)
    cuts = sm.row_cuts(fact, ranges=ranges)
    found = [(r[0], r[1], r[3], r[4]) for r in sm.next_most_similar(fact, cuts=cuts).collect()]
    assert len(cuts) <= 2 * ranges and sorted(found, key=repr) == leads_of(rows)
    # cuts of another state of the table give the same rows
    old = sm.row_cuts(fact.filter("target_chembl_id < 'T3'"), ranges=ranges)
    found = [(r[0], r[1], r[3], r[4]) for r in sm.next_most_similar(fact, cuts=old).collect()]
    assert sorted(found, key=repr) == leads_of(rows)


def test_cuts_of_no_rows(spark):
    fact = fact_of(spark, [])
    assert sm.row_cuts(fact) == [] and sm.next_most_similar(fact, cuts=[]).count() == 0


def test_cuts_split_one_score(spark):
    fact = spark.range(60_000).select(
        F.lit("all").alias("source_chembl_id"), F.concat(F.lit("T"), "id").alias("target_chembl_id"),
        F.lit("0.5").cast("decimal(9,6)").alias("tanimoto_similarity_score"),
    )
    bands = fact.groupBy(_range(fact, "source_chembl_id", sm.row_cuts(fact))).count()
    assert bands.agg(F.max("count")).first()[0] <= 0.02 * 60_000


def files_read(df):
    return sorted({name.split("/load=")[1].split("/")[0] for name in df.inputFiles() if "/load=" in name})


def test_reports_by_loads(spark, folder):
    rng = random.Random(5)
    ids = [f"M{i}" for i in range(30)]
    dim = dim_of(spark, [(i, rng.choice([None, "1.50", "-2.25"]), rng.choice([None, 1, 2]), rng.choice([None, 7])) for i in ids])
    pairs = [(a, b, rng.choice([None, "0.5", "0.123456"])) for a in ids for b in ids if rng.random() < 0.4]
    pairs += [("ONLY", "M1", None)]  # not in the dimension
    months = [pairs[i::3] for i in range(3)]
    where = f"{folder}/reports"
    with pytest.raises(ValueError, match="no finished load"):
        sm.stored_avg_similarity(spark, where)
    for load in (0, 1, 2, 1):
        facts = f"{folder}/facts-{load}"
        fact_of(spark, months[load]).write.mode("overwrite").parquet(facts)
        sm.add_report_load(spark.read.parquet(facts), dim, where, load, ("alogp", "heavy_atoms"))
    every = fact_of(spark, pairs)

    def same(stored, full):
        assert stored.columns == full.columns
        assert sorted(map(tuple, stored.collect()), key=repr) == sorted(map(tuple, full.collect()), key=repr)

    for by in ("source_chembl_id", "target_chembl_id"):
        same(sm.stored_avg_similarity(spark, where, by), sm.avg_similarity_per_source(every, by))
        for column in ("alogp", "heavy_atoms"):
            full = sm.avg_property_deviation(every, dim, column, by)
            same(sm.stored_property_deviation(spark, where, column, by), full)
    same(sm.stored_categories(spark, where, dim, True), sm.similarity_categories(every, dim, True))
    read = sm.stored_avg_similarity(spark, where).inputFiles()
    assert files_read(sm.stored_avg_similarity(spark, where)) == ["0", "1", "2"] and not any("facts" in name for name in read)
