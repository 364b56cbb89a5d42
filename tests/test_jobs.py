import datetime
import json

import pytest

import simmart as sm
from simmart.schemas import DICTIONARY, PROPERTIES, RAW_MOLECULE
from simmart.sources.tables import read_table


def structures(spark):
    words = ["red", "green", "blue", "black", "white", "pink", "grey"]
    rows = [(f"CHEMBL{i}", " ".join(words[(i * j) % 7] for j in range(1, 1 + i % 5))) for i in range(40)]
    return spark.createDataFrame(rows, "chembl_id string, canonical_smiles string")


def staging(spark):
    ids = [f"CHEMBL{i}" for i in range(40)] + ["CHEMBLT1", "CHEMBLT2"]
    dictionary = spark.createDataFrame([(i, "Small") for i in ids], DICTIONARY)
    props = spark.createDataFrame([(i, None, None, None, None, None, None, 1, n) for n, i in enumerate(ids)], PROPERTIES)
    return dictionary, props


TARGETS = [("CHEMBLT1", "red green"), ("CHEMBLT2", "blue"), ("CHEMBLT3", " ")]


def test_month_with_and_without_stored_scores(spark, folder):
    targets = spark.createDataFrame(TARGETS, "target_chembl_id string, smiles string")
    fps, rejects = sm.build_fingerprints(structures(spark), f"{folder}/fps")
    assert {r.chembl_id for r in rejects.collect()} == {f"CHEMBL{i}" for i in range(0, 40, 5)}
    stored = sm.scan_fingerprints(spark, f"{folder}/fps")
    facts = []
    for name, pairs_dir in (("a", None), ("b", f"{folder}/pairs")):
        tables = (f"{folder}/dim_{name}", f"{folder}/fact_{name}")
        for _ in range(2):
            out = sm.score_month(spark, targets, stored, *staging(spark), *tables, pairs_dir=pairs_dir)
        assert [r.reject_reason for r in out["target_rejects"].collect()] == ["empty"]
        facts.append(sorted(map(tuple, read_table(spark, tables[1]).collect())))
    assert facts[0] == facts[1] and len(facts[0]) == 20
    assert spark.read.parquet(f"{folder}/pairs").count() == 2 * fps.count()


def test_month_with_a_user_library(spark, folder):
    targets = spark.createDataFrame(TARGETS, "target_chembl_id string, smiles string")
    letters = sm.per_structure(lambda s: [ord(c) for c in s])
    fps, _ = sm.build_fingerprints(structures(spark), fn=letters)
    sm.score_month(spark, targets, fps, *staging(spark), f"{folder}/dim", f"{folder}/fact", fn=letters)
    assert read_table(spark, f"{folder}/fact").count() == 20


def test_target_files_are_handled_once(spark, folder):
    inbox, seen = f"{folder}/inbox", []

    def put(name, text):
        import os

        os.makedirs(inbox, exist_ok=True)
        with open(f"{inbox}/{name}", "w") as f:
            f.write(text)

    def on_file(targets, rejects, month):
        seen.append((month, sorted(map(tuple, targets.collect())), rejects.count()))

    put("data_06_2024.csv", "Molecule Name,SMILES\nCHEMBL1,C\nX,C\n")
    put("readme.txt", "no target list")
    sm.stream_targets(spark, inbox, on_file, f"{folder}/offsets").awaitTermination()
    put("data_07_2024.csv", "SMILES,Molecule Name\nCC,CHEMBL2\n")
    put("data_08_2024.csv", "")
    sm.stream_targets(spark, inbox, on_file, f"{folder}/offsets").awaitTermination()
    # Two files of one moment may come in either order.
    assert sorted(seen, key=lambda s: (s[0] is None, s[0])) == [
        (datetime.date(2024, 6, 1), [("CHEMBL1", "C")], 1),
        (datetime.date(2024, 7, 1), [("CHEMBL2", "CC")], 0),
        (None, [], 1),
    ]


def test_an_empty_collection_replaces_nothing(spark, folder):
    nothing = spark.createDataFrame([], RAW_MOLECULE)
    sm.refresh_table(spark.range(3), f"{folder}/t")
    with pytest.raises(ValueError, match="no items"):
        sm.ingest(nothing, tables={"dictionary": f"{folder}/t"})
    assert spark.read.parquet(f"{folder}/t").count() == 3


def test_neighbourhoods(spark):
    # a path of three nodes, the same path numbered backwards, and a triangle with equal labels
    nodes, edges = [], []
    for mol, labels, links in [
        ("p", "CCO", [(0, 1), (1, 2)]), ("q", "OCC", [(0, 1), (1, 2)]), ("t", "CCO", [(0, 1), (1, 2), (0, 2)]), ("s", "C", [])
    ]:
        nodes += [(mol, i, label) for i, label in enumerate(labels)]
        edges += [(mol, a, b, "1") for a, b in links] + [(mol, b, a, "1") for a, b in links]
    edges.append(("s", 0, 99, "1"))
    n = spark.createDataFrame(nodes, "mol string, node int, label string")
    e = spark.createDataFrame(edges, "mol string, a int, b int, kind string")
    found = {}
    for radius in (0, 2):
        rows = sm.neighborhood_features(n, e, radius).collect()
        found[radius] = {m: sorted(r.feature for r in rows if r.mol == m) for m in "pqts"}
    assert found[2]["p"] == found[2]["q"] != found[2]["t"]
    assert found[0]["p"] == found[0]["t"] and len(found[2]["p"]) == 9 and len(found[2]["s"]) == 3
    fps = sm.fold_features(sm.neighborhood_features(n, e))
    assert {r.chembl_id: r.on for r in fps.collect()}["p"] == sorted({f % 2048 for f in found[2]["p"]})
