import io
import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import simmart as sm
from simmart.sources.tables import counted, read_pairs, table_or_empty

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Pages:
    """In-memory collection; ``fail`` maps an offset to how often it fails per process, -1 for always."""

    def __init__(self, total, fail=None):
        self.total, self.fail, self.seen = total, fail or {}, {}

    def __call__(self, offset, limit):
        self.seen[offset] = self.seen.get(offset, 0) + 1
        times = self.fail.get(offset, 0)
        if times < 0 or self.seen[offset] <= times:
            raise OSError(f"page {offset}")
        ids = range(offset, min(offset + limit, self.total))
        return {"molecules": [{"molecule_chembl_id": f"CHEMBL{i}"} for i in ids], "page_meta": {"total_count": self.total}}


@pytest.mark.parametrize("total", [0, 3, 10, 20, 23])
@pytest.mark.parametrize("max_requests", [1, 2, 125])
def test_pages(spark, total, max_requests):
    items, errors = sm.read_pages(spark, Pages(total), "molecules", limit=10, delay=0, max_requests=max_requests)
    assert sorted(r.molecule_chembl_id for r in items.collect()) == sorted(f"CHEMBL{i}" for i in range(total))
    assert errors.count() == 0
    lazy, _ = sm.read_pages(
        spark, Pages(total), "molecules", limit=10, delay=0, max_requests=max_requests, store=False
    )
    assert lazy.count() == total
    assert lazy.rdd.getNumPartitions() == max(1, min(max_requests, -(-total // 10)))


def test_retry_skip_and_fail(spark):
    items, _ = sm.read_pages(spark, Pages(25, {0: 1, 10: 2}), "molecules", limit=10, delay=0)
    assert items.count() == 25
    lost = Pages(25, {10: -1})
    items, errors = sm.read_pages(spark, lost, "molecules", limit=10, delay=0, on_page_error="skip")
    assert items.count() == 15
    assert [(r.offset, r.error) for r in errors.collect()] == [(10, "OSError: page 10")]
    with pytest.raises(Exception, match="page 10"):
        sm.read_pages(spark, lost, "molecules", limit=10, delay=0)


class Capped(Pages):
    """Hands out at most four items at once, and none from ``gone`` on."""

    def __init__(self, total, gone=None):
        super().__init__(total)
        self.gone = total if gone is None else gone

    def __call__(self, offset, limit):
        page = super().__call__(offset, min(limit, 4))
        page["molecules"] = page["molecules"][: max(self.gone - offset, 0)]
        return page


def test_short_pages(spark):
    items, errors = sm.read_pages(spark, Capped(23), "molecules", limit=10, delay=0)
    assert items.select("molecule_chembl_id").distinct().count() == items.count() == 23 and errors.count() == 0
    with pytest.raises(Exception, match=r"(3 of 10|0 of 3) items"):
        sm.read_pages(spark, Capped(23, gone=13), "molecules", limit=10, delay=0)
    items, errors = sm.read_pages(spark, Capped(23, gone=13), "molecules", limit=10, delay=0, on_page_error="skip")
    assert items.count() == 10 and sorted(r.offset for r in errors.collect()) == [10, 20]


def test_errors_of_the_program_are_not_skipped(spark):
    def broken(offset, limit):
        if offset:
            raise AttributeError("a bug")
        return Pages(20)(offset, limit)

    with pytest.raises(Exception, match="a bug"):
        sm.read_pages(spark, broken, "molecules", limit=10, delay=0, on_page_error="skip")
    with pytest.raises(Exception, match="page without items"):
        sm.read_pages(spark, Pages(20), "items", limit=10, delay=0)


def test_folder_names():
    assert sm.DirectoryFetcher("s3a://bucket/pages/").directory == "s3://bucket/pages"
    assert sm.DirectoryFetcher("file:/pages").directory == "/pages"


def test_page_files(spark, folder):
    pages = Pages(23)
    for offset in (0, 10, 20):
        with open(f"{folder}/page_{offset}.json", "w") as f:
            json.dump(pages(offset, 10), f, indent=1)
    items, _ = sm.read_pages(spark, sm.DirectoryFetcher(folder), "molecules", limit=10, delay=0)
    landed = sm.read_landed_pages(spark, folder, "molecules")
    assert items.count() == landed.count() == 23
    assert landed.filter("molecule_properties IS NOT NULL").count() == 0


def test_rest_url():
    fetch = sm.RestFetcher("http://host/molecule.json", {"status": "ACTIVE"}, only=["a", "b"])
    assert fetch.url(2000, 1000) == "http://host/molecule.json?limit=1000&offset=2000&status=ACTIVE&only=a,b"


def test_rest_page(monkeypatch):
    asked = []

    def urlopen(url, timeout):
        asked.append(url)
        return io.BytesIO(b'{"molecules": [{"molecule_chembl_id": "A"}], "page_meta": {"total_count": 1}}')

    monkeypatch.setattr("urllib.request.urlopen", urlopen)
    page = sm.RestFetcher("http://host/molecule.json")(0, 10)
    assert page["page_meta"]["total_count"] == 1 and asked == ["http://host/molecule.json?limit=10&offset=0"]


CSV = """SMILES,Molecule Name,Note
CCO,CHEMBL1,x
"C,C",CHEMBL2,y
CCC,CHEMBL3
CCC,CHEMBL4,z,too,many
CCC,CHEMBL5,"q,r","s,t"
CCC,,x
CCC,OTHER6,x
CCO,CHEMBL1,again
CC,CHEMBL1,x

,CHEMBL7,x
"""


def test_target_csv(spark, folder):
    path = f"{folder}/data_07_2024.csv"
    with open(path, "w") as f:
        f.write(CSV)
    good, rejects = sm.read_targets(spark, path)
    assert sorted(map(tuple, good.collect()), key=repr) == sorted(
        [("CHEMBL1", "CCO"), ("CHEMBL1", "CC"), ("CHEMBL2", "C,C"), ("CHEMBL3", "CCC"), ("CHEMBL7", None)], key=repr
    )
    assert sorted(r.reject_reason for r in rejects.collect()) == [
        "missing_name", "name_prefix", "too_many_fields", "too_many_fields"
    ]
    with open(f"{folder}/bad.csv", "w") as f:
        f.write("name,smiles\nCHEMBL1,C\n")
    with pytest.raises(ValueError, match="molecule name"):
        sm.read_targets(spark, f"{folder}/bad.csv")


def test_files_with_different_headers(spark, folder):
    inbox = f"{folder}/in box %41"
    os.makedirs(inbox)
    for name, text in {
        "a.csv": "Molecule Name,SMILES\nCHEMBL1,CHEMBLX\n",
        "b.csv": "SMILES,Molecule Name\nCHEMBLY,CHEMBL2\n",
        "c.csv": "note,smiles,molecule name\nx,C,CHEMBL3,y\n,CC,CHEMBL4\n",
        "d.csv": "\nMolecule Name,SMILES\nCHEMBL5,C\n",
        "e.csv": "",
    }.items():
        with open(f"{inbox}/{name}", "w") as f:
            f.write(text)
    good, rejects = sm.read_targets(spark, inbox)
    assert {tuple(r) for r in good.collect()} == {
        ("CHEMBL1", "CHEMBLX"), ("CHEMBL2", "CHEMBLY"), ("CHEMBL4", "CC"), ("CHEMBL5", "C")
    }
    assert sorted(r.reject_reason for r in rejects.collect()) == ["empty_file", "too_many_fields"]
    good, rejects = sm.read_targets(spark, f"{inbox}/e.csv")
    assert good.count() == 0 and rejects.count() == 1


def test_short_line_without_structure(spark, folder):
    with open(f"{folder}/t.csv", "w") as f:
        f.write("molecule name,smiles\nCHEMBL1\nCHEMBL2,C\n")
    good, rejects = sm.read_targets(spark, f"{folder}/t.csv")
    assert {tuple(r) for r in good.collect()} == {("CHEMBL1", None), ("CHEMBL2", "C")}
    assert rejects.count() == 0


def test_long_lines_with_quotes(spark, folder):
    long = 'a""b,' * 50_000
    with open(f"{folder}/t.csv", "w") as f:
        f.write(f'molecule name,smiles\nCHEMBL1,"{long}"\nCHEMBL2,"{long}",x\n')
    good, rejects = sm.read_targets(spark, f"{folder}/t.csv")
    assert [(r.target_chembl_id, len(r.smiles)) for r in good.collect()] == [("CHEMBL1", 200_000)]
    assert [r.reject_reason for r in rejects.collect()] == ["too_many_fields"]


def test_line_breaks_inside_quotes(spark, folder):
    with open(f"{folder}/t.csv", "w") as f:
        f.write('molecule name,smiles\nCHEMBL1,"C\nC"\nCHEMBL2,"C\n,C",x\n')
    good, rejects = sm.read_targets(spark, f"{folder}/t.csv", multi_line=True)
    assert {tuple(r) for r in good.collect()} == {("CHEMBL1", "C\nC")}
    assert [r.reject_reason for r in rejects.collect()] == ["too_many_fields"]


def test_fingerprint_files(spark, folder):
    rows = [(f"CHEMBL{i}", [i, i + 1], 2) for i in range(25)]
    fps = spark.createDataFrame(rows, "chembl_id string, on array<int>, pop int")
    path = f"{folder}/fps"
    sm.write_fingerprints(fps.coalesce(1), path, rows_per_file=10)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert len(files) == 3 and all(".zstd." in f for f in files)
    with open(f"{path}/notes.txt", "w") as f:
        f.write("not a fingerprint")
    back = sm.scan_fingerprints(spark, path)
    assert back.columns == ["chembl_id", "morgan_fingerprint"]
    decoded = back.select("chembl_id", sm.bits_decode(F.col("morgan_fingerprint")).alias("on"))
    assert {(r.chembl_id, tuple(r.on)) for r in decoded.collect()} == {(f"CHEMBL{i}", (i, i + 1)) for i in range(25)}


def test_fingerprint_files_as_words(spark, folder):
    fps = spark.createDataFrame([("A", [0, 5], 2), ("B", [], 0), ("C", [2047], 1)], "chembl_id string, on array<int>, pop int")
    sm.write_fingerprints(fps, f"{folder}/w", layout="words")
    back = sm.scan_fingerprints(spark, f"{folder}/w").select("chembl_id", sm.bits_unpack(F.col("words")).alias("on"))
    assert {r.chembl_id: r.on for r in back.collect()} == {"A": [0, 5], "B": [], "C": [2047]}
    with pytest.raises(ValueError):
        sm.write_fingerprints(fps, f"{folder}/v", layout="other")


def test_extra_index_column_is_ignored(spark, folder):
    spark.createDataFrame([("A", "01", 5)], "chembl_id string, morgan_fingerprint string, __index_level_0__ long").write.parquet(f"{folder}/f")
    assert sm.scan_fingerprints(spark, f"{folder}/f").columns == ["chembl_id", "morgan_fingerprint"]


def test_pairs_replace_only_their_targets(spark, folder):
    schema = "chembl_id string, tanimoto_similarity_score double, target_chembl_id string"
    path = f"{folder}/pairs"
    sm.write_pairs(spark.createDataFrame([("a", 0.1, "T1"), ("a", 0.2, "T2"), ("b", 0.3, None)], schema), path)
    sm.write_pairs(spark.createDataFrame([("c", 0.9, "T2")], schema), path)
    assert {tuple(r) for r in read_pairs(spark, path).collect()} == {("a", 0.1, "T1"), ("c", 0.9, "T2")}
    only = read_pairs(spark, path).filter("target_chembl_id = 'T1'")
    assert "PartitionFilters: [isnotnull(target_chembl_id" in only._jdf.queryExecution().executedPlan().toString()


def test_refresh_append_and_named_tables(spark, folder):
    path = f"{folder}/t"
    assert table_or_empty(spark, path, spark.range(1).schema).count() == 0
    sm.refresh_table(spark.range(5), path)
    sm.append_table(spark.range(2), path)
    assert spark.read.parquet(path).count() == 7
    sm.refresh_table(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3


def test_named_tables(spark):
    name = "simmart_test_table"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert table_or_empty(spark, name, spark.range(1).schema).count() == 0
    sm.append_table(spark.range(4), name)
    sm.append_table(spark.range(2), name)
    assert table_or_empty(spark, name, spark.range(1).schema).count() == 6
    sm.refresh_table(spark.range(3), name)
    assert spark.table(name).count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_structures_need_their_columns(spark, folder):
    spark.createDataFrame([("A", "C", 1)], "chembl_id string, canonical_smiles string, extra int").write.parquet(f"{folder}/s")
    assert sm.read_structures(spark, f"{folder}/s").columns == ["chembl_id", "canonical_smiles"]
    spark.range(1).write.parquet(f"{folder}/x")
    with pytest.raises(ValueError):
        sm.read_structures(spark, f"{folder}/x")


def test_row_count_without_a_second_pass(spark):
    df, seen = counted(spark.range(42), "rows")
    df.filter("id > 10").write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 42
