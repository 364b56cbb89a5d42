import json
from decimal import Decimal

import simmart as sm
from simmart.schemas import RAW_LOOKUP, RAW_MOLECULE
from simmart.sources.paged import decode_items


def items(spark, records, schema=RAW_MOLECULE):
    rows = spark.createDataFrame([(0, json.dumps(r), None) for r in records], "offset bigint, item string, error string")
    return decode_items(rows, schema)[0]


def molecule(name, **props):
    return {"molecule_chembl_id": name, "molecule_type": "Small molecule", "molecule_properties": props,
            "molecule_structures": {"canonical_smiles": "CCO"}}


RECORDS = [
    molecule("A", mw_freebase="46.07", alogp="0.00", psa="", cx_logp=None, aromatic_rings=0, heavy_atoms=3),
    molecule("B", mw_freebase="0.125", alogp=-0.125, full_mwt=12, molecular_species="NEUTRAL"),
    molecule("C", alogp="0.1.2"),
    molecule("D", mw_freebase="12345678.9", aromatic_rings=99999999999),
    {"molecule_chembl_id": "E", "molecule_type": None, "molecule_properties": None, "molecule_structures": None},
    {"molecule_type": "x"},
]


def test_split(spark):
    out = sm.split_molecules(items(spark, RECORDS))
    assert {r.chembl_id for r in out["dictionary"].collect()} == {"A", "B", "E"}
    assert {r.chembl_id for r in out["structures"].collect()} == {"A", "B"}
    props = {r.chembl_id: r for r in out["properties"].collect()}
    assert set(props) == {"A", "B"}
    assert props["A"].alogp is None and props["A"].psa is None and props["A"].aromatic_rings == 0
    assert props["B"].mw_freebase == Decimal("0.13") and props["B"].alogp == Decimal("-0.13")
    assert props["B"].full_mwt == Decimal("12.00") and props["B"].molecular_species == "NEUTRAL"
    reasons = {json.loads(r.record).get("molecule_chembl_id"): r.reject_reason for r in out["rejects"].collect()}
    assert reasons == {
        "C": "not_numeric:alogp", "D": "out_of_range:mw_freebase,out_of_range:aromatic_rings", None: "null:molecule_chembl_id"
    }


def test_zero_kept_on_request(spark):
    props = sm.split_molecules(items(spark, RECORDS), zero_as_null=False)["properties"]
    assert {r.chembl_id: r.alogp for r in props.collect()}["A"] == Decimal("0.00")


def test_ingest_replaces_tables(spark, folder):
    lookups = items(
        spark,
        [{"chembl_id": "A", "entity_type": "COMPOUND", "status": "ACTIVE", "last_active": 34, "resource_url": "/a"},
         {"chembl_id": "B", "entity_type": None, "status": "ACTIVE"},
         {"chembl_id": "C", "entity_type": "COMPOUND", "status": "ACTIVE", "last_active": "soon"}],
        RAW_LOOKUP,
    )
    records = [*RECORDS, molecule("A", alogp="9.9"), molecule("X" * 21)]
    tables = {n: f"{folder}/{n}" for n in ("dictionary", "properties", "structures", "lookup")}
    for _ in range(2):
        out = sm.ingest(items(spark, records), lookups, tables)
    assert spark.read.parquet(tables["dictionary"]).count() == 3
    assert spark.read.parquet(tables["properties"]).count() == 2
    assert [r.chembl_id for r in spark.read.parquet(tables["lookup"]).collect()] == ["A"]
    assert [r.reject_reason for r in out["lookup_rejects"].collect()] == ["null:entity_type"]
    assert [r.reject_reason for r in out["lookup_record_rejects"].collect()] == ["not_numeric:last_active"]
    assert out["record_rejects"].count() == 3
    assert {r.reject_reason for r in out["dictionary_rejects"].collect()} == {"key:chembl_id", "length:chembl_id"}
