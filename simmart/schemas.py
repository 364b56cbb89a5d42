"""Table layouts of the staging area and the mart.

Column names, types, lengths and key columns are fixed values: stored tables and files must keep them.
"""

from __future__ import annotations

from pyspark.sql import types as T

ID_LENGTH = 20
N_BITS = 2048
RADIUS = 2
ROWS_PER_FILE = 100_000
PAGE_SIZE = 1000
MAX_REQUESTS = 125
TOP_K = 10
ID_PREFIX = "CHEMBL"

DECIMAL_PROPERTIES = ["mw_freebase", "alogp", "psa", "cx_logp", "full_mwt"]
INT_PROPERTIES = ["aromatic_rings", "heavy_atoms"]
PROPERTY_COLUMNS = [
    "mw_freebase",
    "alogp",
    "psa",
    "cx_logp",
    "molecular_species",
    "full_mwt",
    "aromatic_rings",
    "heavy_atoms",
]

PROPERTY = T.DecimalType(9, 2)
SCORE = T.DecimalType(9, 6)


def _property_type(name: str) -> T.DataType:
    if name in DECIMAL_PROPERTIES:
        return PROPERTY
    return T.IntegerType() if name in INT_PROPERTIES else T.StringType()


_PROPERTY_FIELDS = [T.StructField(c, _property_type(c)) for c in PROPERTY_COLUMNS]

LOOKUP = T.StructType(
    [
        T.StructField("chembl_id", T.StringType()),
        T.StructField("entity_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("last_active", T.IntegerType()),
        T.StructField("resource_url", T.StringType()),
    ]
)
DICTIONARY = T.StructType(
    [T.StructField("chembl_id", T.StringType()), T.StructField("molecule_type", T.StringType())]
)
PROPERTIES = T.StructType([T.StructField("chembl_id", T.StringType()), *_PROPERTY_FIELDS])
STRUCTURES = T.StructType(
    [T.StructField("chembl_id", T.StringType()), T.StructField("canonical_smiles", T.StringType())]
)
DIMENSION = T.StructType([*DICTIONARY.fields, *_PROPERTY_FIELDS])
FACT = T.StructType(
    [
        T.StructField("source_chembl_id", T.StringType()),
        T.StructField("target_chembl_id", T.StringType()),
        T.StructField("tanimoto_similarity_score", SCORE),
        T.StructField("has_duplicates_of_last_largest_score", T.BooleanType()),
    ]
)
PAIRS = T.StructType(
    [
        T.StructField("chembl_id", T.StringType()),
        T.StructField("tanimoto_similarity_score", T.DoubleType()),
        T.StructField("target_chembl_id", T.StringType()),
    ]
)

# Items as they arrive. Numbers are read as text, so that a bad one rejects its row instead of turning into NULL.
RAW_LOOKUP = T.StructType([T.StructField(f.name, T.StringType()) for f in LOOKUP.fields])
RAW_MOLECULE = T.StructType(
    [
        T.StructField("molecule_chembl_id", T.StringType()),
        T.StructField("molecule_type", T.StringType()),
        T.StructField(
            "molecule_properties",
            T.StructType([T.StructField(c, T.StringType()) for c in PROPERTY_COLUMNS]),
        ),
        T.StructField(
            "molecule_structures", T.StructType([T.StructField("canonical_smiles", T.StringType())])
        ),
    ]
)
COLLECTIONS = {"chembl_id_lookups": RAW_LOOKUP, "molecules": RAW_MOLECULE}

MAX_LENGTHS = {
    "lookup": {"chembl_id": ID_LENGTH, "entity_type": 50, "status": 10, "resource_url": 1000},
    "dictionary": {"chembl_id": ID_LENGTH, "molecule_type": 30},
    "properties": {"chembl_id": ID_LENGTH, "molecular_species": 50},
    "structures": {"chembl_id": ID_LENGTH, "canonical_smiles": 4000},
}
