"""Nested records to the three flat staging tables, with per-value validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simmart.schemas import DECIMAL_PROPERTIES, INT_PROPERTIES, LOOKUP, PROPERTY_COLUMNS, RAW_MOLECULE


def typed_number(text: Column, type_name: str, zero_as_null: bool) -> Column:
    """Text to a number; blank text is NULL, and so is zero when ``zero_as_null``."""
    value = F.nullif(F.trim(text), F.lit("")).try_cast(type_name)
    return F.nullif(value, F.lit(0).cast(type_name)) if zero_as_null else value


def bad_number(text: Column, type_name: str, label: str) -> Column:
    """Reject reason of a value that is present but does not fit its type, NULL when it does."""
    filled = F.nullif(F.trim(text), F.lit(""))
    return F.when(
        filled.isNotNull() & filled.try_cast(type_name).isNull(),
        F.when(filled.try_cast("double").isNull(), F.lit(f"not_numeric:{label}")).otherwise(
            F.lit(f"out_of_range:{label}")
        ),
    )


def _typed_property(parent: str, name: str, zero_as_null: bool) -> Column:
    value = F.col(f"{parent}.{name}")
    if name in DECIMAL_PROPERTIES:
        return typed_number(value, "decimal(9,2)", zero_as_null).alias(name)
    if name in INT_PROPERTIES:
        return typed_number(value, "int", False).alias(name)
    return value.alias(name)


def _reasons(reasons: list[Column]) -> Column:
    return F.nullif(F.concat_ws(",", *reasons), F.lit(""))


def split_molecules(items: DataFrame, zero_as_null: bool = True) -> dict[str, DataFrame]:
    """Frames ``dictionary``, ``properties``, ``structures`` and ``rejects`` of nested molecule records.

    A record always gives a dictionary row; the other two only when their part is present. A record without an id or
    with a number that does not fit goes to ``rejects`` as a whole, with its JSON text and the reasons.
    The four frames read ``items`` four times with different columns: hand in a stored table, not a live request.
    """
    reason = _reasons(
        [F.when(F.col("molecule_chembl_id").isNull(), F.lit("null:molecule_chembl_id"))]
        + [bad_number(F.col(f"molecule_properties.{c}"), "decimal(9,2)", c) for c in DECIMAL_PROPERTIES]
        + [bad_number(F.col(f"molecule_properties.{c}"), "int", c) for c in INT_PROPERTIES]
    )
    tagged = items.withColumn("reject_reason", reason)
    good = tagged.filter("reject_reason IS NULL")
    chembl_id = F.col("molecule_chembl_id").alias("chembl_id")
    record = F.to_json(F.struct(*[F.col(f.name) for f in RAW_MOLECULE.fields]))
    return {
        "dictionary": good.select(chembl_id, "molecule_type"),
        "properties": good.filter("molecule_properties IS NOT NULL").select(
            chembl_id, *[_typed_property("molecule_properties", c, zero_as_null) for c in PROPERTY_COLUMNS]
        ),
        "structures": good.filter("molecule_structures IS NOT NULL").select(
            chembl_id, F.col("molecule_structures.canonical_smiles").alias("canonical_smiles")
        ),
        "rejects": tagged.filter("reject_reason IS NOT NULL").select(record.alias("record"), "reject_reason"),
    }


def typed_lookups(items: DataFrame) -> dict[str, DataFrame]:
    """Frames ``lookup`` and ``rejects`` of id-lookup records."""
    tagged = items.withColumn("reject_reason", bad_number(F.col("last_active"), "int", "last_active"))
    good = tagged.filter("reject_reason IS NULL").select(
        *[
            typed_number(F.col(f.name), "int", False).alias(f.name) if f.name == "last_active" else F.col(f.name)
            for f in LOOKUP.fields
        ]
    )
    record = F.to_json(F.struct(*[F.col(f.name) for f in LOOKUP.fields]))
    rejects = tagged.filter("reject_reason IS NOT NULL").select(record.alias("record"), "reject_reason")
    return {"lookup": good, "rejects": rejects}
