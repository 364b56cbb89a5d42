"""Structures, texts and vectors to folded bit fingerprints.

A fingerprint frame has the columns ``chembl_id``, ``on`` (sorted on-bit positions) and ``pop`` (their number).
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simmart.functions.bits import once
from simmart.functions.text import is_blank
from simmart.schemas import N_BITS
from simmart.session import stage

# Executors run the functions below without having this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EMPTY = "empty"
INVALID = "invalid"


def text_tokens(text: Column) -> Column:
    """Distinct space-separated tokens of the whole text."""
    return F.array_distinct(F.array_remove(F.split(text, " "), ""))


def token_ngrams(text: Column, n: int = 2) -> Column:
    """Runs of ``n`` consecutive tokens."""
    return _ngrams(F.array_remove(F.split(text, " "), ""), n, " ")


def char_ngrams(text: Column, n: int = 3) -> Column:
    """Runs of ``n`` consecutive characters, the usual feature for short structure strings."""
    return _ngrams(F.array_remove(F.split(text, ""), ""), n, "")


def _ngrams(parts: Column, n: int, separator: str) -> Column:
    def runs(p: Column) -> Column:
        count = F.size(p) - (n - 1)
        starts = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(p, i, F.lit(n)), separator)))

    return once(parts, runs)


def sign_bits(vector: Column) -> Column:
    """Positions of the positive entries of a numeric vector."""
    at = F.transform(vector, lambda x, i: F.when(x > 0, i))
    return F.filter(at, lambda i: i.isNotNull())


def feature_bit(feature: Column, n_bits: int = N_BITS) -> Column:
    """Bit of a feature: the first 32 bits of its md5, modulo the width."""
    # For a width that divides 16**4 the last four of the eight hex digits decide.
    digits = 4 if 16**4 % n_bits == 0 else 8
    number = F.conv(F.substring(F.md5(feature), 9 - digits, digits), 16, 10)
    return F.pmod(number.cast("bigint" if digits == 8 else "int"), F.lit(n_bits)).cast("int")


def fold_bits(features: Column, n_bits: int = N_BITS) -> Column:
    """Sorted distinct bits of an array of features."""
    return F.sort_array(F.array_distinct(F.transform(features, lambda f: feature_bit(f, n_bits))))


def fold_fingerprint(
    df: DataFrame, id_col: str, features: Column, n_bits: int = N_BITS
) -> DataFrame:
    """Fold a feature array per row into ``(chembl_id, on, pop)``. Row-wise: no shuffle, no Python."""
    folded = df.select(F.col(id_col).alias("chembl_id"), fold_bits(features, n_bits).alias("on"))
    return folded.select("chembl_id", "on", F.size("on").alias("pop"))


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")


def fingerprint_structures(
    df: DataFrame,
    id_col: str = "chembl_id",
    structure_col: str = "canonical_smiles",
    features: Callable[[Column], Column] = text_tokens,
    n_bits: int = N_BITS,
) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of usable structures, and the other rows with a reason.

    ``features`` turns the structure column into an array of strings; NULL means that it cannot be parsed.
    """
    require_columns(df, id_col, structure_col)
    structure = F.col(structure_col)
    usable = df.filter(~is_blank(structure))
    # The generator keeps the filter above it: pushed into the scan, it would compute the features of every row twice.
    found = usable.select(F.col(id_col), F.explode_outer(F.array(features(structure))).alias("features")).filter(
        "features IS NOT NULL"
    )
    good = fold_fingerprint(found, id_col, F.col("features"), n_bits)
    reason = F.when(is_blank(structure), F.lit(EMPTY)).when(features(structure).isNull(), F.lit(INVALID))
    rejects = df.select(
        F.col(id_col).alias("chembl_id"), structure.alias("structure"), reason.alias("reject_reason")
    ).filter("reject_reason IS NOT NULL")
    return good, rejects


BatchFunction = Callable[[pa.Array], "pa.Array | Iterable[Iterable[int] | None]"]


def per_structure(fn: Callable[[str], Iterable[int] | None]) -> BatchFunction:
    """A function of one structure as a function of a batch."""

    def batch(structures: pa.Array) -> list:
        found = [fn(s) for s in structures.to_pylist()]
        return [None if f is None else list(f) for f in found]

    return batch


def fingerprint_with(
    df: DataFrame,
    id_col: str,
    structure_col: str,
    fn: BatchFunction,
    n_bits: int = N_BITS,
    store: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Fingerprints from a user function, batch by batch on the executors.

    ``fn`` gets the structures of a batch as an Arrow array of strings and returns one list of on-bit positions for
    each, as an Arrow array or any iterable; NULL (None) means that a structure cannot be parsed. A chemistry toolkit
    goes in here; ``per_structure`` wraps one that takes single structures. Blank structures never reach ``fn``. The
    function runs once per row, now, and its results are kept in the scratch folder; with ``store=False`` it runs again
    for every action.
    """
    require_columns(df, id_col, structure_col)
    structure = F.col(structure_col)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            filled = pc.invert(batch.column(2))
            found = fn(batch.column(1).filter(filled))
            found = found if isinstance(found, pa.Array) else pa.array(list(found), pa.list_(pa.int64()))
            if len(found) != pc.sum(filled).as_py():
                raise ValueError("a fingerprint function returns one entry for each structure")
            # Blank rows take the NULL behind the last entry.
            place = np.full(len(batch), len(found))
            place[filled.to_numpy(zero_copy_only=False)] = np.arange(len(found))
            lists = pa.concat_arrays([found.cast(pa.list_(pa.int64())), pa.nulls(1, pa.list_(pa.int64()))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), lists.take(pa.array(place))],
                names=["chembl_id", "structure", "blank", "found"],
            )

    id_type = df.schema[id_col].dataType.simpleString()
    done = df.select(
        F.col(id_col).alias("chembl_id"), structure.alias("structure"), is_blank(structure).alias("blank")
    ).mapInArrow(apply, f"chembl_id {id_type}, structure string, blank boolean, found array<bigint>")
    bits = F.transform("found", lambda p: F.pmod(p, F.lit(n_bits)).cast("int"))
    # Only rejects show their structure.
    done = done.select(
        "chembl_id",
        F.when(F.col("found").isNull(), F.col("structure")).alias("structure"),
        "blank",
        F.sort_array(F.array_distinct(bits)).alias("on"),
    )
    if store:
        done = stage(done, "fingerprints")
    good = done.filter("on IS NOT NULL").select("chembl_id", "on", F.size("on").alias("pop"))
    reason = F.when(F.col("blank"), F.lit(EMPTY)).otherwise(F.lit(INVALID))
    rejects = done.filter("on IS NULL").select("chembl_id", "structure", reason.alias("reject_reason"))
    return good, rejects
