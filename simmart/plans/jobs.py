"""The three batch jobs: staging, fingerprints, monthly scoring. Reports are in ``simmart.plans.reports``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from simmart.operators.checks import TableRules, check_constraints
from simmart.operators.fingerprint import BatchFunction, fingerprint_structures, fingerprint_with, text_tokens
from simmart.operators.mart import append_mart
from simmart.operators.records import split_molecules, typed_lookups
from simmart.operators.similarity import score_targets, score_top_k, top_k_similar
from simmart.schemas import MAX_LENGTHS, N_BITS, TOP_K
from simmart.session import stage
from simmart.sources.tables import read_pairs, refresh_table, write_fingerprints, write_pairs

RULES = {
    "lookup": TableRules(["chembl_id"], ["entity_type", "status"], MAX_LENGTHS["lookup"]),
    "dictionary": TableRules(["chembl_id"], [], MAX_LENGTHS["dictionary"]),
    "properties": TableRules(["chembl_id"], [], MAX_LENGTHS["properties"]),
    "structures": TableRules(["chembl_id"], [], MAX_LENGTHS["structures"]),
}


def ingest(
    molecules: DataFrame,
    lookups: DataFrame | None = None,
    tables: dict[str, str] | None = None,
    zero_as_null: bool = True,
) -> dict[str, DataFrame]:
    """Nested items to checked staging frames ``dictionary``, ``properties``, ``structures`` and ``lookup``.

    Rejects come as ``<name>_rejects`` (constraint rejects per table) and ``record_rejects`` / ``lookup_record_rejects``
    (records that could not be typed). With ``tables`` (frame name -> location) the staging tables are replaced.
    The items are stored first, so that a live source is asked once. Without any item the tables are left as they are
    and the job fails.
    """
    items = stage(molecules, "molecules")
    if tables and items.isEmpty():
        raise ValueError("no items arrived: the staging tables are not replaced")
    split = split_molecules(items, zero_as_null)
    out = {"record_rejects": split.pop("rejects")}
    if lookups is not None:
        typed = typed_lookups(stage(lookups, "lookups"))
        out["lookup_record_rejects"] = typed.pop("rejects")
        split.update(typed)
    for name, frame in split.items():
        out[name], out[f"{name}_rejects"] = check_constraints(frame, RULES[name])
    for name, location in (tables or {}).items():
        refresh_table(out[name], location)
    return out


def build_fingerprints(
    structures: DataFrame,
    directory: str | None = None,
    features: Callable[[Column], Column] = text_tokens,
    fn: BatchFunction | None = None,
    n_bits: int = N_BITS,
    layout: str = "text",
    spread: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of a staged structure table and the unusable rows; written to ``directory`` when given.

    ``spread`` deals the structures to so many tasks before they are folded. It shuffles whole structures and is for
    tables in few, large row groups, which too few tasks would read; without it the splits of the scan decide.

    ``fn`` computes on-bits with a user library, a batch at a time; otherwise ``features`` is folded with built-in functions.
    """
    if spread:
        structures = structures.repartition(spread)
    if fn is not None:
        fps, rejects = fingerprint_with(structures, "chembl_id", "canonical_smiles", fn, n_bits)
    else:
        fps, rejects = fingerprint_structures(structures, features=features, n_bits=n_bits)
    if directory:
        write_fingerprints(fps, directory, n_bits=n_bits, layout=layout)
    return fps, rejects


def score_month(
    spark: SparkSession,
    targets: DataFrame,
    fps: DataFrame,
    dictionary: DataFrame,
    props: DataFrame,
    dim_table: str,
    fact_table: str,
    pairs_dir: str | None = None,
    k: int = TOP_K,
    tie_mode: str = "within",
    fact_filter: str = "new_pairs",
    features: Callable[[Column], Column] = text_tokens,
    fn: BatchFunction | None = None,
    n_bits: int = N_BITS,
) -> dict[str, DataFrame]:
    """Score a target list ``(target_chembl_id, smiles)`` and load the mart.

    With ``pairs_dir`` every score is kept and the top-k is taken from the stored scores; without it the pairs are
    never built. Returns ``target_rejects`` and ``fact_rejects``.
    """
    if fn is not None:
        found, target_rejects = fingerprint_with(targets, "target_chembl_id", "smiles", fn, n_bits)
    else:
        found, target_rejects = fingerprint_structures(targets, "target_chembl_id", "smiles", features, n_bits)
    found = found.withColumnRenamed("chembl_id", "target_chembl_id")
    if pairs_dir:
        found = stage(found, "targets")
        write_pairs(score_targets(found, fps, n_bits=n_bits), pairs_dir)
        # The folder may hold other months; only the targets of this one are ranked.
        stored = read_pairs(spark, pairs_dir).join(
            found.select("target_chembl_id").distinct(), "target_chembl_id", "left_semi"
        )
        top = top_k_similar(stored, k, tie_mode)
    else:
        top = score_top_k(found, fps, k, tie_mode, n_bits=n_bits)
    fact_rejects = append_mart(top, dictionary, props, dim_table, fact_table, fact_filter)
    return {"target_rejects": target_rejects, "fact_rejects": fact_rejects}
