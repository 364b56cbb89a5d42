"""Load of the star: dimension rows for molecules in the top-k set, then the fact rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simmart.operators.checks import TableRules, check_constraints, distinct_by_key
from simmart.schemas import DIMENSION, FACT, SCORE
from simmart.session import stage
from simmart.sources.tables import append_table, finished, read_table, table_or_empty

SOURCE, TARGET = "source_chembl_id", "target_chembl_id"


def molecule_ids(top: DataFrame) -> DataFrame:
    """Ids that occur as a source or as a target, each once."""
    roles = [top.select(F.col(c).alias("chembl_id")) for c in (SOURCE, TARGET)]
    return roles[0].union(roles[1]).distinct()


def new_fact_rows(top: DataFrame, dim: DataFrame, fact: DataFrame, fact_filter: str = "new_pairs") -> DataFrame:
    """Rows of ``top`` that this load may add.

    ``new_pairs`` keeps pairs the fact table does not hold, so a repeated load adds nothing. ``new_sources`` drops
    every row whose source is already in the dimension, also when its target is new.
    """
    if fact_filter == "new_pairs":
        return top.join(fact.select(SOURCE, TARGET), [SOURCE, TARGET], "left_anti")
    if fact_filter == "new_sources":
        return top.join(dim.select(F.col("chembl_id").alias(SOURCE)), SOURCE, "left_anti").select(*top.columns)
    raise ValueError("fact_filter is 'new_pairs' or 'new_sources'")


def new_dimension_rows(ids: DataFrame, dictionary: DataFrame, props: DataFrame, dim: DataFrame) -> DataFrame:
    """Dimension rows for ``ids`` that are not there yet; a molecule without properties gets none."""
    return _dimension_rows(ids.join(dim.select("chembl_id"), "chembl_id", "left_anti"), dictionary, props)


def _dimension_rows(wanted: DataFrame, dictionary: DataFrame, props: DataFrame) -> DataFrame:
    # The small id set cuts both staging tables before they meet.
    joined = (
        dictionary.join(wanted, "chembl_id", "left_semi")
        .join(props.join(wanted, "chembl_id", "left_semi"), "chembl_id")
        .select(*DIMENSION.names)
    )
    return distinct_by_key(joined, ["chembl_id"])


def load_mart(
    top: DataFrame,
    dictionary: DataFrame,
    props: DataFrame,
    dim: DataFrame,
    fact: DataFrame,
    fact_filter: str = "new_pairs",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(new_dim, new_fact, rejects)``: what to append, and facts whose source or target has no dimension row.

    The rows this load may add, their ids with what the dimension knows of them, and the new dimension rows are stored on
    the way. So ``top``, the fact table and, after the filter, the dimension are read once, and the facts are checked
    against the ids of this load alone. Of tables in buckets of their keys (``create_buckets``) no stored row is shuffled.
    """
    candidates = stage(new_fact_rows(top, dim, fact, fact_filter), "candidates")
    known = dim.select("chembl_id", F.lit(True).alias("known"))
    ids = stage(molecule_ids(candidates).join(known, "chembl_id", "left"), "ids")
    new_dim = stage(_dimension_rows(ids.filter("known IS NULL").select("chembl_id"), dictionary, props), "dim")
    members = ids.filter("known").select("chembl_id").union(new_dim.select("chembl_id"))
    rules = TableRules(key=[SOURCE, TARGET], foreign={SOURCE: "dim", TARGET: "dim"})
    typed = candidates.withColumn("tanimoto_similarity_score", F.col("tanimoto_similarity_score").cast(SCORE))
    new_fact, rejects = check_constraints(typed.select(*FACT.names), rules, {"dim": members})
    return new_dim, new_fact, rejects


def append_mart(
    top: DataFrame, dictionary: DataFrame, props: DataFrame, dim_table: str, fact_table: str, fact_filter: str = "new_pairs"
) -> DataFrame:
    """Run ``load_mart`` against two stored tables, dimension first; returns the rejects.

    The new rows are stored before the first append, so no append changes what the next one reads. If the job dies in
    between, running it again with ``new_pairs`` completes the load; ``new_sources`` would take the dimension rows of
    the lost run for known sources: use ``append_mart_once`` there.
    """
    spark = top.sparkSession
    dim, fact = table_or_empty(spark, dim_table, DIMENSION), table_or_empty(spark, fact_table, FACT)
    new_dim, new_fact, rejects = load_mart(top, dictionary, props, dim, fact, fact_filter)
    new_fact, rejects = stage(new_fact, "fact"), stage(rejects, "rejects")
    append_table(new_dim, dim_table)
    append_table(new_fact, fact_table)
    return rejects


def append_mart_once(
    top: DataFrame,
    dictionary: DataFrame,
    props: DataFrame,
    dim_table: str,
    fact_table: str,
    ledger: str,
    batch: str,
    fact_filter: str = "new_pairs",
) -> DataFrame:
    """``append_mart`` of a named batch, such as a month or a file, exactly once in any ``fact_filter``; the rejects.

    What a batch adds is decided once and kept in a folder of the ledger before anything is appended. A run that finds a decided
    batch appends the decided rows that the tables lack, and a run that finds a finished one appends nothing, whatever
    the tables hold by then. ``dim_table`` and ``fact_table`` are keyed, so a row is there or not, wherever a run died. One
    run of a batch at a time.
    """
    spark = top.sparkSession
    kept = f"{ledger.rstrip('/')}/batch={batch}"
    places = {name: f"{kept}/{name}" for name in ("dim", "fact", "rejects")}

    def mark(step: str) -> None:
        spark.range(1).write.mode("overwrite").parquet(f"{kept}/{step}")

    if not finished(spark, f"{kept}/decided"):
        dim, fact = table_or_empty(spark, dim_table, DIMENSION), table_or_empty(spark, fact_table, FACT)
        for name, rows in zip(places, load_mart(top, dictionary, props, dim, fact, fact_filter)):
            rows.write.mode("overwrite").parquet(places[name])
        mark("decided")
    if not finished(spark, f"{kept}/loaded"):
        for name, table, schema, key in (
            ("dim", dim_table, DIMENSION, ["chembl_id"]),
            ("fact", fact_table, FACT, [SOURCE, TARGET]),
        ):
            there = table_or_empty(spark, table, schema).select(*key)
            missing = read_table(spark, places[name], schema).join(there, key, "left_anti").select(*schema.names)
            append_table(stage(missing, name), table)
        mark("loaded")
    return read_table(spark, places["rejects"])
