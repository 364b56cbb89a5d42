"""The best sources per target, kept up as fingerprints arrive.

The state of a load holds the k + 1 best rows of every target: enough to rank, to flag ties inside the k best and at
their boundary, and to merge with the scores of new fingerprints alone. Each load has a folder of its own, so running
a load again replaces its state and changes nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simmart.operators.similarity import (
    MAX_BLOCK_TARGETS,
    SCORE,
    TARGET,
    _best_per_pair,
    _Blocks,
    _first_k,
    _form,
    _rank,
    _scan,
    _task_top_k,
    _union,
)
from simmart.schemas import N_BITS, PAIRS, TOP_K
from simmart.session import empty, stage
from simmart.sources.tables import CODEC, finished_parts


def stored_loads(spark: SparkSession, location: str) -> list[int]:
    """Numbers of the finished loads, in order."""
    return finished_parts(spark, location, "load")


def _state(spark: SparkSession, location: str, load: int | None) -> DataFrame:
    if load is None:
        return empty(spark, PAIRS)
    return spark.read.schema(PAIRS).parquet(f"{location}/load={load}")


def update_top(
    spark: SparkSession,
    targets: DataFrame,
    fps: DataFrame,
    location: str,
    load: int,
    k: int = TOP_K,
    earlier: DataFrame | None = None,
    empty_score: float = 0.0,
    include_self: bool = True,
    n_bits: int = N_BITS,
    max_block: int = MAX_BLOCK_TARGETS,
) -> None:
    """Add the fingerprints of one load to the state of the loads before it.

    ``targets`` are all targets that the state shall cover; a target's structures must stay the same. Those that the
    state does not know yet are scored against ``earlier``, the fingerprints of the loads before, too. The k + 1st score
    of the state is a lower bound, from which the scan of the new fingerprints starts.
    """
    before = [n for n in stored_loads(spark, location) if n < load]
    old = _state(spark, location, before[-1] if before else None)
    known = targets.select(F.col(TARGET).cast("string").alias(TARGET), _form(targets))
    last = old.groupBy(F.col(TARGET).alias("_known")).agg(F.min(SCORE).alias("last"), F.count(F.lit(1)).alias("n"))
    last = stage(last, "floors")
    floor = F.when(F.col("n") > k, F.col("last")).otherwise(0.0)
    named = known.join(last, F.col(TARGET) == F.col("_known"), "left").withColumn("floor", F.coalesce(floor, F.lit(0.0)))

    def best_of(wanted: DataFrame, sources: DataFrame) -> DataFrame:
        blocks = _Blocks(wanted.select(TARGET, _form(known), "floor"), max_block)
        (frames,) = _scan(blocks, [sources], n_bits, lambda shared: _task_top_k(shared, n_bits, k + 1, empty_score, include_self))
        return _union(spark, frames)

    found = [old, best_of(named, fps)]
    if earlier is not None and before:
        found.append(best_of(named.filter(F.col("_known").isNull()), earlier))
    merged = _first_k(_best_per_pair(_union(spark, found)), k + 1).select(*PAIRS.names)
    merged.write.mode("overwrite").option("compression", CODEC).parquet(f"{location}/load={load}")


def read_top(spark: SparkSession, location: str, k: int = TOP_K, tie_mode: str = "within", load: int | None = None) -> DataFrame:
    """The rows of ``score_top_k`` over all fingerprints up to a load, the last one unless given."""
    loads = [n for n in stored_loads(spark, location) if load is None or n <= load]
    return _rank(_state(spark, location, loads[-1] if loads else None), k, tie_mode)
