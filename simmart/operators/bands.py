"""Best-first search over a fingerprint store that is cut by number of on-bits.

A source with ``q`` on-bits scores at most ``min(p, q) / max(p, q)`` with a target of ``p``. The store holds bands, files
of about equal size in order of on-bits, and the first and last band of every number of on-bits. Targets visit the
bands around their own number first and go outward; a target leaves when its k-th score is at least the bound of every
band it has not seen. Bands that no waiting target needs are not read.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from simmart.functions.bits import bits_decode, int_array, popcount
from simmart.functions.packing import stored_form
from simmart.operators.similarity import (
    MAX_BLOCK_TARGETS,
    SCORE,
    TARGET,
    _best_per_pair,
    _first_k,
    _form,
    _Held,
    _out,
    _rank,
    _target_block,
    _task_top_k,
)
from simmart.schemas import N_BITS, PAIRS, TOP_K
from simmart.session import stage
from simmart.sources.tables import CODEC

# Executors run the functions below without having this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of one band, the unit of reading.
BAND_ROWS = 50_000
# Bounds down to which targets go outward, round by round.
STEPS = (0.75, 0.5, 0.25, 0.0)
_BANDS, _BOUNDS = "fingerprints", "bounds"


def write_bands(fps: DataFrame, directory: str, rows_per_band: int = BAND_ROWS, n_bits: int = N_BITS) -> None:
    """Store ``(chembl_id, on, pop)`` as bands of about ``rows_per_band`` rows, and their bounds.

    Ranges are cut by on-bits and, among rows with equal ones, by a hash of the id, so that no band grows with a
    common number. Each band is one file; its number is a column that filters skip files by.
    """
    spark = fps.sparkSession
    known = stage(fps.filter(F.col("chembl_id").isNotNull() & F.col("on").isNotNull()).select("chembl_id", "on", "pop"), "bands")
    n = max(1, -(-known.count() // rows_per_band))
    ranged = stored_form(known, "words", n_bits).repartitionByRange(n, "pop", F.xxhash64("chembl_id"))
    banded = ranged.sortWithinPartitions("pop").withColumn("band", F.spark_partition_id())
    banded.write.mode("overwrite").option("compression", CODEC).parquet(f"{directory}/{_BANDS}")
    # at most ``n_bits`` + 1 rows
    stored = spark.read.parquet(f"{directory}/{_BANDS}")
    bounds = stored.groupBy("pop").agg(F.min("band").alias("first"), F.max("band").alias("last"))
    bounds.coalesce(1).write.mode("overwrite").parquet(f"{directory}/{_BOUNDS}")


def _edges(bounds: list, n_bits: int) -> tuple[Column, Column]:
    """Per number of on-bits from 0: the first band with at least, the last band with at most so many."""
    first, last = np.full(n_bits + 1, 1 << 30), np.full(n_bits + 1, -1)
    for r in bounds:
        first[r["pop"]], last[r["pop"]] = r["first"], r["last"]
    first, last = np.minimum.accumulate(first[::-1])[::-1], np.maximum.accumulate(last)
    return tuple(int_array(edge.tolist()) for edge in (first, last))


def _meet(n_bits: int, k: int, empty_score: float, include_self: bool):
    def run(_, own: pa.Table, block: pa.Table) -> pa.Table:
        found = []
        if own.num_rows and block.num_rows:
            held = _Held(_target_block(block.select(["id", "fp", "floor"]), n_bits))
            batches = own.select(["id", "fp"]).combine_chunks().to_batches(max_chunksize=10_000)
            found = list(_task_top_k([held], n_bits, k, empty_score, include_self)(iter(batches)))
        return pa.Table.from_batches(found, _out([], [], []).schema)

    return run


def search_bands(
    spark: SparkSession,
    targets: DataFrame,
    directory: str,
    k: int = TOP_K,
    tie_mode: str = "within",
    empty_score: float = 0.0,
    include_self: bool = True,
    n_bits: int = N_BITS,
    max_block: int = MAX_BLOCK_TARGETS,
    steps: tuple[float, ...] = STEPS,
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``score_top_k`` on a store of ``write_bands``, and ``(target_chembl_id, bands)``: how many it read.

    Bands and blocks of targets that need them meet by shuffle; a name with several structures is searched by each of
    them, with the k-th score of the name as the floor of all.
    """
    keep = k + 1 if tie_mode == "boundary" else k
    form = _form(targets)
    count = popcount(F.col("fp")) if form == "words" else F.size("fp") if form == "on" else F.size(bits_decode(F.col("fp")))
    wanted = targets.select(F.col(TARGET).cast("string").alias("id"), F.col(form).alias("fp")).dropna().distinct()
    # no band seen: an empty range
    waiting = wanted.withColumns({"pop": count, "floor": F.lit(0.0), "low": F.lit(0), "high": F.lit(-1)})
    waiting = stage(waiting, "waiting")
    first, last = _edges(spark.read.parquet(f"{directory}/{_BOUNDS}").collect(), n_bits)
    store = spark.read.parquet(f"{directory}/{_BANDS}")
    best, seen = None, []
    for step in (*steps, 0.0)[: len(steps) + (steps[-1] > 0)]:
        # sources whose bound is at least the step, or the k-th score where that is higher
        least = F.greatest(F.lit(float(step)), F.col("floor"))
        fewest = F.greatest(F.lit(0), F.ceil(F.col("pop") * least - 1e-6).cast("int"))
        most = F.when(least > 0, F.least(F.lit(n_bits), F.floor(F.col("pop") / least + 1e-6).cast("int"))).otherwise(n_bits)
        # Two empty fingerprints have a score of their own: they meet in the first step.
        at = waiting.withColumns({"b0": F.element_at(first, fewest + 1), "b1": F.element_at(last, most + 1)})
        none = F.array().cast("array<int>")

        def run_of(a: Column, b: Column) -> Column:
            return F.when(a <= b, F.sequence(a, F.greatest(a, b))).otherwise(none)

        fresh = F.when(F.col("high") < F.col("low"), run_of(F.col("b0"), F.col("b1"))).otherwise(
            F.concat(run_of(F.col("b0"), F.col("low") - 1), run_of(F.col("high") + 1, F.col("b1")))
        )
        at = stage(at.withColumn("fresh", fresh), "at")
        visits = at.select("id", "fp", "floor", F.explode("fresh").alias("band"))
        span = visits.agg(F.min("band").alias("a"), F.max("band").alias("b"), F.count(F.lit(1)).alias("n")).first()
        if span["n"]:
            n_blocks = max(1, -(-at.count() // max_block))
            block = F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int")
            visits = visits.withColumn("block", block)
            needed = visits.select(F.col("band").alias("_band"), F.col("block").alias("_block")).distinct()
            # the range is pushed into the scan, the exact bands are joined
            sources = store.filter(F.col("band").between(span["a"], span["b"]))
            own = sources.join(needed, F.col("band") == F.col("_band")).select(
                F.col("chembl_id").cast("string").alias("id"), F.col("words").alias("fp"), "band", F.col("_block").alias("block")
            )
            hits = own.groupBy("band", "block").cogroup(visits.groupBy("band", "block")).applyInArrow(
                _meet(n_bits, keep, empty_score, include_self), PAIRS
            )
            both = hits if best is None else hits.unionByName(best)
            best = stage(_first_k(_best_per_pair(both), keep).select(*PAIRS.names), "best")
            seen.append(at.select(F.col("id").alias(TARGET), F.size("fresh").alias("bands")))
        if best is None:
            kth = at.select("id").limit(0).withColumn("kth", F.lit(0.0))
        else:
            kth = best.groupBy(F.col(TARGET).alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min(SCORE).alias("kth"))
            kth = kth.filter(F.col("n") == keep).select("id", "kth")
        moved = at.join(kth, "id", "left").select(
            "id",
            "fp",
            "pop",
            F.coalesce("kth", "floor").alias("floor"),
            F.when(F.size("fresh") == 0, F.col("low")).when(F.col("high") < F.col("low"), F.col("b0")).otherwise(F.least("low", "b0")).alias("low"),
            F.when(F.size("fresh") == 0, F.col("high")).when(F.col("high") < F.col("low"), F.col("b1")).otherwise(F.greatest("high", "b1")).alias("high"),
        )
        # Whoever has not seen a band is bounded below the step; a k-th score of at least that is final.
        waiting = stage(moved.filter((F.col("floor") < step) if step > 0 else F.lit(False)), "waiting")
        if waiting.isEmpty():
            break
    if best is None:
        best = spark.createDataFrame([], PAIRS)
    read = seen[0] if seen else spark.createDataFrame([], f"{TARGET} string, bands int")
    for more in seen[1:]:
        read = read.unionByName(more)
    return _rank(best, k, tie_mode), read.groupBy(TARGET).agg(F.sum("bands").cast("int").alias("bands"))

