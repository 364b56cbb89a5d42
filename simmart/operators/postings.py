"""Pairs of fingerprints above a score by lists of the rows that have a bit.

Let ``t`` be the least score. A pair of ``a`` and ``b`` on-bits with at least that score shares ``t / (1 + t) * (a + b)``
of them, so of a target's rarest bits a row must have at least that number less the bits that are left out: for one bit
this is the prefix filter of Bayardo, Ma and Srikant (2007). It says little where no bit is rare, so as many bits are
counted as tell most rows apart (``simmart.operators.counting``), and what remains is verified.
Blocks of both sides are ranges of the number of on-bits and meet by shuffle where these allow the score. So rows travel
to some blocks of the other side, but what meets in a list never does: only pairs with the score leave a task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simmart.functions.bits import bits_decode, bits_pack, bits_unpack
from simmart.functions.packing import pack
from simmart.operators.counting import Counters
from simmart.operators.meeting import block_count, meet_bands
from simmart.session import stage

# Executors run the functions below without having this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of a block of fingerprints, and those to which blocks may grow where there are very many.
BLOCK_ROWS, LIST_ROWS = 50_000, 200_000
# Blocks of targets, more where there are more than a quarter as many of fingerprints, and the fewest rows of one.
TARGET_BLOCKS, LEAST_ROWS = 24, 1_000
# Pairs that a task gathers for one Arrow batch.
OUT_ROWS = 20_000

FOUND_SCHEMA = "source long, target long, chembl_id string, target_id string, a int, b int, common long"
FOUND = pa.schema([
    ("source", pa.int64()), ("target", pa.int64()), ("chembl_id", pa.string()), ("target_id", pa.string()),
    ("a", pa.int32()), ("b", pa.int32()), ("common", pa.int64()),
])


def _positions(df: DataFrame) -> Column:
    """Sorted distinct on-bits of any stored form."""
    if "words" in df.columns:
        return bits_unpack(F.col("words"))
    if "on" in df.columns:
        return F.sort_array(F.array_distinct("on"))
    return bits_decode(F.col("morgan_fingerprint"))


def _rows(df: DataFrame, id_col: str, n_bits: int) -> DataFrame:
    """``(row, id, pop, words)`` of the distinct rows, stored, so that row numbers stay."""
    known = df.select(F.col(id_col).cast("string").alias("id"), _positions(df).alias("on")).dropna().distinct()
    packed = known.select("id", F.size("on").alias("pop"), bits_pack(F.col("on"), n_bits).alias("words"))
    return stage(packed.withColumn("row", F.monotonically_increasing_id()), "postings")


def _search(sources: pa.Table, targets: pa.Table, least: float, n_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The rows of the sources and of the targets with at least the least score, and their numbers of common on-bits."""
    (own, pops), (words, wanted) = ((pack(t["fp"].combine_chunks(), n_bits), t["pop"].to_numpy().astype(np.int64)) for t in (sources, targets))
    empty = np.flatnonzero(pops == 0)
    for t in np.flatnonzero(wanted == 0):
        yield empty, np.full(len(empty), t), np.zeros(len(empty), np.int64)  # two rows without on-bits are a pair, too
    some = np.flatnonzero(wanted)
    for t, at, common in Counters(own, pops).search(words[some], wanted[some], np.full(len(some), least)):
        yield at, some[t], common


def candidates(sources: DataFrame, targets: DataFrame, least: float, n_bits: int) -> DataFrame:
    """``(source, target, chembl_id, target_id, a, b, common)`` of the pairs of rows with at least the least score.

    ``source`` and ``target`` are row numbers, ``a`` and ``b`` numbers of on-bits. Two rows without on-bits are a pair, too.
    """
    sides = [df.select("id", F.col("words").alias("fp"), "row", "pop") for df in (sources, targets)]
    n_left = block_count(sources.count(), min(BLOCK_ROWS, LIST_ROWS), LIST_ROWS)
    n_right = max(1, min(-(-targets.count() // LEAST_ROWS), max(TARGET_BLOCKS, 4 * n_left)))

    def meet(own: pa.Table, block: pa.Table) -> Iterator[pa.RecordBatch]:
        own = own.sort_by("pop").combine_chunks()

        def found(met: list) -> pa.RecordBatch:
            at, of, common = (pa.array(np.concatenate(each)) for each in zip(*met))
            one, other = own.select(["row", "id", "pop"]).take(at), block.select(["row", "id", "pop"]).take(of)
            columns = [one["row"], other["row"], one["id"], other["id"], one["pop"], other["pop"]]
            return pa.RecordBatch.from_arrays([*(c.combine_chunks() for c in columns), common], schema=FOUND)

        met, rows = [], 0
        for more in _search(own, block, least, n_bits):
            met.append(more)
            rows += len(more[0])
            if rows >= OUT_ROWS:
                yield found(met)
                met, rows = [], 0
        if rows:
            yield found(met)

    return meet_bands(sides[0], n_left, sides[1], n_right, least, meet, FOUND_SCHEMA)


def join_postings(
    targets: DataFrame,
    fps: DataFrame,
    min_score: float,
    empty_score: float = 0.0,
    include_self: bool = True,
    n_bits: int = 2048,
    target_col: str = "target_chembl_id",
) -> DataFrame:
    """The pairs of ``score_targets`` with at least ``min_score``, above 0 and at most 1."""
    if not 0 < min_score <= 1:
        raise ValueError("postings need a min_score above 0, at most 1")
    sources, wanted = _rows(fps, "chembl_id", n_bits), _rows(targets, target_col, n_bits)
    if empty_score < min_score:
        sources, wanted = sources.filter("pop > 0"), wanted.filter("pop > 0")
    union = F.col("a") + F.col("b") - F.col("common")
    score = F.when(union == 0, F.lit(float(empty_score))).otherwise(F.col("common") / union)
    scored = candidates(sources, wanted, min_score, n_bits).select(
        "chembl_id", score.alias("tanimoto_similarity_score"), F.col("target_id").alias(target_col)
    )
    kept = scored.filter(F.col("tanimoto_similarity_score") >= min_score)
    if not include_self:
        kept = kept.filter(F.col("chembl_id") != F.col(target_col))
    if all(side.groupBy("id").count().filter("count > 1").isEmpty() for side in (sources, wanted)):
        return kept
    best = kept.groupBy("chembl_id", target_col).agg(F.max("tanimoto_similarity_score").alias("tanimoto_similarity_score"))
    return best.select("chembl_id", "tanimoto_similarity_score", target_col)
