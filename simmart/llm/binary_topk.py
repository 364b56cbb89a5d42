"""Exact k nearest binary codes by Hamming distance (operator 9).

Incremental multi-index hashing: codes are indexed by each of their segments. In round r every segment is searched at
exactly r flipped bits. After round r all codes within ``segments * (r + 1) - 1`` bits have been seen, so a query is
done when its k-th verified distance is within that.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simmart.session import stage

BITS, SEGMENTS, K = 64, 4, 10
# Distinct codes of one part of the index. A segment value that more codes share is cut into more parts.
PART_CODES = 200_000
# Distances held at once by a task.
STEP = 2_000_000


def sign_code(vector: Column) -> Column:
    """Up to 64 signs as one number, position 0 lowest; values that are not positive, null or missing give 0."""
    bits = F.transform(
        F.slice(vector, 1, BITS),
        lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")),
    )
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def _segment(code: Column, n: int, width: int) -> Column:
    return F.shiftrightunsigned(code, n * width).bitwiseAND(F.lit((1 << width) - 1))


def _masks(width: int, r: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), r)], np.uint64)


_OUT = pa.schema([("query_id", pa.int64()), ("code", pa.int64()), ("distance", pa.int32())])


def _probe(width: int, r: int, k: int):
    """One part of the index of one segment against the queries that reach it; at most k distinct codes a query."""

    def run(key, codes: pa.Table, queries: pa.Table) -> pa.Table:
        if not codes.num_rows or not queries.num_rows:
            return _OUT.empty_table()
        shift, low = np.uint64(key[0].as_py() * width), np.uint64((1 << width) - 1)
        own = codes["code"].combine_chunks().to_numpy().view(np.uint64)
        value = (own >> shift) & low
        order = np.argsort(value, kind="stable")
        own, value = own[order], value[order]
        table = np.searchsorted(value, np.arange((1 << width) + 1, dtype=np.uint64))
        masks = _masks(width, r)
        found = []
        for name, code, worst in zip(*(queries[c].to_pylist() for c in ("query_id", "code", "worst"))):
            wanted = np.uint64(code % (1 << 64))
            probe = (((wanted >> shift) & low) ^ masks).astype(np.int64)
            begin, size = table[probe], table[probe + 1] - table[probe]
            keep = size > 0
            begin, size = begin[keep], size[keep]
            if not len(size):
                continue
            near = None
            cuts = np.searchsorted(np.cumsum(size), np.arange(0, int(size.sum()), STEP), "left")
            for a, b in zip(cuts, [*(cuts[1:] + 1), len(size)]):
                at = np.arange(int(size[a:b].sum())) + np.repeat(begin[a:b] - (np.cumsum(size[a:b]) - size[a:b]), size[a:b])
                new = np.stack([np.bitwise_count(own[at] ^ wanted).astype(np.uint64), own[at]])
                near = new if near is None else np.concatenate([near, new], axis=1)
                near = near[:, near[0] <= worst]
                near = near[:, np.lexsort((near[1], near[0]))]
                # All codes as near as the k-th stay: ties are settled by the ids behind the codes.
                if near.shape[1] > k:
                    near = near[:, near[0] <= near[0, k - 1]]
            found.append((name, near))
        sizes = [n.shape[1] for _, n in found]
        return pa.table(
            {
                "query_id": pa.array(np.repeat([q for q, _ in found], sizes).astype(np.int64)),
                "code": pa.array(np.concatenate([np.zeros(0, np.uint64), *(n[1] for _, n in found)]).view(np.int64)),
                "distance": pa.array(np.concatenate([np.zeros(0, np.uint64), *(n[0] for _, n in found)]).astype(np.int32)),
            },
            schema=_OUT,
        )

    return run


def nearest_codes(
    vectors: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    code_col: str = "code",
    k: int = K,
    segments: int = SEGMENTS,
    part_codes: int = PART_CODES,
) -> DataFrame:
    """``(query_id, rank, neighbor_id, distance)``: the k nearest rows of ``vectors`` to every query, itself left out.

    ``vectors`` and ``queries`` have integer ids and 64-bit codes. Rows are ordered by distance, then id; with fewer
    than k other rows all are given. Rows with a null id or code are neither found nor searched for; rows with equal
    ids and codes count once. Equal codes are one entry of the index, which carries the k + 1 smallest of its ids.
    """
    width = BITS // segments
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(code_col).cast("long").alias("code")).dropna().distinct()
    # The first ids of each code: cut by parts of a code before the whole, so a common code is not sorted in one task.
    part = Window.partitionBy("code", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id")
    whole = Window.partitionBy("code").orderBy("id")
    first = rows.withColumn("n", F.row_number().over(part)).filter(F.col("n") <= k + 1)
    first = first.withColumn("n", F.row_number().over(whole)).filter(F.col("n") <= k + 1).drop("n")
    holders = stage(first, "holders")
    distinct = holders.select("code").distinct()

    each = F.explode(F.array(*(F.struct(F.lit(n).alias("segment"), _segment(F.col("code"), n, width).alias("value")) for n in range(segments))))
    entries = distinct.select("code", each.alias("s")).select("code", "s.segment", "s.value")
    n_codes = distinct.count()
    # Parts by the low bits of a segment value; values that many codes share are cut further by the code.
    low = max(0, min(width, (max(1, n_codes) // part_codes).bit_length()))
    entries = entries.withColumn("low", F.col("value").bitwiseAND(F.lit((1 << low) - 1)))
    parts = entries.groupBy("segment", "low").count()
    parts = stage(parts.select("segment", "low", F.ceil(F.col("count") / part_codes).cast("int").alias("cuts")), "parts")
    index = entries.join(F.broadcast(parts), ["segment", "low"])
    index = index.withColumn("cut", F.pmod(F.xxhash64("code"), F.col("cuts")).cast("int"))
    index = stage(index.select("segment", "low", "cut", "code"), "index")

    own = queries.select(F.col(id_col).cast("long").alias("query_id"), F.col(code_col).cast("long").alias("code"))
    # Neighbours that a query can have: k, or with at most k ids all but its own.
    ids = rows.select("id").distinct().limit(k + 1)
    total = ids.count()
    own, wanted = own.dropna().distinct(), F.lit(k)
    if total <= k:
        own = own.join(F.broadcast(ids.withColumnRenamed("id", "_own")), F.col("query_id") == F.col("_own"), "left")
        wanted = F.when(F.col("_own").isNull(), total).otherwise(total - 1)
    waiting = stage(own.select("query_id", "code", wanted.alias("wanted"), F.lit(BITS).alias("worst")), "waiting")
    best = None
    for r in range(width + 1):
        reach = _reach(waiting, parts, segments, width, low, r)
        hits = (
            index.groupBy("segment", "low", "cut")
            .cogroup(reach.groupBy("segment", "low", "cut"))
            .applyInArrow(_probe(width, r, k + 1), "query_id long, code long, distance int")
        )
        codes = hits if best is None else hits.unionByName(best)
        codes = codes.groupBy("query_id", "code").agg(F.min("distance").alias("distance"))
        # A query's k-th distance over its nearest codes; each code stands for at most k + 1 rows.
        ranked = (
            codes.join(holders, "code")
            .filter(F.col("id") != F.col("query_id"))
            .withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id")))
            .filter(F.col("rank") <= k)
        )
        best_rows = stage(ranked, "best")
        best = best_rows.select("query_id", "code", "distance").distinct()
        kth = best_rows.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("kth"))
        covered = segments * (r + 1) - 1
        state = waiting.drop("worst").join(kth, "query_id", "left")
        full = F.coalesce("n", F.lit(0)) >= F.col("wanted")
        left = state.filter(~(full & (F.coalesce("kth", F.lit(BITS)) <= covered)))
        waiting = stage(
            left.select("query_id", "code", "wanted", F.when(full, F.col("kth")).otherwise(BITS).alias("worst")), "waiting"
        )
        if waiting.isEmpty():
            break
    return best_rows.select("query_id", "rank", F.col("id").alias("neighbor_id"), "distance")


def _reach(waiting: DataFrame, parts: DataFrame, segments: int, width: int, low: int, r: int) -> DataFrame:
    """Each waiting query at every part that r flipped bits of a segment can lead to."""
    mask = (1 << low) - 1
    flips = [m for m in range(mask + 1) if m.bit_count() <= r]
    each = F.explode(
        F.array(*(F.struct(F.lit(n).alias("segment"), _segment(F.col("code"), n, width).alias("value")) for n in range(segments)))
    )
    seen = waiting.select("*", each.alias("s")).select("query_id", "code", "worst", "s.segment", "s.value")
    seen = seen.withColumn("flip", F.explode(F.array(*(F.lit(m).cast("long") for m in flips))))
    seen = seen.withColumn("low", F.col("value").bitwiseAND(F.lit(mask)).bitwiseXOR(F.col("flip")))
    seen = seen.join(F.broadcast(parts), ["segment", "low"])
    seen = seen.withColumn("cut", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    return seen.select("segment", "low", "cut", "query_id", "code", "worst")
