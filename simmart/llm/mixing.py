"""Mixing of sources to target weights by Pfair scheduling (operator 2).

Each source is cut into blocks of equal bytes. Its target is the fluid one: all sources that still have blocks share
the places by their exact weights, and when one ends the others go on by theirs. The j-th block of a source may start
at the place where its target passes j (rounded down) and must be placed before the one where it passes j + 1 (rounded
up). The target itself is a fractional schedule in these bounds, so earliest deadline first among the blocks that may
start finds a whole one: every source is within less than one block of its target at every place. All bounds are
computed in whole numbers, nothing is rounded before.
"""

from __future__ import annotations

import heapq
import math
from array import array
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from fractions import Fraction
from numbers import Rational

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BYTES = 64 << 10
# Rows of one sorted part of a source.
PART_ROWS = 10_000
# Blocks of a source in one row of the table of places.
PLAN_BLOCKS = 256


@dataclass(frozen=True)
class Phase:
    """The target between the ends of two sources: those of ``order`` from ``at`` on have blocks left.

    A source of weight w has had w * x blocks at time x; the place of that time is ``ended + total * x``.
    """

    order: list[int]
    weights: dict[int, int]
    at: int
    ended: int
    total: int
    end: Fraction
    periods: Fraction

    @property
    def shares(self) -> dict[int, int]:
        return {s: self.weights[s] for s in self.order[self.at :]}


def phases(weights: dict[int, int], blocks: dict[int, int]) -> list[Phase]:
    """Phases of the target of sources with ``blocks`` and whole ``weights``, one for each source that has blocks."""
    ends = {s: Fraction(n, weights[s]) for s, n in blocks.items() if n}
    order = sorted(ends, key=lambda s: (ends[s], s))
    ended, total, before, out = 0, sum(weights[s] for s in order), Fraction(0), []
    for at, s in enumerate(order):
        out.append(Phase(order, weights, at, ended, total, ends[s], ends[s] - before))
        ended, total, before = ended + blocks[s], total - weights[s], ends[s]
    return out


def pfair_places(weights: dict[int, int], blocks: dict[int, int]) -> dict[int, array]:
    """The places of the blocks of every source, by their numbers."""
    plan = phases(weights, blocks)
    # Quotients of whole numbers are rounded in order: only phases whose ends round alike are compared exactly.
    ends = [p.end.numerator / p.end.denominator for p in plan]
    ended, total = [p.ended for p in plan], [p.total for p in plan]
    places = {s: array("q", bytes(8 * n)) for s, n in blocks.items()}
    waiting, ready = [(0, s, 0) for s in sorted(p.order[p.at] for p in plan)], []
    for place in range(sum(blocks.values())):
        while waiting and waiting[0][0] <= place:
            _, s, j = waiting[0]
            w, x = weights[s], (j + 1) / weights[s]
            at = bisect_left(ends, x)
            if ends[at] == x:
                at = bisect_left(plan, Fraction(j + 1, w), at, bisect_right(ends, x) - 1, key=lambda p: p.end)
            whole, rest = divmod((j + 1) * total[at], w)
            heapq.heappush(ready, (ended[at] + whole + (rest > 0), s, j))
            if j + 1 < blocks[s]:
                heapq.heapreplace(waiting, (ended[at] + whole, s, j + 1))
            else:
                heapq.heappop(waiting)
        deadline, s, j = heapq.heappop(ready)
        assert place < deadline
        places[s][j] = place
    return places


def pfair_period(shares: dict[int, int]) -> list[tuple[int, int, int]]:
    """``(place, source, number)`` of every block when each source has as many blocks as its weight."""
    return sorted((p, s, j) for s, own in pfair_places(shares, shares).items() for j, p in enumerate(own))


def schedule(weights: dict[int, float | Fraction], blocks: dict[int, int]) -> dict[int, array]:
    """``pfair_places`` for any weights, which count with their exact values. Sources of weight 0 come after all others,
    in equal shares."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    if min(exact.values(), default=0) < 0:
        raise ValueError("weights below 0")
    scale = math.lcm(*(w.denominator for w in exact.values()))
    whole = {s: int(w * scale) for s, w in exact.items() if w}
    places = pfair_places(whole, {s: blocks[s] for s in whole})
    last = {s: n for s, n in blocks.items() if s not in whole}
    start = sum(blocks[s] for s in whole)
    for s, own in pfair_places(dict.fromkeys(last, 1), last).items():
        places[s] = array("q", (start + p for p in own))
    return places


def mix_sources(
    docs: DataFrame,
    weights: dict | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    power: float = 0.5,
    block_bytes: int = BLOCK_BYTES,
    period: int | None = None,
    seed: int = 0,
    max_sources: int | None = None,
) -> DataFrame:
    """Every row of ``docs`` with ``mix_block`` (number inside its source) and ``mix_slot`` (place of the block).

    Reading blocks by ``mix_slot`` mixes the sources to ``weights`` (a number for each source; sources not named get
    none of their own and share the smallest given weight). Without weights they are the bytes of a source to the
    ``power``. Weights count exactly, so at every place each source is within less than one block of its target;
    ``period``, to which they were rounded, is accepted and changes nothing. Sources of weight 0 come last. All rows are
    placed: when a source ends, the others go on by their weights. Inside a source rows are ordered by a hash of the id,
    then by id; a row belongs to the block in which it starts, so blocks differ from ``block_bytes`` by less than one row. Null texts
    have no bytes; a null source is a source of its own; repeated rows are placed each. Every source is scheduled for
    itself, at any number of them. Only a caller who gives ``max_sources`` has, of more sources, those without a given
    weight and with the fewest bytes scheduled together as one source with the sum of their weights.
    """
    size = F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long")
    keyed = docs.select(
        F.struct("*").alias("row"),
        F.col(id_col).alias("id"),
        size.alias("size"),
        F.xxhash64(F.col(id_col), F.lit(seed)).alias("key"),
        F.col(source_col).cast("string").alias("name"),
    )
    weights = weights or {}
    totals = keyed.groupBy("name").agg(F.sum("size").alias("bytes")).toArrow()
    largest = list(zip(totals["name"].to_pylist(), totals["bytes"].to_pylist()))
    largest.sort(key=lambda r: (r[0] not in weights, -r[1], r[0] is not None, r[0] or ""))
    own = len(largest) if max_sources is None or len(largest) <= max_sources else max_sources - 1
    if own < len(largest) and largest[own][0] in weights:
        raise ValueError(f"weights for more than {own} sources")
    least = min(weights.values(), default=0.0)

    def weight(name: str | None, size: int) -> Fraction:
        given = weights.get(name, least) if weights else max(1, size) ** power
        return Fraction(given if isinstance(given, Rational) else float(given))

    single = sorted(largest[:own], key=lambda r: (r[0] is not None, r[0] or ""))
    names, sizes, target = [n for n, _ in single], [size for _, size in single], [weight(*r) for r in single]
    if own < len(largest):
        sizes.append(sum(size for _, size in largest[own:]))
        target.append(sum(weight(*r) for r in largest[own:]))
    spark = docs.sparkSession
    blocks = {i: max(1, -(-size // block_bytes)) for i, size in enumerate(sizes)}
    plan = schedule(dict(enumerate(target)), blocks)
    numbers = {"own_name": pa.array(names, pa.string()), "number": pa.array(range(len(names)), pa.int32())}
    number = spark.createDataFrame(pa.table(numbers))
    parts = max(1, math.ceil(docs.count() / PART_ROWS))
    keyed = keyed.join(F.broadcast(number), F.expr("name <=> own_name"), "left").select(
        "row", "id", "size", "key", F.coalesce("number", F.lit(len(names))).alias("source"), F.pmod("key", F.lit(parts)).alias("part")
    )
    # Bytes of each part of a source, and of all parts before it.
    sums = keyed.groupBy("source", "part").agg(F.sum("size").alias("bytes"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start"))
    pieces = [(s, k) for s, n in blocks.items() for k in range(-(-n // PLAN_BLOCKS))]
    places = [np.frombuffer(plan[s], np.int64)[k * PLAN_BLOCKS : (k + 1) * PLAN_BLOCKS] for s, k in pieces]
    offsets = np.cumsum([0, *map(len, places)]).astype(np.int32)
    places_df = spark.createDataFrame(
        pa.table(
            {
                "source": pa.array([s for s, _ in pieces], pa.int32()),
                "piece": pa.array([k for _, k in pieces], pa.int64()),
                "places": pa.ListArray.from_arrays(offsets, np.concatenate([np.empty(0, np.int64), *places])),
            }
        )
    )
    last = {"source": pa.array(blocks, pa.int32()), "last": pa.array([n - 1 for n in blocks.values()], pa.int64())}
    last_df = spark.createDataFrame(pa.table(last))

    running = Window.partitionBy("source", "part").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, -1)
    inside = keyed.withColumn("inside", F.coalesce(F.sum("size").over(running), F.lit(0)))
    # Bounded tables: sources x parts rows are joined by key; the places are 8 bytes a block.
    block = F.floor((F.col("start") + F.col("inside")) / block_bytes)
    placed = inside.join(starts, ["source", "part"]).join(F.broadcast(last_df), "source")
    placed = placed.withColumn("block", F.least(block, F.col("last")).cast("long"))
    # A condition, not a column of its own: behind two projections Spark would carry the whole rows through the shuffle.
    piece = F.floor(placed["block"] / PLAN_BLOCKS) == places_df["piece"]
    placed = placed.join(F.broadcast(places_df), (placed["source"] == places_df["source"]) & piece)
    slot = F.get("places", (F.col("block") % PLAN_BLOCKS).cast("int"))
    own = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("mix_block", "mix_slot")]
    return placed.select(*own, F.col("block").alias("mix_block"), slot.alias("mix_slot"))
