"""Two tables cut into blocks of rows, each of which meets each of the other by shuffle."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Executors run the functions below without having this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# From this number of blocks on they grow, so that rows do not travel ever more often.
BLOCK_COUNT = 12


def block_count(rows: int, least: int, most: int) -> int:
    """Blocks of about ``least`` rows; beyond ``BLOCK_COUNT`` of them blocks grow first, up to ``most`` rows each."""
    return max(1, min(-(-rows // least), max(BLOCK_COUNT, -(-rows // most))))


def meet_blocks(left: DataFrame, n_left: int, right: DataFrame, n_right: int, meet, schema) -> DataFrame:
    """Every block of one side meets every block of the other by shuffle; rows are dealt by ``id`` and ``fp``.

    Both sides have the same columns. ``meet`` gets a table of each block, with rows in both, and yields batches, so a
    task never holds all that two blocks have found. Every row travels once for each block of the other side.
    """

    def dealt(df: DataFrame, is_left: bool, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        number = F.pmod(F.xxhash64("id", "fp"), F.lit(n_own)).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other)
        rows = df.select(F.lit(is_left).alias("is_left"), *df.columns, number, every)
        return rows.select("s", "t", "is_left", *df.columns)

    rows = dealt(left, True, "s", n_left, "t", n_right).union(dealt(right, False, "t", n_right, "s", n_left))
    return _met(rows, meet, schema)


def _met(rows: DataFrame, meet, schema) -> DataFrame:
    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        on_left = table["is_left"]
        sides = [table.filter(side).combine_chunks() for side in (on_left, pc.invert(on_left))]
        if all(side.num_rows for side in sides):
            del table, on_left
            yield from meet(*sides)

    return rows.groupBy("s", "t").applyInArrow(both, schema)


class _Bands:
    """Rows in order of ``pop`` cut into ``n`` blocks of about the same weight; rows of one ``pop`` may be cut, too."""

    def __init__(self, df: DataFrame, n: int, weight):
        self.df, self.n = df, n
        # a row for each number of on-bits
        counts = sorted((r.pop, r.rows) for r in df.groupBy("pop").agg(F.count(F.lit(1)).alias("rows")).collect())
        size = max(1, sum(rows * weight(pop) for pop, rows in counts)) / n
        self.pops: list[tuple[int, int, float, float]] = []
        self.ranges: list[list[int]] = [[] for _ in range(n)]
        start = 0.0
        for pop, rows in counts:
            self.pops.append((pop, rows, start, weight(pop) / size))
            end = start + rows * weight(pop) / size
            for block in range(min(int(start - 1e-6), n - 1), min(int(end + 1e-6), n - 1) + 1):
                self.ranges[block].append(pop)
            start = end

    def dealt(self, is_left: bool, own: str, other: str, others: list[list[int]]) -> DataFrame:
        """The rows, each once for every block of the other side that its block meets."""
        spark, columns = self.df.sparkSession, self.df.columns
        places = spark.createDataFrame(self.pops, "pop int, rows long, start double, step double")
        partners = spark.createDataFrame(list(enumerate(others)), f"{own} int, others array<int>")
        block = F.least(F.floor(F.col("start") + F.pmod(F.xxhash64("id", "fp"), F.col("rows")) * F.col("step")), F.lit(self.n - 1))
        rows = self.df.join(F.broadcast(places), "pop").select(*columns, block.cast("int").alias(own))
        rows = rows.join(F.broadcast(partners), own).select(*columns, own, F.explode("others").alias(other))
        return rows.select("s", "t", F.lit(is_left).alias("is_left"), *columns)


def meet_bands(left: DataFrame, n_left: int, right: DataFrame, n_right: int, least: float, meet, schema) -> DataFrame:
    """``meet_blocks`` for scores of at least ``least`` only: blocks are ranges of ``pop``, the number of on-bits.

    Blocks meet if their numbers of on-bits allow the score, so most rows travel to few blocks of the other side. Blocks
    on the right have about the same number of rows and on-bits together.
    """
    one, other = _Bands(left, n_left, lambda pop: 1), _Bands(right, n_right, lambda pop: pop + 64)

    def may_meet(a: list[int], b: list[int]) -> bool:
        return bool(a and b) and min(a) * least <= max(b) + 1e-6 and min(b) * least <= max(a) + 1e-6

    pairs = [(s, t) for s, a in enumerate(one.ranges) for t, b in enumerate(other.ranges) if may_meet(a, b)]
    of_left, of_right = ([[] for _ in range(n)] for n in (n_left, n_right))
    for s, t in pairs:
        of_left[s].append(t)
        of_right[t].append(s)
    return _met(one.dealt(True, "s", "t", of_left).union(other.dealt(False, "t", "s", of_right)), meet, schema)
