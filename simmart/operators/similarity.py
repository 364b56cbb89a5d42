"""All targets against all fingerprints: pair scores, top-k per target, tie flags.

The fingerprint table is scanned once. Every task scores its batches against a block of targets and, for top-k, hands
on at most k rows per target, so the pairs themselves are never shuffled. A running k-th best score bounds the number
of on-bits a better source can have (Swamidass and Baldi, 2007); sources outside that range are not scored.
"""

from __future__ import annotations

import functools
import itertools
import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from simmart.functions.bits import malformed
from simmart.functions.packing import pack, words_array
from simmart.operators.counting import Counters
from simmart.operators.meeting import block_count, meet_blocks
from simmart.operators.postings import join_postings
from simmart.schemas import N_BITS, PAIRS, TOP_K
from simmart.session import empty, scratch_path, stage

# Executors run the functions below without having this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of one broadcast: 256 bytes of fingerprint and an id each, about 6 MB, and k results each in every task.
MAX_BLOCK_TARGETS = 20_000
# Broadcasts that one pass over the fingerprints serves; a task holds their targets and results, about 300 MB for k = 10.
PASS_BLOCKS = 8
# Places in which the candidates of one target meet first.
MERGE_PARTS = 64
# Rows a task returns per Arrow batch.
OUT_ROWS = 20_000
# Rows of either side of a pair of blocks that meet by shuffle, where all scores are handed on.
PAIR_ROWS = 2_000
# Rows of a block of fingerprints for top-k, and those to which blocks of targets may grow where there are very many.
MOST_BLOCK_ROWS = 200_000
# Rows of the smallest blocks of targets for top-k.
LEAST_BLOCK_ROWS = 1_000
# Rows with about as many on-bits as a target that give its first lower bound.
SEED_ROWS = 1_024
# A score below any above 0.
LEAST = 1e-300

SOURCE, TARGET, SCORE = "source_chembl_id", "target_chembl_id", "tanimoto_similarity_score"
FLAG = "has_duplicates_of_last_largest_score"


def _form(df: DataFrame) -> str:
    """The stored form: packed words, positions or ``0``/``1`` text."""
    for name in ("words", "on", "morgan_fingerprint"):
        if name in df.columns:
            return name
    raise ValueError("fingerprints need one of the columns: words, on, morgan_fingerprint")


def _with_fingerprint(df: DataFrame, id_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("string").alias("id"), F.col(_form(df)).alias("fp"))


def split_fingerprints(df: DataFrame, id_col: str = "chembl_id", n_bits: int = N_BITS) -> tuple[DataFrame, DataFrame]:
    """Rows that can be scored, and the others with ``reject_reason``: ``null_id``, ``null_fingerprint``, ``malformed``.

    Scoring itself leaves rows without id or fingerprint out and stops at malformed ones.
    """
    form = _form(df)
    reason = (
        F.when(F.col(id_col).isNull(), F.lit("null_id"))
        .when(F.col(form).isNull(), F.lit("null_fingerprint"))
        .when(malformed(F.col(form), form, n_bits), F.lit("malformed"))
    )
    tagged = df.withColumn("reject_reason", reason)
    good = tagged.filter("reject_reason IS NULL").drop("reject_reason")
    return good, tagged.filter("reject_reason IS NOT NULL")


def _target_block(table: pa.Table, n_bits: int) -> dict:
    """Targets sorted by name; structures that share a name lie next to each other."""
    table = table.drop_null().sort_by("id").combine_chunks()
    names = table["id"].to_pylist()
    words = pack(table["fp"].combine_chunks(), n_bits)
    floors = table["floor"].to_numpy() if "floor" in table.column_names else np.zeros(len(names))
    starts = [i for i, name in enumerate(names) if i == 0 or name != names[i - 1]]
    return {
        "names": [names[i] for i in starts],
        "starts": np.array(starts),
        "ends": np.array(starts[1:] + [len(names)]),
        "floors": floors[starts],
        "words": words,
        "pops": np.bitwise_count(words).sum(axis=1, dtype=np.int64),
    }


class _Batch:
    """One Arrow batch of fingerprints, ordered by number of on-bits and then by id."""

    def __init__(self, batch: pa.RecordBatch, n_bits: int):
        ids = batch.column(0)
        by_id = pc.sort_indices(ids).to_numpy()
        rank = np.empty(len(by_id), np.int64)
        rank[by_id] = np.arange(len(by_id))
        words = pack(batch.column(1), n_bits)
        pops = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        order = np.lexsort((rank, pops))
        self.ids = ids.take(pa.array(order))
        self.rank = rank[order]
        codes = ids.dictionary_encode()
        self.code = codes.indices.to_numpy()[order] if len(codes.dictionary) < len(ids) else None  # None: no copies
        self.pops = pops[order]
        self.sizes = self.pops.astype(np.float32)
        self.words = np.ascontiguousarray(words[order].T)
        # What lies between the steps of a comparison, in one place for all targets.
        self.both, self.counts = np.empty(0, np.uint64), np.empty(0, np.uint8)
        self.wide = np.uint16 if len(self.words) < 1024 else np.uint32

    def windows(self, block: dict, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per target the range of rows whose number of on-bits allows a score of at least its floor."""
        floor = np.repeat(floors, block["ends"] - block["starts"])
        with np.errstate(divide="ignore", invalid="ignore"):
            fewest = np.where(floor > 0, np.ceil(floor * block["pops"] - 1e-6), 0)
            most = np.where(floor > 0, np.floor(block["pops"] / floor + 1e-6), np.inf)
        first = np.searchsorted(self.pops, fewest)
        end = np.searchsorted(self.pops, most, "right")
        return np.minimum.reduceat(first, block["starts"]), np.maximum.reduceat(end, block["starts"])

    def common(self, query: np.ndarray, low: int, high: int) -> np.ndarray:
        """Number of common on-bits of a fingerprint with rows low..high."""
        used = np.flatnonzero(query)
        rows = slice(low, high)
        if 4 * len(used) > 3 * len(query):
            used, words = slice(None), self.words[:, rows]  # a view is cheaper than leaving out a few words
        else:
            words = self.words[used, rows]
        # Three counts of up to 64 fit a byte, so a third of them is added up in wider numbers.
        thirds, width = -(-len(words) // 3), high - low
        if self.both.size < len(words) * width:
            self.both = np.empty(len(self.words) * width, np.uint64)
            self.counts = np.empty((len(self.words) + 2) * width, np.uint8)
        both = self.both[: len(words) * width].reshape(len(words), width)
        counts = self.counts[: 3 * thirds * width].reshape(-1, width)
        np.bitwise_and(words, query[used, None], out=both)
        np.bitwise_count(both, out=counts[: len(words)])
        counts[len(words) :] = 0
        return counts.reshape(thirds, 3, width).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=self.wide)

    def best(self, block: dict, t: int, low: int, high: int, floor: float, empty_score: float) -> tuple[np.ndarray, np.ndarray]:
        """Places from ``low`` of the rows low..high with a score of at least ``floor``, and these scores."""
        i = block["starts"][t]
        query, pop = block["words"][i], block["pops"][i]
        if floor <= 0 or not pop or block["ends"][t] - i > 1:
            scores = self.scores(block, t, low, high, empty_score)
            at = np.flatnonzero(scores >= floor)
            return at, scores[at]
        common = self.common(query, low, high)
        # A score of t needs t / (1 + t) of both numbers of on-bits; without a division, and rounded down.
        share = floor / (1 + floor)
        need = self.sizes[low:high] * np.float32(share)
        need += np.float32(share * float(pop) - 1e-6 * float(pop) - 0.01)
        at = np.flatnonzero(common >= need)
        found = common[at]
        scores = found / (self.pops[low + at] + pop - found)
        keep = scores >= floor
        return at[keep], scores[keep]

    def scores(self, block: dict, t: int, low: int, high: int, empty_score: float) -> np.ndarray:
        """Scores of target ``t`` with rows low..high; with several structures the best one counts."""
        pops, best = self.pops[low:high], None
        for i in range(block["starts"][t], block["ends"][t]):
            query, pop = block["words"][i], block["pops"][i]
            common = self.common(query, low, high)
            # With an empty target the union is empty exactly for empty rows.
            score = common / (pops + pop - common) if pop else np.where(pops == 0, empty_score, 0.0)
            best = score if best is None else np.maximum(best, score)
        return best

    def own_target(self, block: dict) -> np.ndarray:
        """Per row the number of the target with the same id, or -1."""
        found = pc.index_in(self.ids, value_set=pa.array(block["names"], self.ids.type))
        return pc.fill_null(found, -1).to_numpy(zero_copy_only=False)


def _packed(batches: Iterator[pa.RecordBatch], n_bits: int) -> Iterator[_Batch]:
    for raw in batches:
        known = raw.filter(pc.and_(pc.is_valid(raw.column(0)), pc.is_valid(raw.column(1))))
        if known.num_rows:
            yield _Batch(known, n_bits)


def _k_best(batch: _Batch, rows: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[float, str]]:
    """The k ids of these rows that come first by score descending and id ascending, as ``(-score, id)``."""

    def only(kept: np.ndarray) -> None:
        nonlocal rows, scores
        rows, scores = rows[kept], scores[kept]

    if batch.code is not None:
        # Of the copies of an id the best one counts.
        only(np.argsort(-scores, kind="stable"))
        only(np.unique(batch.code[rows], return_index=True)[1])
    if len(rows) > k:
        only(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        if len(rows) > k:
            only(np.lexsort((batch.rank[rows], -scores))[:k])
    return [(-float(score), batch.ids[int(row)].as_py()) for row, score in zip(rows, scores)]


def _merged(old: list[tuple[float, str]], new: list[tuple[float, str]], k: int) -> list[tuple[float, str]]:
    """The k first of both, each id once with its best score."""
    first: dict[str, float] = {}
    for score, name in sorted(old + new):
        first.setdefault(name, score)
    return [(score, name) for name, score in list(first.items())[:k]]


def _out(sources: list, scores: list, targets: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(sources, pa.string()), pa.array(scores, pa.float64()), pa.array(targets, pa.string())],
        names=["chembl_id", "tanimoto_similarity_score", "target_chembl_id"],
    )


def _task_top_k(shared, n_bits: int, k: int, empty_score: float, include_self: bool):
    def add(batch: _Batch, block: dict, best: list, floors: np.ndarray) -> None:
        own = None if include_self else batch.own_target(block)
        lows, highs = batch.windows(block, floors)
        for t in np.flatnonzero(lows < highs):
            low = lows[t]
            at, scores = batch.best(block, t, low, highs[t], floors[t], empty_score)
            rows = low + at
            if own is not None:
                other = own[rows] != t
                rows, scores = rows[other], scores[other]
            new = _k_best(batch, rows, scores, k)
            if new:
                best[t] = _merged(best[t], new, k)
                if len(best[t]) == k:
                    floors[t] = max(floors[t], -best[t][-1][0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [b.value for b in shared]
        kept: list[list[list[tuple[float, str]]]] = [[[] for _ in block["names"]] for block in blocks]
        floors = [block["floors"].copy() for block in blocks]
        for batch in _packed(batches, n_bits):
            for block, best, floor in zip(blocks, kept, floors):
                add(batch, block, best, floor)
        for block, best in zip(blocks, kept):
            for first in range(0, len(best), OUT_ROWS // k + 1):
                names = block["names"][first : first + OUT_ROWS // k + 1]
                rows = [(s, -neg, n) for n, found in zip(names, best[first:]) for neg, s in found]
                if rows:
                    yield _out(*map(list, zip(*rows)))

    return run


def _k_first(batch: _Batch, of: np.ndarray, rows: np.ndarray, scores: np.ndarray, k: int, several: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which of these pairs are the k first of their target by score descending and id ascending, and their places.

    Of copies of an id, or of a target with ``several`` structures, the best pair counts.
    """
    kept = np.arange(len(of))
    if several or batch.code is not None:
        code = rows if batch.code is None else batch.code[rows]
        kept = np.lexsort((-scores, code, of))
        new = np.ones(len(kept), bool)
        new[1:] = (of[kept[1:]] != of[kept[:-1]]) | (code[kept[1:]] != code[kept[:-1]])
        kept = kept[new]
    kept = kept[np.lexsort((batch.rank[rows[kept]], -scores[kept], of[kept]))]
    starts = np.flatnonzero(np.diff(of[kept], prepend=-1))
    place = np.arange(len(kept)) - np.repeat(starts, np.diff(starts, append=len(kept)))
    return kept[place < k], place[place < k]


def _top_k_of_blocks(n_bits: int, k: int, empty_score: float, include_self: bool):
    """The k best rows of a large block for each target of another, by counters instead of pair by pair."""

    def seeds(batch: _Batch, block: dict, own: np.ndarray | None) -> np.ndarray:
        """Lower bounds of the k-th scores, from rows with about as many on-bits."""
        floors = block["floors"].copy()
        near = np.searchsorted(batch.pops, block["pops"][block["starts"]])
        for t in range(len(floors)):
            low = max(0, min(near[t] - SEED_ROWS // 2, len(batch.pops) - SEED_ROWS))
            scores = batch.scores(block, t, low, min(low + SEED_ROWS, len(batch.pops)), empty_score)
            if own is not None:
                scores[own[low : low + SEED_ROWS] == t] = -1.0
            if batch.code is not None:
                best_first = np.argsort(-scores)
                scores = scores[best_first][np.unique(batch.code[low : low + SEED_ROWS][best_first], return_index=True)[1]]
            if len(scores) >= k:
                floors[t] = max(floors[t], np.partition(scores, len(scores) - k)[len(scores) - k])
        return floors

    def run(batch: _Batch, block: dict) -> Iterator[pa.RecordBatch]:
        own = None if include_self else batch.own_target(block)
        pops, words, starts = block["pops"], block["words"], block["starts"]
        name_of = np.repeat(np.arange(len(starts)), block["ends"] - starts)
        several = len(name_of) > len(starts)
        floors = seeds(batch, block, own)
        plain = np.minimum.reduceat(pops, starts) > 0  # the others are scored row by row
        counted = np.flatnonzero(plain[name_of])
        bounds = np.maximum(floors[name_of], LEAST)[counted]
        best = np.full((len(starts), k), -1)  # rows, in their order
        reached = np.zeros((len(starts), k))
        counters = Counters(np.ascontiguousarray(batch.words.T), batch.pops, batch.common)
        for q, rows, common in counters.search(words[counted], pops[counted], bounds):
            scores, of = common / (batch.pops[rows] + pops[counted[q]] - common), name_of[counted[q]]
            if own is not None:
                other = own[rows] != of
                of, rows, scores = of[other], rows[other], scores[other]
            met = np.unique(of)
            old = best[met] >= 0
            of = np.concatenate([np.repeat(met, old.sum(axis=1)), of])
            rows, scores = np.concatenate([best[met][old], rows]), np.concatenate([reached[met][old], scores])
            stay, place = _k_first(batch, of, rows, scores, k, several)
            best[of[stay], place], reached[of[stay], place] = rows[stay], scores[stay]
            again = np.unique(q)
            name = name_of[counted[again]]
            bounds[again] = np.where(best[name, -1] >= 0, np.maximum(bounds[again], reached[name, -1]), bounds[again])
        # Where fewer than k sources have a bit in common, the others come by their ids.
        for t in np.flatnonzero(~plain | ((floors <= 0) & (best[:, -1] < 0))):
            scores = batch.scores(block, t, 0, len(batch.pops), empty_score)
            rows = np.flatnonzero(scores >= floors[t]) if own is None else np.flatnonzero((scores >= floors[t]) & (own != t))
            if batch.code is None and len(rows) > k:
                rows = rows[scores[rows] >= np.partition(scores[rows], len(rows) - k)[len(rows) - k]]
            stay, place = _k_first(batch, np.full(len(rows), t), rows, scores[rows], k, False)
            best[t] = -1
            best[t, place], reached[t, place] = rows[stay], scores[rows[stay]]
        names = pa.array(block["names"], pa.string())
        for begin in range(0, len(starts), OUT_ROWS // k + 1):
            of, place = np.nonzero(best[begin : begin + OUT_ROWS // k + 1] >= 0)
            of += begin
            if len(of):
                yield pa.RecordBatch.from_arrays(
                    [batch.ids.take(pa.array(best[of, place])), pa.array(reached[of, place]), names.take(pa.array(of))],
                    names=["chembl_id", "tanimoto_similarity_score", "target_chembl_id"],
                )

    def meet(sources: pa.Table, targets: pa.Table) -> Iterator[pa.RecordBatch]:
        batch = _Batch(sources.select(["id", "fp"]).combine_chunks().to_batches()[0], n_bits)
        yield from run(batch, _target_block(targets.select(["id", "fp", "floor"]), n_bits))

    return meet


def _task_all_pairs(shared, n_bits: int, empty_score: float, include_self: bool, keep_zero: bool, min_score: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [b.value for b in shared]
        for batch, block in ((batch, block) for batch in _packed(batches, n_bits) for block in blocks):
            own = None if include_self else batch.own_target(block)
            lows, highs = batch.windows(block, np.full(len(block["names"]), min_score))
            for t in np.flatnonzero(lows < highs):
                name, low, high = block["names"][t], lows[t], highs[t]
                scores = batch.scores(block, t, low, high, empty_score)
                keep = scores >= min_score if keep_zero else (scores >= min_score) & (scores > 0)
                if own is not None:
                    keep &= own[low:high] != t
                at = np.flatnonzero(keep)
                ids = batch.ids.take(pa.array(low + at))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(scores[at]), pa.array([name], pa.string()).take(pa.array(np.zeros(len(at), int)))],
                    names=["chembl_id", "tanimoto_similarity_score", "target_chembl_id"],
                )

    return run


def _distinct_targets(targets: DataFrame) -> DataFrame:
    """``(id, fp, floor)``. Exact copies of a target change nothing. Several structures under one name all count."""
    floor = F.col("floor") if "floor" in targets.columns else F.lit(0.0)
    named = targets.select(F.col(TARGET).cast("string").alias("id"), F.col(_form(targets)).alias("fp"), floor.alias("floor"))
    return named.distinct()


class _Blocks:
    """Targets in parts of about ``max_block`` rows, small enough to broadcast.

    A name lies in one part, unless more than a quarter of a part's rows share it: then names are ``split``.
    """

    def __init__(self, targets: DataFrame, max_block: int):
        distinct = _distinct_targets(targets)
        self.split, self.parts = False, 1
        self.head = distinct.limit(max_block + 1).toArrow()
        if self.head.num_rows <= max_block:
            return
        stored = stage(distinct, "targets")
        self.split = not stored.groupBy("id").count().filter(F.col("count") > max(1, max_block // 4)).isEmpty()
        self.parts = -(-stored.count() // max_block)
        path = scratch_path(targets.sparkSession, "blocks")
        part = F.pmod(F.xxhash64("id", "fp") if self.split else F.xxhash64("id"), F.lit(self.parts))
        stored.withColumn("part", part).repartition("part").write.partitionBy("part").parquet(path)
        # A folder for each part: a block reads its own rows only.
        self.cut = targets.sparkSession.read.schema(stored.schema.add("part", "long")).parquet(path)

    def tables(self) -> Iterator[pa.Table]:
        if self.parts == 1:
            yield self.head
            return
        for number in range(self.parts):
            yield self.cut.filter(F.col("part") == number).drop("part").toArrow()


def _scan(blocks: _Blocks, parts_of_fps: list[DataFrame], n_bits: int, task, min_score: float = 0.0) -> list[list[DataFrame]]:
    """One pass over the fingerprints for every ``PASS_BLOCKS`` blocks of targets, for each of the given parts of them."""
    context = parts_of_fps[0].sparkSession.sparkContext
    ready = (block for table in blocks.tables() if (block := _target_block(table, n_bits))["names"])
    done: list[list[DataFrame]] = [[] for _ in parts_of_fps]
    while own := list(itertools.islice(ready, PASS_BLOCKS)):
        shared = [context.broadcast(block) for block in own]
        for frames, fps in zip(done, parts_of_fps):
            sources = fps
            if min_score > 0 and "pop" in fps.columns:
                # Sources with too few or too many on-bits for any of these targets are left in the files.
                fewest, most = (f(f(block["pops"]) for block in own) for f in (min, max))
                sources = fps.filter(F.col("pop").between(int(fewest * min_score), math.ceil(most / min_score)))
            frames.append(_with_fingerprint(sources, "chembl_id").mapInArrow(task(shared), PAIRS))
    return done


class _Held:
    """A block that is already where it is needed, in place of a broadcast."""

    def __init__(self, value: dict):
        self.value = value


def _as_words(df: DataFrame, n_bits: int) -> DataFrame:
    """``(id, fp, ...)`` with any stored form as packed words: fewer bytes to shuffle, and equal sets are equal."""
    others = [c for c in df.columns if c not in ("id", "fp")]

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(0), words_array(batch.column(1), n_bits), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "fp", *others])

    types = "".join(f", {c} {df.schema[c].dataType.simpleString()}" for c in others)
    return df.select("id", "fp", *others).dropna().mapInArrow(convert, f"id string, fp array<bigint>{types}").distinct()


def _pair_blocks(wanted: DataFrame, sources: DataFrame, rows: int, n_bits: int, task) -> DataFrame:
    """Blocks of targets and blocks of fingerprints, about ``rows`` each, meet by shuffle: no target passes the driver.

    Both sides are ``(id, fp)`` with packed words. Every row travels once for each block of the other side.
    """
    n_left, n_right = (block_count(df.count(), rows, rows) for df in (sources, wanted))

    def meet(own: pa.Table, block: pa.Table) -> Iterator[pa.RecordBatch]:
        held = _Held(_target_block(block.select(["id", "fp", "floor"]), n_bits))
        yield from task([held])(iter(own.select(["id", "fp"]).to_batches(max_chunksize=10_000)))

    return meet_blocks(sources.withColumn("floor", F.lit(0.0)), n_left, wanted, n_right, meet, PAIRS)


def _both_sides(targets: DataFrame, fps: DataFrame, n_bits: int) -> tuple[DataFrame, DataFrame]:
    """Targets and fingerprints for ``_pair_blocks``, stored."""
    wanted = stage(_as_words(_distinct_targets(targets), n_bits), "targets")
    return wanted, stage(_as_words(_with_fingerprint(fps, "chembl_id"), n_bits), "sources")


def _all_pairs_by_blocks(targets: DataFrame, fps: DataFrame, rows: int, n_bits: int, task) -> DataFrame:
    """All scores by blocks. Pairs are merged, by a shuffle, only for ids that occur more than once on their side."""
    wanted, sources = _both_sides(targets, fps, n_bits)

    def parts(side: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        again = repeated_ids(side, "id")
        return (side, None) if again is None else tuple(side.join(again, "id", how) for how in ("left_anti", "left_semi"))

    def meet(a: DataFrame, b: DataFrame) -> DataFrame:
        return _pair_blocks(a, b, rows, n_bits, task)

    (one_target, copied_targets), (one_source, copied_sources) = parts(wanted), parts(sources)
    merged = [] if copied_targets is None else [meet(copied_targets, one_source)]
    merged += [] if copied_sources is None else [meet(wanted, copied_sources)]
    merged = [_best_per_pair(_union(fps.sparkSession, merged))] if merged else []
    return _union(fps.sparkSession, [meet(one_target, one_source), *merged])


def _top_by_blocks(targets: DataFrame, fps: DataFrame, max_block: int, n_bits: int, meet) -> DataFrame:
    """The k best of every pair of blocks: large ones of fingerprints, and enough of targets for all cores.

    Pairs are merged, by a shuffle, only where a side has an id more than once.
    """
    wanted, sources = _both_sides(targets, fps, n_bits)
    few, rows = max_block < MAX_BLOCK_TARGETS, sources.count()
    n_left = block_count(rows, max_block, max_block) if few else max(1, -(-rows // MOST_BLOCK_ROWS))
    least, most = (max_block, max_block) if few else (LEAST_BLOCK_ROWS, MOST_BLOCK_ROWS)
    n_right = block_count(wanted.count(), least, most)
    pairs = meet_blocks(sources.withColumn("floor", F.lit(0.0)), n_left, wanted, n_right, meet, PAIRS)
    if n_left * n_right == 1 or all(repeated_ids(side, "id") is None for side in (wanted, sources)):
        return pairs
    return _best_per_pair(pairs)


def _union(spark: SparkSession, frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames) if frames else empty(spark, PAIRS)


def _best_per_pair(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("chembl_id", TARGET).agg(F.max(SCORE).alias(SCORE)).select(*PAIRS.names)


def repeated_ids(df: DataFrame, id_col: str) -> DataFrame | None:
    """Ids of more than one row, or nothing when there are none. Only ids are shuffled, and counted before that."""
    counts = df.select(F.col(id_col).cast("string").alias("id")).dropna().groupBy("id").count()
    found = stage(counts.filter("count > 1").select("id"), "repeated_ids")
    return None if found.isEmpty() else found


def score_targets(
    targets: DataFrame,
    fps: DataFrame,
    empty_score: float = 0.0,
    include_self: bool = True,
    keep_zero: bool = True,
    n_bits: int = N_BITS,
    max_block: int = MAX_BLOCK_TARGETS,
    min_score: float = 0.0,
    strategy: str = "scan",
) -> DataFrame:
    """Every score of at least ``min_score`` as ``(chembl_id, tanimoto_similarity_score, target_chembl_id)``.

    The result has targets x fingerprints rows by definition; use it to keep all scores (``write_pairs``). For the best
    k use ``score_top_k``, which never builds these rows. Copies of an id are one source with its best score. Three
    strategies give the same rows:

    * ``scan``: blocks of targets are broadcast, pairs stream from the scan of ``fps``. Pairs are shuffled only for
      ids that ``fps`` holds more than once. With ``min_score`` the number of on-bits rules out most rows before they
      are compared, and a ``pop`` column of ``fps``, as ``write_fingerprints`` stores it with words, is filtered in the
      files.
    * ``blocks``: blocks of targets and of fingerprints meet by shuffle, for as many targets as fingerprints.
    * ``postings``: both sides are indexed by their rarest on-bits and joined on these; needs a ``min_score`` above 0.
      For high ones it compares few pairs (``simmart.operators.postings``).
    """
    named = targets.select(TARGET, _form(targets))
    if strategy == "postings":
        return join_postings(named, fps, min_score, empty_score, include_self, n_bits)
    task = lambda shared: _task_all_pairs(shared, n_bits, empty_score, include_self, keep_zero, min_score)
    if strategy == "blocks":
        return _all_pairs_by_blocks(named, fps, min(max_block, PAIR_ROWS), n_bits, task)
    if strategy != "scan":
        raise ValueError("strategy is 'scan', 'blocks' or 'postings'")
    blocks = _Blocks(named, max_block)
    again = None if blocks.split else repeated_ids(fps, "chembl_id")
    if blocks.split:
        (frames,) = _scan(blocks, [fps], n_bits, task, min_score)
        return _best_per_pair(_union(fps.sparkSession, frames))
    if again is None:
        (frames,) = _scan(blocks, [fps], n_bits, task, min_score)
        return _union(fps.sparkSession, frames)
    same = F.col("chembl_id").cast("string") == F.col("id")
    once, copies = (fps.join(again, same, how).select(*fps.columns) for how in ("left_anti", "left_semi"))
    plain, merged = _scan(blocks, [once, copies], n_bits, task, min_score)
    return _union(fps.sparkSession, [*plain, _best_per_pair(_union(fps.sparkSession, merged))])


def score_top_k(
    targets: DataFrame,
    fps: DataFrame,
    k: int = TOP_K,
    tie_mode: str = "within",
    empty_score: float = 0.0,
    include_self: bool = True,
    n_bits: int = N_BITS,
    max_block: int = MAX_BLOCK_TARGETS,
    seed: DataFrame | None = None,
    strategy: str = "scan",
) -> DataFrame:
    """The k best sources per target with the tie flag; the same rows as ``top_k_similar(score_targets(...))``.

    ``targets`` has ``target_chembl_id`` and a fingerprint, ``fps`` has ``chembl_id`` and a fingerprint. Copies of an id
    are one source with its best score, whatever the number of targets.

    ``seed`` is any part of ``fps``, such as one of its files. Its k-th scores are lower bounds of the final ones, so
    the tasks of the whole scan start from them and hand on few rows, not k for each target. The result is the same.
    ``strategy="blocks"`` lets blocks of targets and of fingerprints meet by shuffle instead of broadcasts: for as many
    targets as fingerprints, none of which pass the driver.
    """
    if strategy not in ("scan", "blocks"):
        raise ValueError("strategy is 'scan' or 'blocks'")
    keep = k + 1 if tie_mode == "boundary" else k

    def candidates(targets: DataFrame, fps: DataFrame) -> DataFrame:
        task = lambda shared: _task_top_k(shared, n_bits, keep, empty_score, include_self)
        if strategy == "blocks":
            return _top_by_blocks(targets, fps, max_block, n_bits, _top_k_of_blocks(n_bits, keep, empty_score, include_self))
        (frames,) = _scan(_Blocks(targets, max_block), [fps], n_bits, task)
        # One pass at a time; a few rows per target remain of each.
        stored = [stage(frame, "pass") for frame in frames] if len(frames) > 1 else frames
        return _best_per_pair(_union(fps.sparkSession, stored))

    if seed is not None:
        last = _first_k(candidates(targets, seed), keep).filter(F.col("place") == keep)
        floors = last.select(F.col(TARGET).alias("_seeded"), F.col(SCORE).alias("floor"))
        known = targets.select(F.col(TARGET).cast("string").alias(TARGET), _form(targets))
        targets = known.join(floors, F.col(TARGET) == F.col("_seeded"), "left").withColumn("floor", F.coalesce("floor", F.lit(0.0)))
    else:
        targets = targets.select(TARGET, _form(targets))
    return _rank(candidates(targets, fps), k, tie_mode)


def _first_k(pairs: DataFrame, k: int) -> DataFrame:
    """Number the first k rows per target, in two steps: each scan task hands on k rows of a target, so they meet in
    ``MERGE_PARTS`` places before they meet in one. Spark cuts to k before and after each shuffle.
    """
    best_first = [F.desc(SCORE), F.asc("chembl_id")]
    part = Window.partitionBy(TARGET, F.pmod(F.xxhash64("chembl_id"), F.lit(MERGE_PARTS))).orderBy(*best_first)
    pairs = pairs.withColumn("place", F.row_number().over(part)).filter(F.col("place") <= k).drop("place")
    whole = Window.partitionBy(TARGET).orderBy(*best_first)
    return pairs.withColumn("place", F.row_number().over(whole)).filter(F.col("place") <= k)


def _rank(pairs: DataFrame, k: int, tie_mode: str) -> DataFrame:
    if tie_mode == "within":
        top = _first_k(pairs, k)
        flag = F.count(F.lit(1)).over(Window.partitionBy(TARGET, SCORE)) > 1
    elif tie_mode == "boundary":
        # One more row is enough to know whether the k-th score goes on behind the cut.
        top = _first_k(pairs, k + 1)
        per_target = Window.partitionBy(TARGET)
        kth = F.max(F.when(F.col("place") == k, F.col(SCORE))).over(per_target)
        beyond = F.max(F.when(F.col("place") == k + 1, F.col(SCORE))).over(per_target)
        flag = F.coalesce((F.col(SCORE) == kth) & (kth == beyond), F.lit(False))
    else:
        raise ValueError("tie_mode is 'within' or 'boundary'")
    flagged = top.withColumn(FLAG, flag).filter(F.col("place") <= k)
    return flagged.select(F.col("chembl_id").alias(SOURCE), TARGET, SCORE, FLAG)


def _first_of_batches(pairs: DataFrame, k: int) -> DataFrame:
    """The pairs without those that k others of their target and batch come before: tasks sort few rows.

    Stored pairs lie target by target, so a batch of 10,000 keeps about k. NULLs and NaN are left to Spark's order.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = pc.and_(pc.is_valid(batch.column(0)), pc.is_finite(pc.fill_null(batch.column(1), np.nan)))
            plain = plain.to_numpy(zero_copy_only=False)
            code = batch.column(2).dictionary_encode().indices.to_numpy()
            scores = pc.fill_null(batch.column(1), 0.0).to_numpy(zero_copy_only=False)
            order = np.lexsort((-scores, code, ~plain))[: plain.sum()]
            starts = np.flatnonzero(np.diff(code[order], prepend=-1))
            sizes = np.diff(starts, append=len(order))
            place = np.arange(len(order)) - np.repeat(starts, sizes)
            # Ties with the k-th score are told apart by their ids.
            last = scores[order[np.minimum(starts + k, starts + sizes) - 1]] if len(order) else scores[:0]
            stay = order[(place < k) | (scores[order] == np.repeat(last, sizes))]
            if len(stay) > k * len(starts):
                rank = np.empty(len(stay), np.int64)
                rank[pc.sort_indices(batch.column(0).take(pa.array(stay))).to_numpy()] = np.arange(len(stay))
                stay = stay[np.lexsort((rank, -scores[stay], code[stay]))]
                starts = np.flatnonzero(np.diff(code[stay], prepend=-1))
                stay = stay[np.arange(len(stay)) - np.repeat(starts, np.diff(starts, append=len(stay))) < k]
            yield batch.take(pa.array(np.concatenate([stay, np.flatnonzero(~plain)])))

    return pairs.mapInArrow(cut, pairs.schema)


def top_k_similar(pairs: DataFrame, k: int = TOP_K, tie_mode: str = "within") -> DataFrame:
    """The k best rows per target of an existing pair table, flagged and without repeated rows.

    Rows without a target are dropped. Ties go to the smaller source id; the flag compares unrounded scores.
    """
    pairs = pairs.filter(F.col(TARGET).isNotNull()).select("chembl_id", SCORE, TARGET)
    if [f.dataType.simpleString() for f in pairs.schema] == ["string", "double", "string"]:
        pairs = _first_of_batches(pairs, k + 1)
    return _rank(pairs, k, tie_mode).distinct()
