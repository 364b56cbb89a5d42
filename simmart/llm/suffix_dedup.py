"""Removal of long byte strings that stand earlier in the corpus (operator 5).

A byte goes when a string of ``length`` bytes that covers it also starts earlier. That is a question to the longest
previous factor array: string i occurs earlier when LPF[i] >= length, and LPF[i] is reached at the previous or the next
smaller position in suffix order. Suffix arrays are built for parts of the corpus that can contain all matches:

1. Every string has an anchor, the smallest hash among its k-mers, so equal strings have equal anchors. Chunks learn
   from shards which anchors occur again; strings without such an anchor are unique.
2. Neighbouring strings with one anchor form a context. A chunk sends each distinct context once to the shard of its
   anchor. The shard orders the suffixes of its contexts, finds the smaller positions beside each, and answers one bit
   for every string. Anchors that are very frequent are sent string by string to shards of the strings' own hashes, so
   no shard gathers the surroundings of a common passage.
3. Chunks mark the strings, join them to runs and cut them out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simmart.llm.blocks import (
    frame,
    in_chunks,
    joined,
    mix,
    pack_bytes,
    pack_sorted,
    pieces,
    rolling,
    shard_ranges,
    short_hashes,
    texts_of,
    unpack_bytes,
    unpack_sorted,
    with_id,
)

LENGTH = 100
# Bytes of an anchor.
ANCHOR = 32
# Bytes of text for one anchor, to choose the number of bits of a filter hash.
ANCHOR_BYTES = 30
# Binary logarithm of the occurrences from which an anchor is sent string by string.
FREQUENT = 12
# Bytes of contexts whose suffixes are ordered at once; the contexts of one anchor stay together.
SORT_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_BLOBS = pa.schema(
    [("shard", pa.int32()), ("chunk", pa.int32()), ("n", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())]
)
_REPLIES = pa.schema([("chunk", pa.int32()), ("shard", pa.int32()), ("common", pa.binary())])
_CONTEXTS = pa.schema(
    [
        ("shard", pa.int32()),
        ("chunk", pa.int32()),
        ("n", pa.int32()),
        ("keys", pa.binary()),
        ("sizes", pa.binary()),
        ("size", pa.int64()),
        ("bytes", pa.binary()),
    ]
)
_MARKS = pa.schema([("chunk", pa.int32()), ("shard", pa.int32()), ("earlier", pa.binary())])


# ---------------------------------------------------------------- anchors


def anchors(texts: list[bytes], length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring strings of ``length`` bytes with one anchor: first start (counted over all texts, one byte
    between two), number of strings, hash of the anchor. Of equal smallest hashes the first is the anchor."""
    starts, counts, hashes, at = [], [], [], 0
    for first, last in pieces(texts):
        raw = np.frombuffer(b"\n".join(texts[first:last]) + b"\n", np.uint8)
        sizes = np.fromiter(map(len, texts[first:last]), np.int64, last - first)
        if len(raw) > length:
            every = np.arange(len(raw) - k + 1)
            gram = rolling(raw.astype(np.uint64) + np.uint64(1), every, every + k, _BASE)
            # The place fills the low bits, so the smallest number is the first of the smallest hashes.
            low = np.uint64(len(raw).bit_length())
            key = (gram >> low << low) | every.astype(np.uint64)
            width, span = length - k + 1, 1
            while 2 * span <= width:
                key = np.minimum(key[:-span], key[span:])
                span *= 2
            if span < width:
                key = np.minimum(key[: len(key) - (width - span)], key[width - span :])
            # Strings that end inside their text.
            room = np.repeat(np.cumsum(sizes + 1) - 1, sizes + 1)
            own = np.flatnonzero(every[: len(key)] + length <= room[: len(key)])
            place = (key[own] & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
            begin = np.flatnonzero(np.diff(place, prepend=-1))
            starts.append(own[begin] + at)
            counts.append(np.diff(np.append(begin, len(own))))
            # Smallest hashes are small numbers; mixed again they spread over the shards.
            hashes.append(mix(~gram[place[begin]]))
        at += len(raw)
    none = np.zeros(0, np.int64)
    return (
        np.concatenate([none, *starts]),
        np.concatenate([none, *counts]),
        np.concatenate([none.view(np.uint64), *hashes]),
    )


def _distinct(hashes: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct anchors of a chunk (cut hashes) and how often each occurs."""
    return np.unique(short_hashes(hashes, total, ANCHOR_BYTES), return_counts=True)


def _send_anchors(length: int, k: int, total: int, shard_bits: int):
    def run(table: pa.Table) -> pa.Table:
        _, ids, texts = texts_of(table)
        values, counts = _distinct(anchors(texts[: with_id(ids)], length, k)[2], total)
        ranges = shard_ranges(values, shard_bits)
        return frame(
            _BLOBS,
            shard=[s for s, _, _ in ranges],
            chunk=[table["chunk"][0].as_py()] * len(ranges),
            n=[b - a for _, a, b in ranges],
            hashes=[pack_sorted(values[a:b]) for _, a, b in ranges],
            counts=[pack_bytes(counts[a:b].astype(np.uint32)) for _, a, b in ranges],
        )

    return run


def _answer_anchors(table: pa.Table) -> pa.Table:
    """For every anchor the binary logarithm of its occurrences (0: only one)."""
    sizes = table["n"].to_pylist()
    values = np.concatenate([unpack_sorted(b, n) for b, n in zip(table["hashes"].to_pylist(), sizes)])
    counts = np.concatenate([unpack_bytes(b, n, np.uint32) for b, n in zip(table["counts"].to_pylist(), sizes)])
    order = np.argsort(values, kind="stable")
    begin = np.flatnonzero(np.concatenate([[True], values[order][1:] != values[order][:-1]]))
    sums = np.add.reduceat(counts[order].astype(np.int64), begin)
    common = np.empty(len(values), np.uint8)
    common[order] = np.repeat(np.log2(sums).astype(np.uint8), np.diff([*begin, len(values)]))
    cuts = np.cumsum([0, *sizes])
    return frame(
        _REPLIES,
        chunk=table["chunk"].to_pylist(),
        shard=table["shard"].to_pylist(),
        common=[pack_bytes(common[a:b]) for a, b in zip(cuts, cuts[1:])],
    )


# ---------------------------------------------------------------- contexts


class Contexts:
    """The distinct contexts of a chunk in the order of their first places, and the strings each stands for."""

    def __init__(self, texts: list[bytes], replies: pa.Table, length: int, k: int, total: int, shard_bits: int):
        starts, counts, hashes = anchors(texts, length, k)
        values, _ = _distinct(hashes, total)
        common = joined(replies, "common", len(values), shard_ranges(values, shard_bits))
        rank = common[np.searchsorted(values, short_hashes(hashes, total, ANCHOR_BYTES))]
        starts, counts, hashes, rank = (x[rank > 0] for x in (starts, counts, hashes, rank))
        # Strings of frequent anchors stand alone.
        parts = np.where(rank >= FREQUENT, counts, 1)
        inner = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        self.starts = np.repeat(starts, parts) + inner
        self.strings = np.repeat(np.where(rank >= FREQUENT, 1, counts), parts)
        self.keys = np.repeat(hashes, parts)
        self.length, self.text = length, b"\n".join(texts)
        alone = np.flatnonzero(np.repeat(rank >= FREQUENT, parts))
        raw = np.frombuffer(self.text, np.uint8)
        for a in range(0, len(alone), 10_000):
            own = alone[a : a + 10_000]
            window = raw[self.starts[own][:, None] + np.arange(length)].astype(np.uint64) + np.uint64(1)
            edge = np.arange(len(own)) * length
            self.keys[own] = rolling(window.ravel(), edge, edge + length, _BASE)
        seen: dict[bytes, int] = {}
        kept = []
        for i, (a, n) in enumerate(zip(self.starts.tolist(), self.strings.tolist())):
            if seen.setdefault(self.text[a : a + n - 1 + length], i) == i:
                kept.append(i)
        self.kept = np.array(kept, np.int64)
        shard = (self.keys[self.kept] >> np.uint64(64 - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(kept), np.int64)
        self.order = np.argsort(shard, kind="stable")
        cut = np.flatnonzero(np.diff(shard[self.order])) + 1
        edges = [0, *cut.tolist(), len(kept)] if kept else []
        self.ranges = [(int(shard[self.order[a]]), a, b) for a, b in zip(edges, edges[1:])]

    def bytes_of(self, i: int) -> bytes:
        return self.text[self.starts[i] : self.starts[i] + self.strings[i] - 1 + self.length]


def _send_contexts(length: int, k: int, total: int, shard_bits: int):
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _CONTEXTS.empty_table()
        _, ids, texts = texts_of(table)
        found = Contexts(texts[: with_id(ids)], replies, length, k, total, shard_bits)
        rows = []
        for shard, a, b in found.ranges:
            own = found.kept[found.order[a:b]]
            text = b"".join(map(found.bytes_of, own.tolist()))
            rows.append(
                {
                    "shard": shard,
                    "chunk": table["chunk"][0].as_py(),
                    "n": b - a,
                    "keys": pack_bytes(found.keys[own]),
                    "sizes": pack_bytes(found.strings[own] + (length - 1)),
                    "size": len(text),
                    "bytes": pa.compress(text, codec="zstd", asbytes=True),
                }
            )
        return pa.Table.from_pylist(rows, schema=_CONTEXTS)

    return run


def suffix_ranks(text: np.ndarray, depth: int) -> np.ndarray:
    """Order of all suffixes by their first ``depth`` bytes (at least 8): equal numbers mean equal bytes.

    Prefix doubling from 8 bytes; a depth that is no power of two is reached by two overlapping halves. Bytes beyond
    the end count as 0.
    """
    padded = np.concatenate([text, np.zeros(depth + 8, np.uint8)]).astype(np.uint64)
    key = np.zeros(len(padded) - 7, np.uint64)
    for i in range(8):
        key = key << np.uint64(8) | padded[i : len(key) + i]
    rank, size = np.unique(key, return_inverse=True)[1].astype(np.uint64), 8
    while size < depth:
        step = min(size, depth - size)
        pair = rank[: len(rank) - step] * np.uint64(len(padded)) + rank[step:]
        rank, size = np.unique(pair, return_inverse=True)[1].astype(np.uint64), size + step
    return rank[: len(text)]


def smaller_neighbours(position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For positions in suffix order the places of the previous and the next smaller position (-1, n: none)."""
    n = len(position)

    def previous(values: np.ndarray) -> np.ndarray:
        at = np.arange(n) - 1
        while True:
            wrong = np.flatnonzero((at >= 0) & (values[at] > values))
            if not len(wrong):
                return at
            at[wrong] = at[at[wrong]]

    return previous(position), n - 1 - previous(position[::-1])[::-1]


def occurs_before(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Whether LPF >= length at each start: the string there also begins at a smaller start. ``starts`` ascend."""
    rank = suffix_ranks(text, length)[starts]
    order = np.argsort(rank, kind="stable")
    position, sorted_rank = starts[order], rank[order]
    before, after = smaller_neighbours(position)
    edge = np.append(sorted_rank.astype(np.int64), [-1, -2])  # ranks that no string has
    # The common prefix with a neighbour is at least ``length`` when both have the same rank.
    found = (edge[np.where(before < 0, len(order), before)] == edge[: len(order)]) | (
        edge[np.where(after >= len(order), len(order) + 1, after)] == edge[: len(order)]
    )
    out = np.empty(len(starts), bool)
    out[order] = found
    return out


def _answer_contexts(length: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        n = table["n"].to_pylist()
        keys = np.concatenate([unpack_bytes(b, m, np.uint64) for b, m in zip(table["keys"].to_pylist(), n)])
        sizes = np.concatenate([unpack_bytes(b, m, np.int64) for b, m in zip(table["sizes"].to_pylist(), n)])
        raw = [pa.decompress(b, s, codec="zstd", asbytes=True) for b, s in zip(table["bytes"].to_pylist(), table["size"].to_pylist())]
        text = b"".join(raw)
        begin = np.cumsum(sizes) - sizes
        strings = sizes - length + 1
        marks = np.zeros(int(strings.sum()), bool)
        mark_at = np.cumsum(strings) - strings
        # Equal contexts of several chunks: all strings of the later ones occur earlier.
        seen, same = {}, np.empty(len(sizes), np.int64)
        for i, (a, s) in enumerate(zip(begin.tolist(), sizes.tolist())):
            same[i] = seen.setdefault(text[a : a + s], i)
        first = same == np.arange(len(sizes))
        marks[np.repeat(~first, strings)] = True
        # Suffix order for anchors with more than one distinct context, some anchors at a time.
        own = np.flatnonzero(first)
        _, back, count = np.unique(keys[own], return_inverse=True, return_counts=True)
        several = np.flatnonzero(count[back] > 1)
        several = several[np.argsort(back[several], kind="stable")]
        own, anchor = own[several], back[several]
        last = np.flatnonzero(np.append(anchor[1:] != anchor[:-1], True)) + 1 if len(own) else []
        begun, held = 0, np.cumsum(sizes[own])
        for end in last:
            if end < len(own) and held[end - 1] - (held[begun - 1] if begun else 0) < SORT_BYTES:
                continue
            some, begun = own[begun:end], end
            size, number = sizes[some], strings[some]
            joined_text = np.frombuffer(b"".join(text[begin[i] : begin[i] + sizes[i]] for i in some), np.uint8)
            inner = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number)
            starts = np.repeat(np.cumsum(size) - size, number) + inner
            marks[np.repeat(mark_at[some], number) + inner] = occurs_before(joined_text, starts, length)
        bits, at = [], 0
        for m, total in zip(n, np.add.reduceat(strings, np.cumsum([0, *n[:-1]])).tolist()):
            bits.append(pack_bytes(np.packbits(marks[at : at + total])))
            at += total
        return frame(_MARKS, chunk=table["chunk"].to_pylist(), shard=table["shard"].to_pylist(), earlier=bits)

    return run


# ---------------------------------------------------------------- result

_OUT = pa.schema(
    [
        ("id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept", pa.binary()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)


def _cut(length: int, k: int, total: int, shard_bits: int):
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _OUT.empty_table()
        _, ids, texts = texts_of(table)
        known = with_id(ids)
        common = replies.filter(pa.compute.is_valid(replies["common"]))
        marked = replies.filter(pa.compute.is_valid(replies["earlier"]))
        found = Contexts(texts[:known], common, length, k, total, shard_bits)
        cover = np.zeros(len(found.text) + length + 1, np.int32)

        def mark(begin: np.ndarray, end: np.ndarray) -> None:
            np.add.at(cover, begin, 1)
            np.add.at(cover, end, -1)

        # A repeated context goes; of its first place those strings go that the shard has marked.
        again = np.ones(len(found.starts), bool)
        again[found.kept] = False
        mark(found.starts[again], (found.starts + found.strings - 1 + length)[again])
        blobs = dict(zip(marked["shard"].to_pylist(), marked["earlier"].to_pylist()))
        for shard, a, b in found.ranges:
            own = found.kept[found.order[a:b]]
            size = found.strings[own]
            n = int(size.sum())
            bits = np.unpackbits(unpack_bytes(blobs[shard], -(-n // 8)), count=n).astype(bool)
            begin = (np.repeat(found.starts[own] - (np.cumsum(size) - size), size) + np.arange(n))[bits]
            mark(begin, begin + length)
        gone = np.cumsum(cover) > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        lows, highs = edge[0::2], edge[1::2]
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts[:known])])
        run_of = np.searchsorted(lows, offsets)
        removed, kept, spans = [], [], []
        for i, text in enumerate(texts):
            cuts = []
            if i < known and run_of[i] < run_of[i + 1]:
                at = offsets[i]
                cuts = [(int(a - at), int(b - at)) for a, b in zip(lows[run_of[i] : run_of[i + 1]], highs[run_of[i] : run_of[i + 1]])]
            edges = [0, *(e for cut in cuts for e in cut), len(text)]
            removed.append(sum(b - a for a, b in cuts))
            kept.append(b"".join(text[a:b] for a, b in zip(edges[0::2], edges[1::2])))
            spans.append([{"start": a, "end": b} for a, b in cuts])
        return frame(_OUT, id=ids, n_bytes=list(map(len, texts)), n_removed=removed, kept=kept, spans=spans)

    return run


def dedup_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, anchor: int = ANCHOR, **sizes
) -> DataFrame:
    """``(id, n_bytes, n_removed, kept, spans)`` of every row; ``kept`` is binary, as a cut may fall inside a character.

    A byte of a text (as UTF-8) goes when a string of ``length`` bytes that covers it also starts earlier: in a row
    with a smaller id, or before it in the same row. Strings may overlap and are judged on the input. Null texts are
    empty. Rows with equal ids follow each other by their texts. Rows without id are kept and remove nothing. Ids are
    integers; ``anchor`` is smaller than ``length``.
    """
    chunks, layout = in_chunks(docs, id_col, text_col, True, **sizes)
    chunks = chunks.withColumn("id", F.col("id").cast("long"))
    rest = (length, anchor, layout.bytes, layout.shard_bits)
    blobs = chunks.groupBy("chunk").applyInArrow(
        _send_anchors(*rest), "shard int, chunk int, n int, hashes binary, counts binary"
    )
    common = blobs.groupBy("shard").applyInArrow(_answer_anchors, "chunk int, shard int, common binary")
    contexts = (
        chunks.groupBy("chunk")
        .cogroup(common.groupBy("chunk"))
        .applyInArrow(
            _send_contexts(*rest), "shard int, chunk int, n int, keys binary, sizes binary, size long, bytes binary"
        )
    )
    marks = contexts.groupBy("shard").applyInArrow(_answer_contexts(length), "chunk int, shard int, earlier binary")
    replies = common.withColumn("earlier", F.lit(None).cast("binary")).unionByName(
        marks.withColumn("common", F.lit(None).cast("binary"))
    )
    result = (
        chunks.groupBy("chunk")
        .cogroup(replies.groupBy("chunk"))
        .applyInArrow(
            _cut(*rest), "id long, n_bytes long, n_removed long, kept binary, spans array<struct<start: long, end: long>>"
        )
    )
    return result.withColumnRenamed("id", id_col)
