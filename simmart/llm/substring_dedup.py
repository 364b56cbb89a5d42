"""Removal of word windows that already stand in an earlier document (operator 3).

Rabin-Karp hashes of every window of ``width`` words are counted over all documents: a chunk sends each distinct hash
once, a shard finds the first chunk that holds it, and a chunk removes the windows that an earlier document has, inside
the chunk or in a lower one. Overlapping windows merge into maximal spans.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simmart.llm.blocks import (
    frame,
    in_chunks,
    joined,
    pack_bytes,
    pack_sorted,
    shard_ranges,
    texts_of,
    unpack_sorted,
    with_id,
    word_windows,
)

WIDTH = 13

_BLOBS = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("n", pa.int32()), ("hashes", pa.binary())])
_REPLIES = pa.schema([("chunk", pa.int32()), ("shard", pa.int32()), ("earlier", pa.binary())])


def _send(width: int, shard_bits: int):
    def run(table: pa.Table) -> pa.Table:
        _, ids, texts = texts_of(table)
        hashes = np.unique(word_windows(texts[: with_id(ids)], width)[0])
        ranges = shard_ranges(hashes, shard_bits)
        return frame(
            _BLOBS,
            shard=[s for s, _, _ in ranges],
            chunk=[table["chunk"][0].as_py()] * len(ranges),
            n=[b - a for _, a, b in ranges],
            hashes=[pack_sorted(hashes[a:b]) for _, a, b in ranges],
        )

    return run


def _answer(table: pa.Table) -> pa.Table:
    """For every blob of a shard one byte a hash: 1 when a lower chunk holds it too."""
    table = table.sort_by("chunk")
    sizes = table["n"].to_pylist()
    hashes = np.concatenate([unpack_sorted(b, n) for b, n in zip(table["hashes"].to_pylist(), sizes)])
    order = np.argsort(hashes, kind="stable")
    again = np.zeros(len(hashes), np.uint8)
    ordered = hashes[order]
    again[order[1:]] = ordered[1:] == ordered[:-1]
    cuts = np.cumsum([0, *sizes])
    return frame(
        _REPLIES,
        chunk=table["chunk"].to_pylist(),
        shard=table["shard"].to_pylist(),
        earlier=[pack_bytes(again[a:b]) for a, b in zip(cuts, cuts[1:])],
    )


def _spans(removed: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], removed.astype(np.int8), [0]])))
    return [{"start": a, "end": b} for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist())]


def _cut(width: int, shard_bits: int, out: pa.Schema):
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return out.empty_table()
        _, ids, texts = texts_of(table)
        known = with_id(ids)
        hashes, doc, start, counts = word_windows(texts[:known], width)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        earlier = joined(replies, "earlier", len(distinct), shard_ranges(distinct, shard_bits)).astype(bool)
        # Rows stand in the order of their ids, so the first window is one of the smallest id.
        id_of = np.array(ids[:known], dtype=np.int64)
        bad = earlier[back] | (id_of[doc[first]][back] < id_of[doc])
        covered = np.zeros(int(counts.sum()) + 1, np.int32)
        np.add.at(covered, start[bad], 1)
        np.add.at(covered, start[bad] + width, -1)
        covered = np.cumsum(covered[:-1]) > 0
        words, removed, kept, spans, at = [], [], [], [], 0
        for i, text in enumerate(texts):
            own = text.split()
            gone = covered[at : at + len(own)] if i < known else np.zeros(len(own), bool)
            at += len(own)
            n = int(gone.sum())
            words.append(len(own))
            removed.append(n)
            spans.append(_spans(gone) if n else [])
            kept.append(b" ".join(compress(own, ~gone) if n else own))
        return frame(out, id=ids, n_words=words, n_removed=removed, kept_text=pa.array(kept, pa.binary()).cast(pa.string()), spans=spans)

    return run


def dedup_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, **sizes) -> DataFrame:
    """``(id, n_words, n_removed, kept_text, spans)`` of every row; the id keeps its name, spans are ranges of words.

    A word goes when a window of ``width`` words that covers it also starts in a row with a smaller id. Windows are
    judged on the input. Null and empty texts have no words; texts shorter than a window are kept; rows with equal
    ids don't remove each other's words; rows without id are kept and remove nothing. Ids are integers. Kept words are
    joined by one space. Other columns are not looked at.
    """
    chunks, layout = in_chunks(docs, id_col, text_col, True, **sizes)
    kind = "long"
    chunks = chunks.withColumn("id", F.col("id").cast(kind))
    out = pa.schema(
        [
            ("id", pa.int64()),
            ("n_words", pa.int64()),
            ("n_removed", pa.int64()),
            ("kept_text", pa.string()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ]
    )
    blobs = chunks.groupBy("chunk").applyInArrow(
        _send(width, layout.shard_bits), "shard int, chunk int, n int, hashes binary"
    )
    replies = blobs.groupBy("shard").applyInArrow(_answer, "chunk int, shard int, earlier binary")
    result = (
        chunks.groupBy("chunk")
        .cogroup(replies.groupBy("chunk"))
        .applyInArrow(
            _cut(width, layout.shard_bits, out),
            "id long, n_words long, n_removed long, kept_text string, spans array<struct<start: long, end: long>>",
        )
    )
    return result.withColumnRenamed("id", id_col)
