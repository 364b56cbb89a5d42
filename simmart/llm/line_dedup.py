"""Removal of lines that many documents share (operator 8).

Distinct line hashes are dealt to shards. A shard builds a minimal perfect hash over its hashes, which indexes compact
arrays: a fingerprint, the number of documents, and the largest document id. The lines of every chunk of documents are
probed in these arrays, so lines are never joined, and a chunk sends each distinct line once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simmart.llm.blocks import (
    frame,
    in_chunks,
    mix,
    pack_bytes,
    pack_sorted,
    shard_ranges,
    texts_of,
    unpack_bytes,
    unpack_sorted,
)

MIN_CHARS, MIN_DOCS = 20, 3
# Ids of rows without one: smaller than all others.
NO_ID = -(1 << 63)
# Slots for each key of a level; more slots need fewer levels.
GAMMA = 2.0
LEVELS = 48

_SPACE = b" \t\n\x0b\x0c\r"
_BLOBS = pa.schema(
    [
        ("shard", pa.int32()),
        ("chunk", pa.int32()),
        ("n", pa.int32()),
        ("hashes", pa.binary()),
        ("docs", pa.binary()),
        ("last", pa.binary()),
    ]
)
_REPLIES = pa.schema([("chunk", pa.int32()), ("shard", pa.int32()), ("repeated", pa.binary()), ("last", pa.binary())])


class MinimalHash:
    """Numbers distinct 64-bit keys 0..n-1 by levels of bits.

    A key takes the first level on which no other remaining key falls into its slot; its number is the count of bits
    before that slot. Keys left after all levels (equal in every level) are looked up by order.
    """

    def __init__(self, keys: np.ndarray):
        self.levels, self.n, rest = [], 0, keys
        while len(rest) and len(self.levels) < LEVELS:
            size = max(64, -(-int(GAMMA * len(rest)) // 64) * 64)
            slot = self._slots(rest, len(self.levels), size)
            alone = np.bincount(slot, minlength=size) == 1
            words = np.packbits(alone, bitorder="little").view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((size, words, before[:-1] + self.n))
            self.n += int(before[-1])
            rest = rest[~alone[slot]]
        self.rest = np.sort(rest)

    @staticmethod
    def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(size)).astype(np.int64)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key; a key that was not built in gets any number or -1."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (size, words, before) in enumerate(self.levels):
            slot = self._slots(keys[left], level, size)
            word, bit = slot >> 6, (slot & 63).astype(np.uint64)
            hit = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = (before[word] + np.bitwise_count(below))[hit]
            left = left[~hit]
        if len(left) and len(self.rest):
            place = np.minimum(np.searchsorted(self.rest, keys[left]), len(self.rest) - 1)
            out[left] = np.where(self.rest[place] == keys[left], self.n + place, -1)
        return out


class LineIndex:
    """Fingerprints, document counts and largest ids of the lines of one shard, without the hashes themselves."""

    def __init__(self, hashes: np.ndarray, docs: np.ndarray, last: np.ndarray):
        distinct = np.unique(hashes)
        self.number = MinimalHash(distinct)
        self.prints = np.zeros(len(distinct), np.uint32)
        self.docs = np.zeros(len(distinct), np.int64)
        self.last = np.full(len(distinct), NO_ID, np.int64)
        at = self.number.numbers(hashes)
        self.prints[at] = self._print(hashes)
        np.add.at(self.docs, at, docs)
        np.maximum.at(self.last, at, last)

    @staticmethod
    def _print(hashes: np.ndarray) -> np.ndarray:
        return (mix(~hashes) >> np.uint64(32)).astype(np.uint32)

    def probe(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and largest id of each line; no documents where the fingerprint is another."""
        at = self.number.numbers(hashes)
        known = (at >= 0) & (self.prints[at] == self._print(hashes))
        return np.where(known, self.docs[at], 0), self.last[at]


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The line without white space at its ends, A-Z in lower case; none when it is too short."""
    key = line.strip(_SPACE).lower()
    if len(key) < min_chars:
        return None
    # Bytes that continue a character don't count.
    return key if len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars else None


def _hashed(texts: list[bytes], min_chars: int) -> tuple[list[list[bytes]], list[np.ndarray]]:
    """Lines of each text and their hashes (0: too short to count)."""
    digest = xxhash.xxh3_64_intdigest
    lines = [text.split(b"\n") for text in texts]
    hashes = []
    for own in lines:
        keys = (line_key(line, min_chars) for line in own)
        hashes.append(np.fromiter((0 if k is None else digest(k) or 1 for k in keys), np.uint64, len(own)))
    return lines, hashes


def _distinct(hashes: list[np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes of a chunk, the number of rows that hold each, and the largest id among them."""
    own = [np.unique(h[h > 0]) for h in hashes]
    every = np.concatenate([np.zeros(0, np.uint64), *own])
    holder = np.repeat(ids, [len(h) for h in own])
    distinct, back, docs = np.unique(every, return_inverse=True, return_counts=True)
    last = np.full(len(distinct), NO_ID, np.int64)
    np.maximum.at(last, back, holder)
    return distinct, docs, last


def _ids(ids: list) -> np.ndarray:
    return np.array([NO_ID if i is None else i for i in ids], np.int64)


def _send(min_chars: int, shard_bits: int):
    def run(table: pa.Table) -> pa.Table:
        _, ids, texts = texts_of(table)
        hashes, docs, last = _distinct(_hashed(texts, min_chars)[1], _ids(ids))
        ranges = shard_ranges(hashes, shard_bits)
        return frame(
            _BLOBS,
            shard=[s for s, _, _ in ranges],
            chunk=[table["chunk"][0].as_py()] * len(ranges),
            n=[b - a for _, a, b in ranges],
            hashes=[pack_sorted(hashes[a:b]) for _, a, b in ranges],
            docs=[pack_bytes(docs[a:b].astype(np.uint32)) for _, a, b in ranges],
            last=[pack_bytes(last[a:b]) for _, a, b in ranges],
        )

    return run


def _answer(min_docs: int):
    def run(table: pa.Table) -> pa.Table:
        sizes = table["n"].to_pylist()
        blobs = [unpack_sorted(b, n) for b, n in zip(table["hashes"].to_pylist(), sizes)]
        docs = [unpack_bytes(b, n, np.uint32) for b, n in zip(table["docs"].to_pylist(), sizes)]
        last = [unpack_bytes(b, n, np.int64) for b, n in zip(table["last"].to_pylist(), sizes)]
        index = LineIndex(np.concatenate(blobs), np.concatenate(docs), np.concatenate(last))
        repeated, keeper = [], []
        for hashes in blobs:
            count, largest = index.probe(hashes)
            hit = count >= min_docs
            repeated.append(pack_bytes(hit.astype(np.uint8)))
            keeper.append(pack_bytes(largest[hit]))
        return frame(
            _REPLIES,
            chunk=table["chunk"].to_pylist(),
            shard=table["shard"].to_pylist(),
            repeated=repeated,
            last=keeper,
        )

    return run


def _cut(min_chars: int, shard_bits: int, carried: bool):
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        order, ids, texts = texts_of(table)
        lines, hashes = _hashed(texts, min_chars)
        own_ids = _ids(ids)
        distinct = np.unique(np.concatenate([np.zeros(0, np.uint64), *(h[h > 0] for h in hashes)]))
        keeper = {}
        at = {shard: (a, b) for shard, a, b in shard_ranges(distinct, shard_bits)}
        for shard, hit, last in zip(*(replies[c].to_pylist() for c in ("shard", "repeated", "last"))):
            a, b = at[shard]
            found = distinct[a:b][unpack_bytes(hit, b - a).astype(bool)]
            keeper.update(zip(found.tolist(), unpack_bytes(last, len(found), np.int64).tolist()))
        n_lines, n_dropped, kept = [], [], []
        for own, keys, text, i in zip(lines, hashes, texts, own_ids.tolist()):
            stay = [line for line, k in zip(own, keys.tolist()) if keeper.get(k, i) == i]
            n_lines.append(len(own))
            n_dropped.append(len(own) - len(stay))
            kept.append(b"\n".join(stay) if len(stay) < len(own) else text)
        columns = {
            "id": pa.array(ids, pa.int64()),
            "n_lines": pa.array(n_lines, pa.int64()),
            "n_dropped": pa.array(n_dropped, pa.int64()),
            "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
        }
        if carried:
            columns["carried"] = table["carried"].take(pa.array(order)).combine_chunks()
        return pa.table(columns)

    return run


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    carry: tuple[str, ...] = (),
    **sizes,
) -> DataFrame:
    """``(id, n_lines, n_dropped, kept_text)`` of every row, and a struct ``carried`` of the columns in ``carry``.

    A line counts without white space at its ends and with A-Z in lower case. Lines of at least ``min_chars`` code
    points that at least ``min_docs`` rows hold go from every row but those with the largest id among the holders.
    Null and empty texts are one empty line. A line that repeats inside one row counts once. Rows with equal ids count
    apart, and all rows of the largest id keep the line; a null id is smaller than all others.
    """
    chunks, layout = in_chunks(docs, id_col, text_col, False, carry, **sizes)
    chunks = chunks.withColumn("id", F.col("id").cast("long"))
    blobs = chunks.select("id", "text", "chunk").groupBy("chunk")
    blobs = blobs.applyInArrow(
        _send(min_chars, layout.shard_bits),
        "shard int, chunk int, n int, hashes binary, docs binary, last binary",
    )
    replies = blobs.groupBy("shard").applyInArrow(_answer(min_docs), "chunk int, shard int, repeated binary, last binary")
    schema = "id long, n_lines long, n_dropped long, kept_text string"
    if carry:
        schema += f", carried {chunks.schema['carried'].dataType.simpleString()}"
    result = (
        chunks.groupBy("chunk")
        .cogroup(replies.groupBy("chunk"))
        .applyInArrow(_cut(min_chars, layout.shard_bits, bool(carry)), schema)
    )
    return result.withColumnRenamed("id", id_col)
