"""Chunks of documents, shards of hashes, and the blobs that travel between them.

Documents are dealt once into chunks of a few megabytes. A chunk sends the sorted hashes of its windows, lines or
anchors to shards, one packed blob for each shard; a shard answers every blob with one bit or byte for each hash. So a
hash costs a few bytes of shuffle, is sent once by a chunk however often it occurs there, and no task or driver ever
holds the hashes of all documents.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 8 << 20
SHARD_BYTES = 12 << 20
# Leaves of the comparison tree that finds the chunk of an id; finer chunks divide a leaf evenly.
LEAVES = 128
# Bytes hashed at once, so that the arrays of eight bytes a character stay small.
PIECE_BYTES = 1 << 20

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


# ---------------------------------------------------------------- chunks


@dataclass(frozen=True)
class Layout:
    """How many chunks and shards a table gets; both follow from its bytes, so neither grows with the data."""

    chunks: int
    shards: int
    bytes: int

    @property
    def shard_bits(self) -> int:
        return self.shards.bit_length() - 1


def _tree(value: Column, bounds: list, low: int, high: int) -> Column:
    """Number of bounds that are at most ``value``, by halving."""
    if low == high:
        return F.lit(low)
    mid = (low + high) // 2
    return F.when(value < F.lit(bounds[mid]), _tree(value, bounds, low, mid)).otherwise(
        _tree(value, bounds, mid + 1, high)
    )


def in_chunks(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    ordered: bool,
    carry: tuple[str, ...] = (),
    chunk_bytes: int = CHUNK_BYTES,
    shard_bytes: int = SHARD_BYTES,
) -> tuple[DataFrame, Layout]:
    """``(id, text, chunk)`` of every row, and a struct ``carried`` of the columns to take along.

    ``ordered``: ids of a lower chunk are smaller than those of a higher one (ids are integers); else chunks are by
    hash. Rows without id are spread by their text.
    """
    text = F.col(text_col).cast("string")
    wanted = [F.sum(F.octet_length(text)).alias("bytes"), F.min(id_col).alias("low"), F.max(id_col).alias("high")]
    if ordered:
        wanted.append(F.percentile_approx(id_col, [i / LEAVES for i in range(1, LEAVES)], 10_000).alias("bounds"))
    seen = docs.agg(*wanted).first()
    total = seen["bytes"] or 0
    chunks = max(1, math.ceil(total / chunk_bytes))
    layout = Layout(chunks, 1 << max(0, math.ceil(math.log2(max(1, total / shard_bytes)))), total)
    key = F.col(id_col)
    if ordered and seen["bounds"]:
        step = max(1, LEAVES // chunks)
        bounds = sorted(set(seen["bounds"][step - 1 :: step]))
        parts = max(1, math.ceil(chunks / (len(bounds) + 1)))
        leaf = _tree(key, bounds, 0, len(bounds))
        if parts > 1:
            # doubles keep the order of ids, and no difference of two ids is too large for them
            edges = F.array(*(F.lit(float(e)) for e in (seen["low"], *bounds, seen["high"])))
            low = F.element_at(edges, leaf + 1)
            width = F.element_at(edges, leaf + 2) - low
            inner = F.floor((key.cast("double") - low) / F.greatest(width, F.lit(1.0)) * parts)
            leaf = leaf * parts + F.greatest(F.lit(0), F.least(F.lit(parts - 1), inner)).cast("int")
        chunk = leaf
    else:
        chunk = F.pmod(F.xxhash64(key), F.lit(chunks))
    chunk = F.when(key.isNull(), F.pmod(F.xxhash64(text), F.lit(chunks))).otherwise(chunk)
    carried = [F.struct(*(F.col(c) for c in carry)).alias("carried")] if carry else []
    return docs.select(key.alias("id"), text.alias("text"), chunk.cast("int").alias("chunk"), *carried), layout


def texts_of(table: pa.Table) -> tuple[list[int], list, list[bytes]]:
    """Rows of a chunk by id and text, rows without id last: positions, ids, texts as UTF-8 (null: empty)."""
    ids = table["id"].to_pylist()
    texts = pa.compute.fill_null(table["text"].cast(pa.binary()), b"").to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
    return order, [ids[i] for i in order], [texts[i] for i in order]


def with_id(ids: list) -> int:
    """Number of rows with an id; they come first."""
    return sum(i is not None for i in ids)


def short_hashes(hashes: np.ndarray, total_bytes: int, bytes_each: int) -> np.ndarray:
    """Hashes cut to the bits that tell about 8000 times as many apart as a table of so many bytes can have.

    For filters and orders only, where two hashes that fall together cost time and change no result.
    """
    bits = min(64, max(1, total_bytes // bytes_each).bit_length() + 13)
    return hashes & ~np.uint64((1 << (64 - bits)) - 1)


# ---------------------------------------------------------------- hashes


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and ``base ** -i`` modulo 2**64 for i < n; an odd base has an inverse."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(n, 1 << 16)
        up = np.full(size, base, np.uint64)
        down = np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers[base] = np.cumprod(up), np.cumprod(down)
    up, down = _powers[base]
    return up[:n], down[:n]


def rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Rabin-Karp hash of ``values[start:end]``: a difference of prefix sums moved to a common place."""
    up, down = powers(base, len(values) + 1)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * down[starts])


def pieces(texts: list[bytes], limit: int = PIECE_BYTES):
    """Ranges of texts of about ``limit`` bytes together."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield first, i
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words ``[^\\x20\\x09-\\x0D]+`` in order, and the number of words of each text."""
    hashes, counts = [], []
    for first, last in pieces(texts):
        raw = np.frombuffer(b" " + b" ".join(texts[first:last]) + b" ", np.uint8)
        space = (raw == 32) | ((raw >= 9) & (raw <= 13))
        turn = np.flatnonzero(space[1:] != space[:-1]) + 1
        starts, ends = turn[0::2], turn[1::2]
        sizes = np.fromiter(map(len, texts[first:last]), np.int64, last - first)
        begin = np.concatenate([[0], np.cumsum(sizes + 1)]) + 1
        hashes.append(rolling(raw.astype(np.uint64) + np.uint64(1), starts, ends, _BYTE_BASE))
        counts.append(np.diff(np.searchsorted(starts, begin)))
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return (np.concatenate(hashes), np.concatenate(counts)) if hashes else none


def word_windows(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number and first word (counted over all texts) of every window of ``width`` words; words per text."""
    words, counts = word_hashes(texts)
    doc = np.repeat(np.arange(len(texts)), counts)
    starts = np.flatnonzero(doc[: len(doc) - width + 1] == doc[width - 1 :]) if len(doc) >= width else np.zeros(0, np.int64)
    return rolling(words, starts, starts + width, _WORD_BASE), doc[starts], starts, counts


# ---------------------------------------------------------------- blobs


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as compressed differences, all lowest bytes first, then the next ones."""
    steps = np.diff(values, prepend=np.uint64(0))
    planes = steps.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return b"".join(_squeeze(np.ascontiguousarray(p)) for p in planes)


def _squeeze(plane: np.ndarray) -> bytes:
    raw = plane.tobytes()
    small = pa.compress(raw, codec="zstd", asbytes=True)
    body, flag = (small, 1) if len(small) < len(raw) else (raw, 0)
    return len(body).to_bytes(4, "little") + bytes([flag]) + body


def unpack_sorted(blob: bytes, n: int) -> np.ndarray:
    planes, at = np.empty((8, n), np.uint8), 0
    for k in range(8):
        size, flag = int.from_bytes(blob[at : at + 4], "little"), blob[at + 4]
        body = blob[at + 5 : at + 5 + size]
        planes[k] = np.frombuffer(pa.decompress(body, n, codec="zstd", asbytes=True) if flag else body, np.uint8)
        at += 5 + size
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def pack_bytes(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), codec="zstd", asbytes=True)


def unpack_bytes(blob: bytes, n: int, dtype=np.uint8) -> np.ndarray:
    dtype = np.dtype(dtype)
    return np.frombuffer(pa.decompress(blob, n * dtype.itemsize, codec="zstd", asbytes=True), dtype)


def shard_ranges(values: np.ndarray, shard_bits: int) -> list[tuple[int, int, int]]:
    """``(shard, first, last)`` of the non-empty shards of ascending hashes; the highest bits name the shard."""
    if not len(values):
        return []
    if not shard_bits:
        return [(0, 0, len(values))]
    shard = (values >> np.uint64(64 - shard_bits)).astype(np.int64)
    cut = np.flatnonzero(np.diff(shard)) + 1
    edges = [0, *cut.tolist(), len(values)]
    return [(int(shard[a]), a, b) for a, b in zip(edges, edges[1:])]


def joined(replies: pa.Table, column: str, total: int, ranges: list[tuple[int, int, int]], dtype=np.uint8) -> np.ndarray:
    """The answers of all shards to one chunk, in the order of its hashes."""
    out = np.zeros(total, dtype)
    at = {shard: (a, b) for shard, a, b in ranges}
    for shard, blob in zip(replies["shard"].to_pylist(), replies[column].to_pylist()):
        a, b = at[shard]
        out[a:b] = unpack_bytes(blob, b - a, dtype)
    return out


def frame(schema: pa.Schema, **columns) -> pa.Table:
    return pa.table([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
