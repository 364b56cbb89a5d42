"""Arrow batches of fingerprints to packed words and text, for use inside tasks.

The column functions in ``bits`` do the same per row inside an expression; for whole tables the batch form is many
times cheaper.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# Executors run the functions below without having this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows whose bits lie spread out at a time while they are packed.
MATRIX_ROWS = 1_000


def bit_matrix(fp: pa.Array, n_bits: int) -> np.ndarray:
    """Positions or ``0``/``1`` text to one byte per bit, rows padded to whole words.

    Positions outside the width, other characters and texts of another length are errors;
    ``split_fingerprints`` sets such rows aside beforehand.
    """
    rows, width = len(fp), -(-n_bits // 64) * 64
    bits = np.zeros((rows, width), np.uint8)
    if pa.types.is_list(fp.type):
        at = _numbers(fp)
        if len(at) and (at.min() < 0 or at.max() >= n_bits):
            raise ValueError(f"fingerprint with a position outside 0..{n_bits - 1}")
        bits[np.repeat(np.arange(rows), pc.list_value_length(fp).to_numpy(zero_copy_only=False)), at] = 1
    else:
        if rows and (pc.binary_length(fp).to_numpy(zero_copy_only=False) != n_bits).any():
            raise ValueError(f"fingerprint text that has not {n_bits} characters")
        text = b"".join(s.encode() for s in fp.to_pylist())
        bits[:, :n_bits] = np.frombuffer(text, np.uint8).reshape(rows, n_bits) - ord("0")
        if bits.size and bits.max() > 1:
            raise ValueError("fingerprint text with other characters than 0 and 1")
    return bits


def _numbers(fp: pa.Array) -> np.ndarray:
    numbers = fp.flatten()
    if numbers.null_count:
        raise ValueError("fingerprint with a NULL in its list")
    return numbers.to_numpy(zero_copy_only=False)


def pack(fp: pa.Array, n_bits: int) -> np.ndarray:
    """Any stored form to a matrix of packed words, one row per fingerprint.

    ``packbits`` puts position 0 first in a byte; the byte order then makes it the highest bit of its word.
    """
    if pa.types.is_list(fp.type) and pa.types.is_int64(fp.type.value_type):
        n_words = -(-n_bits // 64)
        if len(fp) and (pc.list_value_length(fp).to_numpy(zero_copy_only=False) != n_words).any():
            raise ValueError(f"fingerprint that has not {n_words} words")
        words = np.ascontiguousarray(_numbers(fp).reshape(len(fp), n_words)).view(np.uint64)
        if n_bits % 64 and (words[:, -1] << np.uint64(n_bits % 64)).any():
            raise ValueError(f"fingerprint with a position outside 0..{n_bits - 1}")
        return words
    packed = np.empty((len(fp), -(-n_bits // 64)), np.uint64)
    for first in range(0, len(fp), MATRIX_ROWS):
        part = bit_matrix(fp.slice(first, MATRIX_ROWS), n_bits)
        packed[first : first + len(part)] = np.packbits(part, axis=1).view(">u8")
    return packed


def words_array(fp: pa.Array, n_bits: int) -> pa.Array:
    words = pack(fp, n_bits)
    offsets = np.arange(0, words.size + 1, words.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(words.view(np.int64).ravel()))


def text_array(fp: pa.Array, n_bits: int) -> pa.Array:
    text = np.ascontiguousarray(bit_matrix(fp, n_bits)[:, :n_bits]) + np.uint8(ord("0"))
    offsets = np.arange(0, text.size + 1, n_bits, dtype=np.int32)
    return pa.StringArray.from_buffers(len(fp), pa.py_buffer(offsets), pa.py_buffer(text))


def stored_form(fps: DataFrame, layout: str, n_bits: int) -> DataFrame:
    """``(chembl_id, on)`` to ``(chembl_id, morgan_fingerprint)`` for ``text``, ``(chembl_id, words)`` for ``words``.

    With words a column ``pop`` of ``fps`` is kept.
    """
    if layout not in ("text", "words"):
        raise ValueError("layout is 'text' or 'words'")
    name, kind, build = (
        ("words", "array<bigint>", words_array) if layout == "words" else ("morgan_fingerprint", "string", text_array)
    )

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for raw in batches:
            batch = raw.filter(pc.is_valid(raw.column(1)))
            columns = [batch.column(0), build(batch.column(1), n_bits), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=["chembl_id", name, *more])

    more = ["pop"] if layout == "words" and "pop" in fps.columns else []
    types = {c: fps.schema[c].dataType.simpleString() for c in ("chembl_id", *more)} | {name: kind}
    schema = ", ".join(f"{c} {types[c]}" for c in ("chembl_id", name, *more))
    return fps.select("chembl_id", "on", *more).mapInArrow(convert, schema)
