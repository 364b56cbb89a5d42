"""Fingerprint columns: on-bit positions, ``0``/``1`` text and packed words.

``on``    ARRAY<INT>, sorted positions
``bits``  STRING of ``n_bits`` characters, position 0 first
``words`` ARRAY<BIGINT>, 64 positions per word, position 0 in the highest bit of word 0
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from simmart.schemas import N_BITS


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, also where ``use`` refers to it inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def int_array(values: list[int]) -> Column:
    """A constant array of many numbers: one text that Spark turns into a constant, not a literal for each."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")


def bits_encode(on: Column, n_bits: int = N_BITS) -> Column:
    """Positions to text: the gap before each position is a run of zeros."""

    def encode(a: Column) -> Column:
        def before(i: Column) -> Column:
            return F.coalesce(F.get(a, i - 1), F.lit(-1))

        runs = F.transform(a, lambda x, i: F.concat(F.repeat(F.lit("0"), x - before(i) - 1), F.lit("1")))
        return F.concat(F.array_join(runs, ""), F.repeat(F.lit("0"), F.lit(n_bits - 1) - before(F.size(a))))

    return once(on, encode)


def bits_decode(bits: Column) -> Column:
    """Text to positions. Bytes are addressed directly; a character offset would be searched from the start."""

    def decode(raw: Column) -> Column:
        every = F.when(F.length(raw) > 0, F.sequence(F.lit(0), F.length(raw) - 1)).otherwise(
            F.array().cast("array<int>")
        )
        return F.filter(every, lambda i: F.substring(raw, i + 1, F.lit(1)) == F.lit(b"1"))

    return F.when(bits.isNotNull(), once(bits.cast("binary"), decode))


def bits_pack_text(bits: Column, n_bits: int = N_BITS) -> Column:
    """Text to packed words, one base conversion per word."""
    n_words = -(-n_bits // 64)
    places = F.sequence(F.lit(0), F.lit(n_words - 1))

    def pack(padded: Column) -> Column:
        return F.transform(
            places, lambda w: F.conv(F.substring(padded, w * 64 + 1, F.lit(64)), 2, -10).cast("bigint")
        )

    return F.when(bits.isNotNull(), once(F.rpad(bits, n_words * 64, "0"), pack))


def bits_pack(on: Column, n_bits: int = N_BITS) -> Column:
    """Positions to packed words."""
    return bits_pack_text(bits_encode(on, n_bits), n_bits)


def bits_unpack(words: Column) -> Column:
    """Packed words to positions."""

    def unpack(w: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(w) * 64 - 1)
        return F.filter(every, lambda i: F.getbit(F.get(w, F.shiftright(i, 6)), 63 - i % 64) == 1)

    return F.when(words.isNotNull(), once(words, unpack))


def malformed(fp: Column, kind: str, n_bits: int = N_BITS) -> Column:
    """True for a stored fingerprint that is no ``n_bits`` wide set; ``kind`` is ``on``, ``morgan_fingerprint`` (text) or
    ``words``."""
    if kind == "on":
        return F.exists(fp, lambda x: x.isNull() | (x < 0) | (x >= n_bits))
    if kind == "morgan_fingerprint":
        return (F.length(fp) != n_bits) | ~fp.rlike(r"\A[01]*\z")
    n_words = -(-n_bits // 64)
    bad = (F.size(fp) != n_words) | F.exists(fp, lambda w: w.isNull())
    return bad | (F.shiftleft(F.get(fp, F.lit(n_words - 1)), n_bits % 64) != 0) if n_bits % 64 else bad


def popcount(words: Column) -> Column:
    """Number of on-bits in packed words."""
    return F.aggregate(words, F.lit(0), lambda n, w: n + F.bit_count(w))


def tanimoto(fp_a: Column, pop_a: Column, fp_b: Column, pop_b: Column, empty_score: float = 0.0) -> Column:
    """Common on-bits over all on-bits, for pairs that a join has already brought together.

    One division of two integers, so equal ratios are equal doubles and ties can be tested with ``=``.
    """
    common = F.aggregate(
        F.zip_with(fp_a, fp_b, lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda n, c: n + c
    )
    union = pop_a + pop_b - common
    return F.when(union == 0, F.lit(float(empty_score))).otherwise(common / union)
