"""The bit functions for SQL users: temporary functions whose bodies become part of the plan, without Python."""

from __future__ import annotations

from pyspark.sql import SparkSession

from simmart.schemas import N_BITS

WORDS = -(-N_BITS // 64)

#: Parameters, type and body; the same expressions as in ``bits`` and ``text``, for fingerprints of ``N_BITS`` bits.
FUNCTIONS = {
    "popcount": ("words ARRAY<BIGINT>", "INT", "aggregate(words, 0, (n, w) -> n + bit_count(w))"),
    "common_bits": (
        "a ARRAY<BIGINT>, b ARRAY<BIGINT>", "INT", "aggregate(zip_with(a, b, (x, y) -> bit_count(x & y)), 0, (n, c) -> n + c)",
    ),
    "tanimoto": (
        "a ARRAY<BIGINT>, b ARRAY<BIGINT>", "DOUBLE",
        "aggregate(zip_with(a, b, (x, y) -> struct(bit_count(x & y) AS c, bit_count(x | y) AS u)), struct(0 AS c, 0 AS u),"
        " (s, p) -> struct(s.c + p.c AS c, s.u + p.u AS u), s -> IF(s.u = 0, CAST(0 AS DOUBLE), s.c / s.u))",
    ),
    "bits_pack_text": (
        "bits STRING", "ARRAY<BIGINT>",
        f"IF(bits IS NULL, NULL, transform(sequence(0, {WORDS - 1}),"
        f" w -> CAST(conv(substring(rpad(bits, {WORDS * 64}, '0'), w * 64 + 1, 64), 2, -10) AS BIGINT)))",
    ),
    "bits_unpack": (
        "words ARRAY<BIGINT>", "ARRAY<INT>",
        "IF(words IS NULL, NULL, filter(sequence(0, size(words) * 64 - 1),"
        " i -> getbit(get(words, shiftright(i, 6)), 63 - i % 64) = 1))",
    ),
    "zero_as_null": (
        "value STRING", "DECIMAL(9,2)", "nullif(try_cast(nullif(trim(value), '') AS DECIMAL(9,2)), CAST(0 AS DECIMAL(9,2)))",
    ),
    "is_blank": ("value STRING", "BOOLEAN", r"value IS NULL OR value RLIKE r'(?U)^[\s\x1c-\x1f]*$'"),
    "month_stamp": ("day DATE", "STRING", "date_format(day, 'MM_yyyy')"),
}


def register_sql_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Create the functions for this session, each under ``prefix`` and its name; returns the names."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS {result} RETURN {body}")
    return [prefix + name for name in FUNCTIONS]
