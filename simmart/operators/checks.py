"""Table constraints as row filters: keys, required columns, lengths, foreign keys."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Places in which the rows of one repeated key meet its first row.
SALTS = 16


@dataclass(frozen=True)
class TableRules:
    """What a table demands of its rows."""

    key: list[str] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    max_length: dict[str, int] = field(default_factory=dict)
    foreign: dict[str, str] = field(default_factory=dict)  # column -> name of a frame in ``refs``


def _row_reasons(df: DataFrame, rules: TableRules) -> list[Column]:
    required = list(dict.fromkeys([*rules.key, *rules.not_null]))
    absent = {*required, *rules.max_length, *rules.foreign}.difference(df.columns)
    if absent:
        raise ValueError(f"rules for columns that are not there: {', '.join(sorted(absent))}")
    reasons = [F.when(F.col(c).isNull(), F.lit(f"null:{c}")) for c in required]
    reasons += [F.when(F.length(c) > n, F.lit(f"length:{c}")) for c, n in rules.max_length.items()]
    return reasons


def check_constraints(
    df: DataFrame, rules: TableRules, refs: dict[str, DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into rows that keep all rules and rejects.

    Rejects carry ``reject_reason`` (comma-separated) and ``copies``, the number of identical input rows they stand
    for. Of several rows with one key the first in column order stays. ``refs`` maps a name to a frame whose first
    column holds the allowed values. A rule for a column that ``df`` lacks is an error.
    """
    columns = df.columns
    checked = df
    for column, ref in rules.foreign.items():
        frame = (refs or {})[ref]
        known = frame.select(F.col(frame.columns[0]).alias(column), F.lit(True).alias(f"_known_{column}")).distinct()
        checked = checked.join(known, column, "left")
    reasons = _row_reasons(df, rules) + [
        F.when(F.col(c).isNotNull() & F.col(f"_known_{c}").isNull(), F.lit(f"fk:{c}")) for c in rules.foreign
    ]
    if reasons:
        reason = F.nullif(F.concat_ws(",", *reasons), F.lit(""))
    else:
        reason = F.lit(None).cast("string")
    checked = checked.select(*columns, reason.alias("reject_reason"))
    good = checked.filter("reject_reason IS NULL").drop("reject_reason")
    rejects = checked.filter("reject_reason IS NOT NULL").withColumn("copies", F.lit(1).cast("bigint"))
    if rules.key:
        good, repeated = _split_repeated(good, rules.key)
        rejects = rejects.unionByName(repeated)
    return good, rejects


def _split_repeated(df: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """First row per key, and what is left over.

    Keys are counted alone; only rows of repeated keys go on. Identical ones collapse into a count and meet the first
    row of their key in ``SALTS`` places, so a key that fills a third of the table is not gathered.
    """
    columns = df.columns
    repeated_keys = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_all")).filter("_all > 1").select(*key)
    once = df.join(repeated_keys, key, "left_anti").select(*columns)
    several = df.join(repeated_keys, key, "left_semi").select(*columns)
    counted = several.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    row = F.struct(*[F.col(c) for c in columns])
    first = counted.groupBy(*key).agg(F.min(row).alias("_first"))
    salted = first.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    left = counted.withColumn("_salt", F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")).join(salted, [*key, "_salt"])
    left = left.withColumn("copies", F.col("_n") - F.when(row.eqNullSafe(F.col("_first")), 1).otherwise(0))
    repeated = left.filter("copies > 0").select(
        *columns, F.lit(f"key:{'+'.join(key)}").alias("reject_reason"), "copies"
    )
    return once.unionByName(first.select("_first.*").select(*columns)), repeated


def distinct_by_key(df: DataFrame, key: list[str]) -> DataFrame:
    """One row per key, the smallest by column order."""
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    picked = df.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_row"))
    return picked.select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns])
