"""Reports kept up as facts arrive: sums of each load are stored once and added up when a report is read.

A load's folder holds one row per source or target of its facts and report, never a fact row. Running a load again
replaces its folder. Properties count as they are when the load is added, as dimension rows are never changed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simmart.plans.reports import SOURCE, TARGET, categories_of, deviation_sums, mean_of, score_sums
from simmart.sources.tables import CODEC, finished_parts

SUMS = "report string, by string, id string, s decimal(38,6), n bigint"
SCORES = "tanimoto_similarity_score"


def add_report_load(
    facts: DataFrame, dim: DataFrame, directory: str, load: int, columns: tuple[str, ...] = ("alogp",)
) -> None:
    """Store what the facts of one load add to the reports on scores and on the deviations of ``columns``.

    ``facts`` are the new rows alone; ``dim`` is the dimension with the rows that came with them. Facts are read once for
    each report and side, so store them beforehand if they are dear.
    """
    parts = []
    for by in (SOURCE, TARGET):
        reports = {SCORES: score_sums(facts, by)} | {c: deviation_sums(facts, dim, c, by) for c in columns}
        for report, sums in reports.items():
            number = F.coalesce("n", F.lit(0)).cast("bigint")
            parts.append(
                sums.select(
                    F.lit(report).alias("report"), F.lit(by).alias("by"), F.col(by).alias("id"),
                    F.col("s").cast("decimal(38,6)").alias("s"), number.alias("n"),
                )
            )
    rows = reduce(DataFrame.union, parts)
    rows.write.mode("overwrite").option("compression", CODEC).parquet(f"{directory}/load={load}")


def _sums(spark: SparkSession, directory: str, report: str, by: str) -> DataFrame:
    loads = finished_parts(spark, directory, "load")
    if not loads:
        raise ValueError(f"no finished load in {directory}")
    rows = spark.read.schema(SUMS).parquet(*(f"{directory}/load={n}" for n in loads))
    wanted = rows.filter((F.col("report") == report) & (F.col("by") == by))
    return wanted.groupBy(F.col("id").alias(by)).agg(F.sum("s").alias("s"), F.sum("n").alias("n"))


def stored_avg_similarity(spark: SparkSession, directory: str, by: str = SOURCE) -> DataFrame:
    """``avg_similarity_per_source`` over all loads."""
    return mean_of(_sums(spark, directory, SCORES, by), by, "avg_similarity_score")


def stored_property_deviation(spark: SparkSession, directory: str, column: str = "alogp", by: str = SOURCE) -> DataFrame:
    """``avg_property_deviation`` over all loads; ``column`` is one that every load was added with."""
    return mean_of(_sums(spark, directory, column, by), by, f"avg_{column}_deviation")


def stored_categories(spark: SparkSession, directory: str, dim: DataFrame, with_grouping_id: bool = False) -> DataFrame:
    """``similarity_categories`` over all loads."""
    return categories_of(_sums(spark, directory, SCORES, SOURCE), dim, with_grouping_id)
