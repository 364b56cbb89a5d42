"""Reports over the star. One source may hold a large part of the fact table, so every report combines rows by source
before it joins, and the window report splits such sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simmart.functions.bits import once
from simmart.schemas import SCORE as SCORE_TYPE

SOURCE, TARGET, SCORE = "source_chembl_id", "target_chembl_id", "tanimoto_similarity_score"
BANDS = 200
# Rows of the sample for each range of ``row_cuts``.
SAMPLED = 50
TOTAL = "TOTAL"


def _ratio(total: Column, count: Column) -> Column:
    return total.cast("double") / F.nullif(count, F.lit(0))


def score_sums(fact: DataFrame, by: str = SOURCE) -> DataFrame:
    """Sum ``s`` and number ``n`` of the scores per source, or per target with ``by``."""
    return fact.groupBy(by).agg(F.sum(F.col(SCORE).cast(SCORE_TYPE)).alias("s"), F.count(SCORE).alias("n"))


def mean_of(sums: DataFrame, by: str, name: str) -> DataFrame:
    return sums.select(by, _ratio(F.col("s"), F.col("n")).alias(name))


def avg_similarity_per_source(fact: DataFrame, by: str = SOURCE) -> DataFrame:
    """Mean score per source, or per target with ``by``."""
    return mean_of(score_sums(fact, by), by, "avg_similarity_score")


def avg_property_deviation(fact: DataFrame, dim: DataFrame, column: str = "alogp", by: str = SOURCE) -> DataFrame:
    """Mean absolute difference of a property between source and target; NULL when no pair has both values."""
    return mean_of(deviation_sums(fact, dim, column, by), by, f"avg_{column}_deviation")


def deviation_sums(fact: DataFrame, dim: DataFrame, column: str, by: str = SOURCE) -> DataFrame:
    """Sum ``s`` and number ``n`` of the absolute differences of a property, of pairs that have both values."""
    ids = dim.select("chembl_id", column)
    other = TARGET if by == SOURCE else SOURCE
    theirs = ids.select(F.col("chembl_id").alias(other), F.col(column).alias("theirs"))
    own = ids.select(F.col("chembl_id").alias(by), F.col(column).alias("own"))
    # Rows with the same counterpart value collapse before the second join: two-decimal values leave few per source.
    pairs = fact.select(by, other).join(theirs, other).groupBy(by, "theirs").agg(F.count(F.lit(1)).alias("n"))
    gap = F.abs(F.col("own") - F.col("theirs"))
    return (
        pairs.join(own, by)
        .groupBy(by)
        .agg(F.sum(gap * F.col("n")).alias("s"), F.sum(F.when(gap.isNotNull(), F.col("n"))).alias("n"))
    )


def similarity_categories(fact: DataFrame, dim: DataFrame, with_grouping_id: bool = False) -> DataFrame:
    """Mean score by source, by (aromatic rings, heavy atoms), by heavy atoms and overall.

    Only the overall row says ``TOTAL``; other rolled-up columns are NULL. ``with_grouping_id`` tells them from NULL
    values.
    """
    return categories_of(score_sums(fact), dim, with_grouping_id)


def categories_of(per_source: DataFrame, dim: DataFrame, with_grouping_id: bool = False) -> DataFrame:
    """``similarity_categories`` from the rows of ``score_sums``."""
    keys = [SOURCE, "aromatic_rings", "heavy_atoms"]
    joined = per_source.join(
        dim.select(F.col("chembl_id").alias(SOURCE), "aromatic_rings", "heavy_atoms"), SOURCE
    ).select(*keys, "s", "n")
    sets = [[SOURCE], ["aromatic_rings", "heavy_atoms"], ["heavy_atoms"], []]
    grouped = joined.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in keys]).agg(
        F.grouping_id().alias("gid"), F.sum("s").alias("s"), F.sum("n").alias("n")
    )
    labels = [
        F.when(F.col("gid") == 7, F.lit(TOTAL)).otherwise(F.col(c).cast("string")).alias(c) for c in keys
    ]
    extra = [F.col("gid").cast("int").alias("grouping_id")] if with_grouping_id else []
    return grouped.select(*labels, _ratio(F.col("s"), F.col("n")).alias("avg_similarity_score"), *extra)


def row_cuts(fact: DataFrame, by: str = SOURCE, ranges: int = BANDS) -> list[str]:
    """Rows, as JSON, that cut the fact table, ordered by source, score and target, into about ``ranges`` ranges of equal
    depth.

    A sample chosen by a hash of the row decides: some ``SAMPLED`` rows a range whatever the size of the table, so a
    range is seldom more than 1.6 times as deep as the mean. Rows equal in all three columns cannot be told apart; they
    stay in one range.
    """
    places = fact.select(_place(by).alias("place"))
    rows = places.count()
    if not rows:
        return []
    wanted = ranges * SAMPLED
    share = F.pmod(F.xxhash64("place"), F.lit(1 << 40)) < F.lit(min(1.0, wanted / rows) * (1 << 40))
    sample = [r[0] for r in places.filter(share).distinct().sort("place").select(F.to_json("place")).collect()]
    step = max(1, len(sample) // ranges)
    return sample[step::step]


def _place(by: str) -> Column:
    """Where a row stands: structs compare field by field, NULL first."""
    other = TARGET if by == SOURCE else SOURCE
    names = by, "down", other
    return F.struct(*(c.alias(n) for c, n in zip((F.col(by), -F.col(SCORE), F.col(other)), names)))


def _range(fact: DataFrame, by: str, cuts: list[str]) -> Column:
    """Number of cuts at or before a row, by steps of falling powers of two over a constant array."""
    place = _place(by)
    of_type = fact.select(place.alias("place")).schema["place"].dataType
    rows = F.from_json(F.lit(f"[{','.join(cuts)}]"), T.ArrayType(of_type))
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))), F.lit(0))

    def search(row: Column) -> Column:
        def step(at: Column, size: Column) -> Column:
            further = (at + size <= len(cuts)) & (F.get(rows, at + size - 1) <= row)
            return F.when((size > 0) & further, at + size).otherwise(at)

        return F.aggregate(steps, F.lit(0), step)

    return once(place, search)


def next_most_similar(
    fact: DataFrame, by: str = SOURCE, bands: int = BANDS, cuts: list[str] | None = None
) -> DataFrame:
    """Each fact row with the next and second-next target of its source, best score first, NULL scores in front.

    Every source, NULL among them, is cut into ``bands`` bands of its score (one more for NULL), each ordered on its
    own; only the two rows on each side of a cut meet again. One lazy plan for sources of any size. Rows of one source
    with one and the same score lie in one band; with ``cuts`` of ``row_cuts``, which may be those of an earlier state
    of the table, such rows are split, too.
    """
    other = TARGET if by == SOURCE else SOURCE
    order = [F.col(SCORE).desc_nulls_first(), F.col(other).asc()]
    inside = F.least(F.greatest(F.floor(F.col(SCORE).cast("double") * bands), F.lit(0)), F.lit(bands - 1))
    band = F.when(F.col(SCORE).isNull(), F.lit(bands)).otherwise(inside)
    band = band if cuts is None else _range(fact, by, cuts)
    rows = fact.select(by, other, SCORE).withColumn("band", band)
    window = Window.partitionBy(by, "band").orderBy(*order)
    inner = _with_leads(rows, [by, "band"], order, other)
    inner = inner.withColumn("from_start", F.row_number().over(window)).withColumn(
        "from_end", F.count(F.lit(1)).over(Window.partitionBy(by, "band")) - F.col("from_start")
    )
    columns = [by, other, SCORE, "next_most_similar", "second_most_similar"]
    settled = inner.filter("from_end >= 2").select(*columns)
    # The two first and two last rows of every band, in order, hold all that the last rows still need.
    edges = inner.filter("from_start <= 2 OR from_end < 2").drop("next_most_similar", "second_most_similar")
    return settled.unionByName(_with_leads(edges, [by], order, other).filter("from_end < 2").select(*columns))


def _with_leads(rows: DataFrame, keys: list[str], order: list[Column], value: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("next_most_similar", F.lead(value, 1).over(window)).withColumn(
        "second_most_similar", F.lead(value, 2).over(window)
    )


def register_report_views(spark: SparkSession, fact: DataFrame, dim: DataFrame) -> None:
    """The reports as temporary views, for SQL users."""
    avg_similarity_per_source(fact).createOrReplaceTempView("avg_similarity_per_source")
    avg_property_deviation(fact, dim).createOrReplaceTempView("avg_alogp_deviation")
    next_most_similar(fact).createOrReplaceTempView("next_most_similar")
    similarity_categories(fact, dim).createOrReplaceTempView("avg_similarity_score_categories")
