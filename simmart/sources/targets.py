"""Monthly target lists: CSV with a header in any case, lines with too many fields set aside."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simmart.functions.text import csv_field_count
from simmart.operators.fingerprint import require_columns
from simmart.schemas import ID_PREFIX
from simmart.session import empty

NAME, STRUCTURE = "molecule name", "smiles"
_LINE = "_line"


def _options(reader):
    return reader.option("header", True).option("encoding", "UTF-8").option("escape", '"')


def lower_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def _files_by_header(spark: SparkSession, path: str) -> tuple[list[list[str]], list[str]]:
    """The files at ``path``, those with one header together, and the files without lines. Only names reach the driver."""
    files = spark.read.text(path)
    lines = files.select("value", "_metadata.file_path", "_metadata.file_block_start")
    starts = lines.filter("file_block_start = 0 AND trim(value) <> ''")
    # Ids grow with the lines of a block, so the smallest is the first line of its file.
    numbered = starts.withColumn("at", F.monotonically_increasing_id())
    headers = numbered.groupBy("file_path").agg(F.min_by("value", "at").alias("header"))
    groups = [row.files for row in headers.groupBy("header").agg(F.collect_list("file_path").alias("files")).collect()]
    # A scan passes over files of no length, the listing has them.
    filled = {_place(f) for group in groups for f in group}
    return groups, sorted(f for f in files.inputFiles() if _place(f) not in filled)


def _place(file: str) -> str:
    """A file name for comparison: ``file:/x`` and ``file:///x`` are one file."""
    return re.sub(r"^(\w+):/+(?=[^/])", r"\1:/", file)


def read_targets(
    spark: SparkSession, path: str, id_prefix: str = ID_PREFIX, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``(target_chembl_id, smiles)`` and rejected rows as ``(line, reject_reason)``.

    The header of each file decides which of its columns are read, in any order. Short lines are kept with NULL in the
    missing fields; lines with too many fields, without a name or with a name that lacks the prefix are rejected. Exact
    duplicates are dropped. Files without any line are rejected as ``empty_file`` with their path. ``multi_line``
    allows line breaks inside quotes; a file is then read by one task.
    """
    groups, without_lines = _files_by_header(spark, path)
    parts = [_read_alike(spark, files, id_prefix, multi_line) for files in groups]
    rejects = empty_files(spark, without_lines)
    if not parts:
        return no_targets(spark), rejects
    good = reduce(DataFrame.unionByName, [g for g, _ in parts])
    return good.distinct(), reduce(DataFrame.unionByName, [r for _, r in parts], rejects)


def no_targets(spark: SparkSession) -> DataFrame:
    return empty(spark, T.StructType().add("target_chembl_id", "string").add(STRUCTURE, "string"))


def empty_files(spark: SparkSession, names: list[str]) -> DataFrame:
    """Rejects for files without lines."""
    return spark.createDataFrame([(n, "empty_file") for n in names], "line string, reject_reason string")


def _read_alike(spark: SparkSession, files: list[str], id_prefix: str, multi_line: bool) -> tuple[DataFrame, DataFrame]:
    """Files with one header."""
    # File names come encoded as in an address.
    paths = [unquote(f) for f in files]
    reader = _options(spark.read).option("multiLine", multi_line)
    header = lower_case_columns(reader.option("inferSchema", False).csv(paths[0]).limit(0))
    require_columns(header, NAME, STRUCTURE)
    fields = [T.StructField(c, T.StringType()) for c in header.columns]
    reader = _options(spark.read).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE)
    # With pruned columns the parser would not see surplus fields.
    reader = reader.option("columnPruning", False).option("multiLine", multi_line)
    lines = reader.schema(T.StructType([*fields, T.StructField(_LINE, T.StringType())])).csv(paths)
    # Spark keeps the raw line only when the number of fields is off, in either direction.
    reason = (
        F.when(csv_field_count(F.col(_LINE)) > len(fields), F.lit("too_many_fields"))
        .when(F.col(NAME).isNull(), F.lit("missing_name"))
        .when(~F.col(NAME).startswith(id_prefix), F.lit("name_prefix"))
    )
    shown = F.coalesce(F.col(_LINE), F.concat_ws(",", *[F.col(f"`{f.name}`") for f in fields]))
    tagged = lines.withColumn("reject_reason", reason)
    good = tagged.filter("reject_reason IS NULL").select(F.col(NAME).alias("target_chembl_id"), STRUCTURE)
    rejects = tagged.filter("reject_reason IS NOT NULL").select(shown.alias("line"), "reject_reason")
    return good, rejects
