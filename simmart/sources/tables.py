"""Stored tables: scans, full refresh, append, fingerprint files, per-target score files.

A location is a table name, or a path when it contains a slash.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simmart.functions.packing import stored_form
from simmart.operators.fingerprint import require_columns
from simmart.schemas import N_BITS, ROWS_PER_FILE
from simmart.session import empty, stage
from simmart.sources.buckets import CODEC, bucket_spec, bucketed

# Between the name of a folder and that of a version of its rows beside it.
VERSION = "__rows_"
PAIR_COLUMNS = "chembl_id string, tanimoto_similarity_score double, target_chembl_id string"


def is_path(location: str) -> bool:
    return "/" in location


def read_table(spark: SparkSession, location: str, schema: T.StructType | None = None) -> DataFrame:
    if not is_path(location):
        return spark.table(location)
    return (spark.read.schema(schema) if schema else spark.read).parquet(location)


def table_or_empty(spark: SparkSession, location: str, schema: T.StructType) -> DataFrame:
    """A stored table, or no rows when nothing has been stored yet."""
    if is_path(location):
        try:
            return spark.read.schema(schema).parquet(location)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    elif spark.catalog.tableExists(location):
        return spark.table(location)
    return empty(spark, schema)


def read_structures(
    spark: SparkSession, location: str | None = None, jdbc: dict[str, str] | None = None
) -> DataFrame:
    """``(chembl_id, canonical_smiles)`` of the whole staging table, from storage or from a database.

    For a database pass the options of Spark's JDBC source; with ``partitionColumn``, ``lowerBound``, ``upperBound``
    and ``numPartitions`` it is read in parallel.
    """
    source = spark.read.format("jdbc").options(**jdbc).load() if jdbc else read_table(spark, location)
    require_columns(source, "chembl_id", "canonical_smiles")
    return source.select("chembl_id", "canonical_smiles")


def scan_fingerprints(spark: SparkSession, directory: str) -> DataFrame:
    """Fingerprints of every parquet file below a directory; other files and columns are left alone.

    ``(chembl_id, morgan_fingerprint)`` with 0/1 text, or ``(chembl_id, words, pop)``, whichever was written.
    """
    reader = spark.read.option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    files = reader.parquet(directory)
    if "words" in files.columns:
        return files.select("chembl_id", "words", *(c for c in files.columns if c == "pop"))
    return files.select("chembl_id", "morgan_fingerprint")


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a Spark job has written this folder to the end."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def finished_parts(spark: SparkSession, directory: str, key: str) -> list[int]:
    """Numbers n of the folders ``key=n`` that a Spark job has written to the end, in order."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(directory)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    numbers = sorted(int(name.removeprefix(f"{key}=")) for name in names if name.startswith(f"{key}="))
    return [n for n in numbers if finished(spark, f"{directory}/{key}={n}")]


def append_table(df: DataFrame, location: str) -> None:
    """Add rows to a path or table, which appears with the first ones; a table in buckets gets files in their buckets only."""
    spark = df.sparkSession
    if is_path(location):
        df.write.mode("append").option("compression", CODEC).parquet(location)
        return
    spec = bucket_spec(spark, location) if spark.catalog.tableExists(location) else None
    writer = bucketed(df, *spec) if spec else df.write.option("compression", CODEC)
    writer.mode("append").saveAsTable(location)


def refresh_table(df: DataFrame, location: str) -> None:
    """Replace the whole content, so that a job that dies leaves the old one; ``df`` may read from the same location.

    The new rows are written beside the old ones first. A table of the same columns is then pointed to them, a single
    change of the catalog: a reader finds the old rows or the new ones. The rows before the last refresh are kept for
    readers that have started, older ones are deleted. A path is replaced by two renames of folders; a reader between
    them finds no folder, and if the job dies just there, the next refresh puts the old one back before it begins.
    A table of other columns, or one with partitions, is overwritten in place. Buckets stay as they are.
    """
    spark = df.sparkSession
    if is_path(location):
        _replace_folder(df, location.rstrip("/"))
        return
    exists = spark.catalog.tableExists(location)
    spec = bucket_spec(spark, location) if exists else None
    if not exists or spark.table(location).schema.simpleString() != df.schema.simpleString() or _has_partitions(spark, location):
        writer = bucketed(df, *spec) if spec else df.write.option("compression", CODEC)
        writer.mode("overwrite").saveAsTable(location)
        return
    old = spark.sql(f"DESCRIBE TABLE EXTENDED {location}").filter("col_name = 'Location'").first()["data_type"].rstrip("/")
    base = old.split(VERSION)[0]
    new = f"{base}{VERSION}{uuid.uuid4().hex}"
    if spec:
        # files in buckets are written through a table only; dropping it leaves its files, since their place was given
        helper = f"{location}_{uuid.uuid4().hex}"
        bucketed(df, *spec).option("path", new).saveAsTable(helper)
        spark.sql(f"DROP TABLE {helper}")
    else:
        df.write.option("compression", CODEC).parquet(new)
    spark.sql(f"ALTER TABLE {location} SET LOCATION '{new}'")
    spark.catalog.refreshTable(location)
    for other in _beside(spark, base):
        if other.split("/")[-1] not in (old.split("/")[-1], new.split("/")[-1]):
            _folder(spark, other)[1].delete(_folder(spark, other)[0], True)


def _has_partitions(spark: SparkSession, table: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(table))


def _folder(spark: SparkSession, path: str):
    """Path and file system as Hadoop knows them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _beside(spark: SparkSession, base: str) -> list[str]:
    """The folder itself and its versions."""
    folder, files = _folder(spark, base)
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{base}{VERSION}*")) or ()
    return ([base] if files.exists(folder) else []) + [status.getPath().toString() for status in found]


def _replace_folder(df: DataFrame, path: str) -> None:
    spark = df.sparkSession
    there, files = _folder(spark, path)
    before = _folder(spark, f"{path}{VERSION}before")[0]
    new = f"{path}{VERSION}{uuid.uuid4().hex}"
    if not files.exists(there) and files.exists(before):
        _rename(files, before, there)
    df.write.option("compression", CODEC).parquet(new)
    if files.exists(there):
        files.delete(before, True)
        _rename(files, there, before)
    _rename(files, _folder(spark, new)[0], there)


def _rename(files, old, new) -> None:
    if not files.rename(old, new):
        raise OSError(f"cannot rename {old.toString()} to {new.toString()}")


def write_fingerprints(
    fps: DataFrame, directory: str, rows_per_file: int = ROWS_PER_FILE, n_bits: int = N_BITS, layout: str = "text"
) -> None:
    """Store ``(chembl_id, on, pop)`` as files for ``scan_fingerprints``.

    ``text`` keeps a ``0``/``1`` string, the form for exchange. ``words`` keeps 64 bits per number: an eighth of the
    bytes to decode and to hand to Python, the form for large tables; it also keeps ``pop``, the number of on-bits.
    Rows are ordered by it within each task, so a batch of a later scan holds a narrow range of on-bit counts, most
    targets skip most batches, and a filter on ``pop`` skips row groups.
    """
    (
        stored_form(fps.sortWithinPartitions("pop"), layout, n_bits)
        .write.mode("overwrite")
        .option("compression", CODEC)
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(directory)
    )


def write_pairs(pairs: DataFrame, directory: str) -> None:
    """Store all scores in one folder per target; folders of targets that are not in ``pairs`` stay as they are.

    The rebalance lets Spark split a large target over several files and join small ones in one task.
    """
    (
        pairs.filter("target_chembl_id IS NOT NULL")
        .hint("rebalance", "target_chembl_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .partitionBy("target_chembl_id")
        .parquet(directory)
    )


def read_pairs(spark: SparkSession, directory: str) -> DataFrame:
    """Scores stored by ``write_pairs``; a filter on the target reads only its folder."""
    return spark.read.schema(PAIR_COLUMNS).parquet(directory)


def write_pair_buckets(pairs: DataFrame, directory: str, buckets: int = 256) -> None:
    """Store all scores in ``buckets`` folders by a hash of the target, for more targets than one can have folders.

    Targets in ``pairs`` replace what is stored of them, all others stay: a bucket with new targets is written anew with
    the old rows of its other targets, the rest is not touched. Rows are sorted by target and files carry a bloom
    filter on it, so a lookup reads one folder and few row groups of it. The number of buckets is part of the folders'
    names; a store keeps the number it began with. One writer at a time. One that died before Spark puts the new folders in
    place is run again; where it dies while doing so, a bucket may lack other targets, whose rows are then still in the
    scratch folder.
    """
    spark = pairs.sparkSession
    folder, files = _folder(spark, directory)
    names = [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []
    if any(name.startswith("of=") and name != f"of={buckets}" for name in names):
        raise ValueError(f"{directory} is stored in another number of buckets: {sorted(names)}")
    keyed = pairs.filter("target_chembl_id IS NOT NULL").select(*_bucketed(F.lit(buckets)))
    rows = keyed
    if names:
        # read three times; the first rows of a store are not
        rows = keyed = stage(keyed, "pairs")
        new = keyed.select("target_chembl_id").distinct()
        touched = keyed.select("bucket").distinct()
        # at most ``buckets`` rows
        old = _stored_pairs(spark, directory).join(F.broadcast(touched), "bucket", "left_semi")
        old = old.join(new, "target_chembl_id", "left_anti")
        rows = rows.unionByName(stage(old.select(*keyed.columns), "kept"))
    (
        rows.hint("rebalance", "bucket")
        .sortWithinPartitions("of", "bucket", "target_chembl_id")  # as the folders, which are then not sorted for again
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .option("parquet.bloom.filter.enabled#target_chembl_id", "true")
        .partitionBy("of", "bucket")
        .parquet(directory)
    )


def _bucketed(count: Column) -> list[Column]:
    bucket = F.pmod(F.xxhash64("target_chembl_id"), count).cast("int").alias("bucket")
    return ["chembl_id", "tanimoto_similarity_score", "target_chembl_id", count.alias("of"), bucket]


def _stored_pairs(spark: SparkSession, directory: str) -> DataFrame:
    return spark.read.schema(f"{PAIR_COLUMNS}, of int, bucket int").parquet(directory)


def read_pair_buckets(spark: SparkSession, directory: str, target: str | None = None) -> DataFrame:
    """Scores stored by ``write_pair_buckets``, of all targets or of one, whose folder alone is read."""
    rows = _stored_pairs(spark, directory)
    if target is not None:
        mine = F.pmod(F.xxhash64(F.lit(target)), F.col("of")) == F.col("bucket")
        rows = rows.filter(mine & (F.col("target_chembl_id") == target))
    return rows.drop("of", "bucket")


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row count that is filled in by whichever action runs it: no extra pass."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
