"""Monthly target files as a stream: every file that appears is handled once."""

from __future__ import annotations

import datetime
import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from simmart.functions.text import month_of_file
from simmart.schemas import ID_PREFIX
from simmart.sources.tables import finished
from simmart.sources.targets import empty_files, no_targets, read_targets

OnFile = Callable[[DataFrame, DataFrame, object], None]


def stream_targets(
    spark: SparkSession,
    directory: str,
    on_file: OnFile,
    checkpoint: str,
    id_prefix: str = ID_PREFIX,
    pattern: str = "data_*.csv",
    poll: str | None = None,
    multi_line: bool = False,
) -> StreamingQuery:
    """Call ``on_file(targets, rejects, month)`` for each new file; files are taken one per micro-batch.

    Without ``poll`` the query handles what is there and ends; with a poll interval such as ``"1 hour"`` it waits for
    more. Files are listed without being opened. One without content makes an empty batch; it is handed
    over with no targets, the reject ``(directory, empty_file)`` and no month, as the batch does not tell its name. The checkpoint remembers finished files. After a crash the last file may be handed over again, so the load
    behind ``on_file`` must be repeatable, as ``append_mart`` is with ``new_pairs``.
    """
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", 1)
        .load(directory)
        .select("path")
    )

    def handle(batch: DataFrame, batch_id: int) -> None:
        month = month_of_file(F.col("path")).alias("month")
        # One file per batch, so one row at most.
        files = batch.select("path", month).collect()
        if not files:
            on_file(no_targets(batch.sparkSession), empty_files(batch.sparkSession, [directory]), None)
        for path, first_day in files:
            targets, rejects = read_targets(batch.sparkSession, path, id_prefix, multi_line)
            on_file(targets, rejects, first_day)

    writer = arrivals.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=poll) if poll else writer.trigger(availableNow=True)
    return writer.start()


WAIT, POLL = 18 * 3600, 3600


class Arrival(NamedTuple):
    """The file of a month, or None when it did not come in time, and the seconds spent waiting."""

    path: str | None
    waited: float

    @property
    def gave_up(self) -> bool:
        return self.path is None


def await_month(
    spark: SparkSession,
    directory: str,
    month: datetime.date,
    timeout: float = WAIT,
    poll: float = POLL,
    name: str = "data_%m_%Y.csv",
    clock: Callable[[], float] = time.monotonic,
    sleep: Callable[[float], None] = time.sleep,
) -> Arrival:
    """Wait for the target file of one month, looking every ``poll`` seconds, at most ``timeout`` seconds in all.

    The last look is at the deadline. ``name`` is the file's name in the form of ``strftime`` and may hold wildcards;
    of several files the first by name counts. A folder that Spark writes counts when it is complete. A directory that is not there
    yet is waited for, too.
    """
    spot = spark._jvm.org.apache.hadoop.fs.Path(f"{directory.rstrip('/')}/{month.strftime(name)}")
    files = spot.getFileSystem(spark._jsc.hadoopConfiguration())
    start = clock()
    while True:
        for found in files.globStatus(spot) or ():
            path = found.getPath().toString()
            if found.isFile() or finished(spark, path):
                return Arrival(path, clock() - start)
        left = timeout - (clock() - start)
        if left <= 0:
            return Arrival(None, clock() - start)
        sleep(min(poll, left))


def month_targets(
    spark: SparkSession, directory: str, month: datetime.date, id_prefix: str = ID_PREFIX, multi_line: bool = False, **waiting
) -> tuple[Arrival, DataFrame, DataFrame]:
    """``await_month``, then targets and rejects of the file as ``read_targets`` gives them.

    An empty file is rejected by its name. When the wait was given up there are no targets and no rejects.
    """
    arrival = await_month(spark, directory, month, **waiting)
    if arrival.gave_up:
        return arrival, no_targets(spark), empty_files(spark, [])
    return arrival, *read_targets(spark, arrival.path, id_prefix, multi_line)
