"""Paged JSON collections: a Spark data source with a bound on requests at a time, and a reader for landed page files."""

from __future__ import annotations

import http.client
import json
import re
import sys
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from simmart.schemas import COLLECTIONS, MAX_REQUESTS, PAGE_SIZE
from simmart.session import empty, stage
from simmart.sources.tables import CODEC, finished_parts

# Executors run the classes below without having this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Fetcher = Callable[[int, int], dict]

PAGE_COLUMNS = "offset bigint, item string, error string"


class PageError(ValueError):
    """A page that came, but without its fields or with fewer items than the collection still has."""


# What a further try, or skipping the page, can answer. Anything else is an error of the program.
PAGE_FAILURES = (OSError, http.client.HTTPException, json.JSONDecodeError, PageError)


class RestFetcher:
    """GET ``base_url?limit=..&offset=..&params``; filters and column choice go to the server in ``params``."""

    def __init__(self, base_url: str, params: dict[str, str] | None = None, only: list[str] | None = None, timeout: float = 60):
        self.base_url = base_url
        self.params = dict(params or {}, **({"only": ",".join(only)} if only else {}))
        self.timeout = timeout

    def url(self, offset: int, limit: int) -> str:
        query = urllib.parse.urlencode({"limit": limit, "offset": offset, **self.params}, safe=",")
        return f"{self.base_url}?{query}"

    def __call__(self, offset: int, limit: int) -> dict:
        with urllib.request.urlopen(self.url(offset, limit), timeout=self.timeout) as response:
            return json.load(response)


class DirectoryFetcher:
    """Pages kept as files in a folder that all executors reach: a local path, ``file:``, ``hdfs:``, ``gs:`` or ``s3:``
    (also as ``s3a:`` or ``s3n:``).

    ``pattern`` names the page of an offset: a JSON file, or a folder with one data file as Spark writes it.
    """

    def __init__(self, directory: str, pattern: str = "page_{offset}.json"):
        # Spark's names for local and S3 folders are no URIs to Arrow.
        local = directory.removeprefix("file://").removeprefix("file:")
        self.directory = re.sub(r"^s3[an]://", "s3://", local).rstrip("/")
        self.pattern = pattern

    def __call__(self, offset: int, limit: int) -> dict:
        filesystem, path = pafs.FileSystem.from_uri(f"{self.directory}/{self.pattern.format(offset=offset)}")
        if filesystem.get_file_info(path).type == pafs.FileType.Directory:
            inside = filesystem.get_file_info(pafs.FileSelector(path))
            path = next(f.path for f in inside if not f.base_name.startswith(("_", ".")))
        with filesystem.open_input_stream(path) as stream:
            return json.loads(stream.read())


def fetch_with_retry(fetch: Callable, offset: int, limit: int, retries: int, delay: float):
    for attempt in range(1, retries + 1):
        try:
            return fetch(offset, limit)
        except PAGE_FAILURES:
            if attempt == retries:
                raise
            time.sleep(delay)
    raise ValueError("retries must be at least 1")


def _field(page: dict, name: str):
    try:
        return page[name]
    except (KeyError, TypeError):
        raise PageError(f"page without {name}") from None


def fetch_items(fetch: Fetcher, collection: str, offset: int, wanted: int) -> list:
    """``wanted`` items from ``offset`` on. A server that hands out fewer per page is asked again for the rest."""
    items: list = []
    while len(items) < wanted:
        more = _field(fetch(offset + len(items), wanted - len(items)), collection)
        if not more:
            raise PageError(f"{len(items)} of {wanted} items")
        items += more
    return items[:wanted]


class _Pages(InputPartition):
    def __init__(self, offsets: range, total: int):
        super().__init__(0)
        self.offsets, self.total = offsets, total


class _Pager:
    """What a scan and a stream share: the options, the number of items, and how a task reads its pages."""

    def __init__(self, fetch: Fetcher, options):
        self.fetch = fetch
        self.collection = options["collection"]
        self.limit = int(options.get("limit", PAGE_SIZE))
        self.retries = int(options.get("retries", 3))
        self.delay = float(options.get("delay", 5))
        self.max_requests = int(options.get("maxRequests", MAX_REQUESTS))
        self.on_page_error = options.get("onPageError", "fail")
        if self.on_page_error not in ("fail", "skip"):
            raise ValueError("onPageError is 'fail' or 'skip'")

    def total(self, limit: int) -> int:
        first = fetch_with_retry(self.fetch, 0, limit, self.retries, self.delay)
        return int(_field(_field(first, "page_meta"), "total_count"))

    def deal(self, pages: range) -> list[_Pages]:
        """Pages dealt to tasks, whose number bounds the requests at a time."""
        tasks = min(self.max_requests, len(pages))
        return [_Pages(pages[i::tasks], pages.stop) for i in range(tasks)]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        again = partial(fetch_items, self.fetch, self.collection)
        for offset in partition.offsets:
            wanted, error = min(self.limit, partition.total - offset), None
            try:
                items = fetch_with_retry(again, offset, wanted, self.retries, self.delay)
                items = [json.dumps(item, ensure_ascii=False) for item in items]
            except PAGE_FAILURES as e:
                if self.on_page_error == "fail":
                    raise
                items, error = [None], f"{type(e).__name__}: {e}"
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([offset] * len(items), pa.int64()),
                    pa.array(items, pa.string()),
                    pa.array([error] * len(items), pa.string()),
                ],
                names=["offset", "item", "error"],
            )


class _PageReader(_Pager, DataSourceReader):
    def partitions(self):
        """The first page tells how many items there are; the items are read by the tasks."""
        return self.deal(range(0, self.total(self.limit), self.limit)) or [_Pages(range(0), 0)]


class _PageStream(_Pager, DataSourceStreamReader):
    """The offset is a number of items, so a batch is what a collection has grown by, and a replay asks for the same
    items again."""

    def initialOffset(self):
        return {"items": 0}

    def latestOffset(self):
        return {"items": self.total(1)}

    def partitions(self, start, end):
        if end["items"] < start["items"]:
            raise ValueError(f"the collection shrank from {start['items']} to {end['items']} items: start a new checkpoint")
        return self.deal(range(start["items"], end["items"], self.limit))


def register_paged_source(spark: SparkSession, fetch: Fetcher, name: str = "paged_json") -> None:
    """Make ``spark.read.format(name)`` and ``spark.readStream.format(name)`` read pages through ``fetch(offset, limit) -> page``."""

    class PagedJson(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return PAGE_COLUMNS

        def reader(self, schema):
            return _PageReader(fetch, self.options)

        def streamReader(self, schema):
            return _PageStream(fetch, self.options)

    spark.dataSource.register(PagedJson)


def read_pages(
    spark: SparkSession,
    fetch: Fetcher,
    collection: str,
    item_schema: T.StructType | None = None,
    limit: int = PAGE_SIZE,
    retries: int = 3,
    delay: float = 5,
    max_requests: int = MAX_REQUESTS,
    on_page_error: str = "fail",
    store: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Typed items of a collection, and the pages that could not be read with their error.

    Every item that the first page announces arrives, or its page is reported: a page with too few items is completed
    by further requests, and one without the rest is an error. At most ``max_requests`` requests run at a time. With
    ``on_page_error="skip"`` a page that fails ``retries`` times becomes a row of the second frame.

    The pages are fetched once, now, and kept in the scratch folder. With ``store=False`` every action on either frame
    fetches them again.
    """
    register_paged_source(spark, fetch)
    options = {
        "collection": collection,
        "limit": limit,
        "retries": retries,
        "delay": delay,
        "maxRequests": max_requests,
        "onPageError": on_page_error,
    }
    rows = spark.read.format("paged_json").options(**options).load()
    if store:
        rows = stage(rows, "pages")
    return decode_items(rows, item_schema or COLLECTIONS[collection])


def stream_pages(
    spark: SparkSession,
    fetch: Fetcher,
    collection: str,
    directory: str,
    checkpoint: str,
    limit: int = PAGE_SIZE,
    retries: int = 3,
    delay: float = 5,
    max_requests: int = MAX_REQUESTS,
    on_page_error: str = "fail",
    poll: str | None = None,
) -> StreamingQuery:
    """Keep a folder up with a collection that grows at its end: each run fetches only the items it has not seen.

    Without ``poll`` the query takes what is there and ends; with an interval such as ``"1 hour"`` it goes on. A batch is a
    range of items and is written to a folder of its own, so one that died and is run again replaces what it left:
    every item is kept once. A run without ``poll`` that has such a batch to repeat ends with it; the next one takes what
    came meanwhile. A page that stays unreadable stops the query, which asks for it again when it is started
    anew; with ``on_page_error="skip"`` it is reported and not asked for again. A collection that lost items stops the
    query, as places in it no longer mean the same. ``directory`` and ``checkpoint`` belong together.
    """
    register_paged_source(spark, fetch)
    options = {
        "collection": collection,
        "limit": limit,
        "retries": retries,
        "delay": delay,
        "maxRequests": max_requests,
        "onPageError": on_page_error,
    }

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("compression", CODEC).parquet(f"{directory}/batch={batch_id}")

    writer = spark.readStream.format("paged_json").options(**options).load().writeStream.foreachBatch(keep)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=poll) if poll else writer.trigger(availableNow=True)
    return writer.start()


def read_streamed_pages(
    spark: SparkSession, directory: str, collection: str, item_schema: T.StructType | None = None, after: int = -1
) -> tuple[DataFrame, DataFrame]:
    """Items and lost pages that ``stream_pages`` has kept so far, or only those of batches above ``after``."""
    batches = [n for n in finished_parts(spark, directory, "batch") if n > after]
    folders = [f"{directory}/batch={n}" for n in batches]
    rows = spark.read.schema(PAGE_COLUMNS).parquet(*folders) if folders else empty(spark, T.StructType.fromDDL(PAGE_COLUMNS))
    return decode_items(rows, item_schema or COLLECTIONS[collection])


def decode_items(rows: DataFrame, item_schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Split raw page rows into typed items and unreadable pages."""
    # A generator: filters on the fields stay above it, and each item is parsed once.
    items = rows.filter("item IS NOT NULL").select(F.inline(F.array(F.from_json("item", item_schema))))
    return items, rows.filter("error IS NOT NULL").select("offset", "error")


def read_landed_pages(
    spark: SparkSession,
    path: str,
    collection: str,
    item_schema: T.StructType | None = None,
    one_page_per_line: bool = False,
) -> DataFrame:
    """Typed items of page files that are already in storage."""
    items = T.ArrayType(item_schema or COLLECTIONS[collection])
    page = T.StructType([T.StructField(collection, items)])
    pages = spark.read.schema(page).json(path, multiLine=not one_page_per_line)
    return pages.select(F.explode(collection).alias("i")).select("i.*")
