import os
import sys

import pytest
from pyspark import cloudpickle

import simmart as sm
from tests.test_sources import Pages

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules[Pages.__module__])


def run(spark, folder, fetch, **options):
    options = {"limit": 10, "delay": 0, "max_requests": 3} | options
    query = sm.stream_pages(spark, fetch, "molecules", f"{folder}/kept", f"{folder}/done", **options)
    try:
        query.awaitTermination()
    finally:
        query.stop()


def ids(spark, folder, after=-1):
    items, _ = sm.read_streamed_pages(spark, f"{folder}/kept", "molecules", after=after)
    return sorted(int(r.molecule_chembl_id[6:]) for r in items.collect())


def test_only_new_items(spark, folder):
    assert ids(spark, folder) == []
    for total in (0, 23, 61):
        run(spark, folder, Pages(total))
        assert ids(spark, folder) == list(range(total))
    assert ids(spark, folder, after=1) == list(range(23, 61))  # the first run has a batch, too


def test_a_failed_batch_is_replayed(spark, folder):
    run(spark, folder, Pages(10))
    with pytest.raises(Exception, match="page 20"):
        run(spark, folder, Pages(40, {20: -1}), retries=2)
    assert ids(spark, folder) == list(range(10))
    # the batch of the failed run keeps its range, what came meanwhile is the next one
    run(spark, folder, Pages(55))
    assert ids(spark, folder) == list(range(40))
    run(spark, folder, Pages(55))
    assert ids(spark, folder) == list(range(55)) and ids(spark, folder, after=1) == list(range(40, 55))


def test_a_batch_that_was_written_but_not_committed(spark, folder):
    run(spark, folder, Pages(30))
    for name in os.listdir(f"{folder}/done/commits"):
        os.remove(f"{folder}/done/commits/{name}")
    for total in (42, 42):
        run(spark, folder, Pages(total))
    assert ids(spark, folder) == list(range(42))


def test_lost_pages_are_reported_once(spark, folder):
    run(spark, folder, Pages(35, {10: -1}), on_page_error="skip", retries=1)
    run(spark, folder, Pages(45), on_page_error="skip")
    items, lost = sm.read_streamed_pages(spark, f"{folder}/kept", "molecules")
    assert items.count() == 35 and [(r.offset, r.error) for r in lost.collect()] == [(10, "OSError: page 10")]


def test_a_collection_that_lost_items_stops_the_query(spark, folder):
    run(spark, folder, Pages(30))
    with pytest.raises(Exception, match="shrank from 30 to 20"):
        run(spark, folder, Pages(20))
    assert ids(spark, folder) == list(range(30))
