"""Headline queries at one scale; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

import workload

HEADLINE = [
    "fingerprint_fold",
    "fingerprint_files",
    "top10_documents",
    "top10_embeddings",
    "pair_scores",
    "pairs_by_target",
    "tanimoto_native",
    "fact_build",
    "fact_new_pairs",
    "avg_similarity_per_source",
    "avg_property_deviation",
    "next_most_similar",
    "similarity_categories",
    "ingest_staging",
    "paged_json_scan",
    "pk_rejects",
    "neighborhood_features",
    "fingerprint_with",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # the given tables are one row group each
    workload.SPREAD = int(cpus)
    workload.QUERIES["top10_documents"](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        started = time.perf_counter()
        workload.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
        print(name, times[name], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
