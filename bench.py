"""Time the headline queries; print one JSON line."""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from profilelake.plans import ingest
from profilelake.session import configure, fresh_path
from profilelake.sources import landing
from profilelake.sources.lake import fixture_store
from query_registry import LANDING, QUERIES, embedded, landing_zone

HEADLINE = [
    "aggregate_statistics", "aggregate_statistics_levels", "float_core_rollup", "build_floats",
    "dataset_metadata", "float_info", "float_profiles", "lookup_profile", "profile_data",
    "date_filter", "nearest_floats", "nearest_join", "trajectory", "depth_series", "ts_pairs",
    "compare_series", "scatter_pairs", "markers", "chart_spec", "profile_summary",
    "profile_metadata", "float_summary", "build_documents", "semantic_search", "hybrid_search",
    "search_all", "search_profiles", "document_filter", "ann_search", "check_tables",
    "upsert_profiles", "stream_ingest", "embed_documents", "filter_levels",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}

    # the whole ingest: read the landing files, clean, merge, roll up, write
    bronze = landing.scan_raw(spark, landing_zone(spark, sf_dir), LANDING)
    store = ingest.Store(spark, fresh_path(spark, "bench"))
    seconds["ingest"] = timed(lambda: ingest.ingest(store, bronze))
    profiles = store.read("profiles").count() + store.read("bgc_profiles").count()

    # tables the queries share are made before their times are taken
    fixture_store(spark, sf_dir)
    seconds["build_and_embed"] = timed(lambda: embedded(spark, sf_dir))
    for name in wanted:
        seconds[name] = timed(lambda: consume(QUERIES[name](spark, sf_dir)))
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in seconds.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "profiles_per_second": round(profiles / seconds["ingest"], 1),
    }))


if __name__ == "__main__":
    main()
