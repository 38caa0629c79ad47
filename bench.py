"""Benchmark: headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; one JSON line."""

from __future__ import annotations

import json
import os
import time

from millrace.plans import REGISTRY
from millrace.session import clear_scratch, local_session

HEADLINE = [
    "flagship_customer_activity", "q14_suite_rows", "q19_event_validation", "j01_left_join_totals", "j03_point_in_time", "a01_group_totals",
    "a13_latency_ranks", "w01_rolling_mean", "w02_average_rank", "w03_trailing_totals", "d01_numeric_profile", "d05_stability_index",
    "d06_two_sample_distance", "t01_character_chunks", "t06_exact_duplicates", "t07_personal_data", "t13_html_text", "v02_cosine_top_k",
    "v08_keyword_search", "v10_rank_fusion", "e01_e02_retrieval_metrics", "e07_auc", "g04_related_entities", "l02_histogram", "f01_materialise",
    "x03_query_analytics",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus=cpus, shuffle_partitions=cpus)
    spark.read.parquet(os.path.join(directory, "lineitem.parquet")).groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        REGISTRY[name](spark, directory).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    clear_scratch(spark)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
