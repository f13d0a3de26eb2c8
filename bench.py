"""Time the headline queries and print one JSON line.

BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS and BENCH_QUERIES (names, or ``all``) override the
defaults. A query's time is the median of its runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from firmlens.plans import QUERIES

HEADLINE = [
    "rta_all_regions",
    "rta_share_of_firms",
    "firm_panel",
    "firm_category_unique",
    "category_cooccurrence",
    "survival_curve",
    "cond_probability",
    "jaccard_sources",
    "keyword_match",
    "firm_keywords",
    "clean_text",
    "group_text",
    "token_encode",
    "idf_words",
    "idf_contrast",
    "link_edges",
    "link_degrees",
    "similarity_matrix",
    "similarity_categories",
    "top_quantile",
    "llm_answers_parse",
    "run_summary",
]


def seconds(spark: SparkSession, name: str, sf: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = sorted(QUERIES) if wanted == "all" else wanted.split() or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("firmlens-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    times = {}
    for name in names:
        seconds(spark, name, sf)
        times[name] = round(statistics.median(seconds(spark, name, sf) for _ in range(runs)), 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
