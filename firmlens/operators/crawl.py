"""Quality of a crawl: errors, subpages, duration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.functions.sets import share
from firmlens.functions.text import parse_ctime


def error_percent(run: DataFrame) -> DataFrame:
    """Main pages per error, count and percent of all main pages."""
    main = run.filter(F.col("dl_rank") == 0)
    n_main = main.agg(F.count("*")).scalar()
    counted = main.groupBy("error").agg(F.count("*").alias("count"))
    percent = F.bround(share(F.col("count") * 100, n_main), 2)
    return counted.withColumn("percent", percent).orderBy(F.desc("count"), "error")


def subpage_counts(run: DataFrame) -> DataFrame:
    """Pages per firm besides the main one, among pages whose error is recorded."""
    counted = run.filter(F.col("error").isNotNull()).groupBy("id").agg((F.count("*") - 1).alias("count"))
    return counted.filter("count > 0")


def run_summary(run: DataFrame) -> DataFrame:
    """Start, end, duration in seconds, firms, and mean subpages in one row."""
    times = run.withColumn("at", parse_ctime(F.col("timestamp")))
    start, end = F.min("at"), F.max("at")
    mean = subpage_counts(run).agg(F.avg("count")).scalar()
    seconds = F.timestamp_diff("SECOND", F.col("start_time").cast("timestamp"), F.col("end_time").cast("timestamp"))
    return (
        times.agg(start.alias("start_time"), end.alias("end_time"), F.count_distinct("id").alias("n_companies"))
        .withColumn("seconds", seconds).withColumn("mean_subpages", mean)
    )


def top_errors(run: DataFrame, k: int = 5) -> DataFrame:
    return error_percent(run).limit(k)
