"""Results of several batches rolled up from the finished results of each.

These give what adding up the stored result tables gives. That is right for
counts per status, day, hour and for 404s per endpoint or host; but a sum of
per-batch top-k lists misses what was in none of them, and hosts seen in several
batches count several times. ``accesslens.plans.partials`` has the right answers
to those questions.

Rows without a key are left out, and a sum of nothing is 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.operators.traffic import most_frequent
from accesslens.sources.tables import read_committed


def _total(column: str):
    return F.coalesce(F.sum(column), F.lit(0).cast("bigint")).alias(column)


def _sum_by(rows: DataFrame, key: str, *values: str) -> DataFrame:
    rows = rows.filter(F.col(key).isNotNull())
    return rows.groupBy(key).agg(*[_total(v) for v in values or ("count",)])


def _frequent(
    spark: SparkSession, root: str, table: str, key: str, k: int | None = None
) -> DataFrame:
    return most_frequent(_sum_by(read_committed(spark, root, table), key), key, k)


def missing_values(spark: SparkSession, root: str) -> DataFrame:
    rows = read_committed(spark, root, "missing_values").drop("batch_id")
    return rows.agg(*[_total(c) for c in rows.columns])


def content_size_per_batch(spark: SparkSession, root: str) -> DataFrame:
    """The statistics of every batch, side by side."""
    return read_committed(spark, root, "content_size_summary")


def status(spark: SparkSession, root: str) -> DataFrame:
    return _frequent(spark, root, "http_status", "status")


def hosts(spark: SparkSession, root: str, k: int = 5) -> DataFrame:
    """Approximate: a host counts in the batches in which it was among the first ten."""
    return _frequent(spark, root, "frequent_hosts", "host", k)


def endpoints(spark: SparkSession, root: str, k: int = 20) -> DataFrame:
    """Approximate: an endpoint counts in batches in which it was among the first."""
    return _frequent(spark, root, "frequent_endPoints", "endpoint", k)


def error_endpoints(spark: SparkSession, root: str, k: int = 10) -> DataFrame:
    """Approximate: an endpoint counts in batches in which it was among the first."""
    return _frequent(spark, root, "error_endpoints", "endpoint", k)


def unique_hosts(spark: SparkSession, root: str) -> DataFrame:
    """Too high: hosts of each batch, added up over batches."""
    return read_committed(spark, root, "unique_hosts").agg(F.count("host").alias("host"))


def daily_hosts(spark: SparkSession, root: str) -> DataFrame:
    """Too high: a host counts once for each batch of a day."""
    rows = read_committed(spark, root, "unique_daily_hosts")
    return _sum_by(rows, "day").orderBy("day")


def avg_daily(spark: SparkSession, root: str) -> DataFrame:
    """Too low, as its numbers of hosts are too high."""
    rows = read_committed(spark, root, "avg_daily_reqests_per_host")
    totals = _sum_by(rows, "day", "total_reqs", "total_hosts")
    ratio = F.col("total_reqs") / F.col("total_hosts")
    return totals.withColumn("avg_reqs", ratio).orderBy("day")


def not_found_endpoints(spark: SparkSession, root: str, k: int = 20) -> DataFrame:
    return _frequent(spark, root, "endpoints_404_count", "endpoint", k)


def not_found_hosts(spark: SparkSession, root: str, k: int = 20) -> DataFrame:
    return _frequent(spark, root, "hosts_404_count_df", "host", k)


def not_found_days(spark: SparkSession, root: str) -> DataFrame:
    rows = read_committed(spark, root, "errors_by_date_sorted")
    return _sum_by(rows, "day").orderBy("day")


def not_found_hours(spark: SparkSession, root: str) -> DataFrame:
    rows = read_committed(spark, root, "hourly_avg_errors_sorted")
    return _sum_by(rows, "hour").orderBy("hour")
