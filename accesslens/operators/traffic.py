"""Sizes, statuses, hosts, endpoints and days of a log table.

Every function takes a log table and returns a lazy DataFrame. Ties in a top-k
are broken by the key in ascending order, so results do not vary between runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslens.functions import fields
from accesslens.functions.patterns import UNKNOWN

OK = 200


def counted(logs: DataFrame, *keys: Column | str) -> DataFrame:
    """Rows per key. Counted before the shuffle, so a hot key stays one row a task."""
    return logs.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def most_frequent(counts: DataFrame, key: str, k: int | None = None) -> DataFrame:
    """Counts with the largest first, cut to the first ``k`` if that is given.

    With ``k`` no task sorts or holds more than its own first ``k`` rows.
    """
    ordered = counts.orderBy(F.desc("count"), F.asc(key))
    return ordered if k is None else ordered.limit(k)


# -- sizes ------------------------------------------------------------------


def content_size_stats(logs: DataFrame) -> DataFrame:
    """One row: minimum, maximum, mean, sample deviation and count of sizes."""
    size = F.col("content_size")
    return logs.agg(
        F.min(size).alias("min_content_size"),
        F.max(size).alias("max_content_size"),
        F.mean(size).alias("mean_content_size"),
        F.stddev_samp(size).alias("std_content_size"),
        F.count(size).alias("count_content_size"),
    )


def content_size_describe(logs: DataFrame) -> DataFrame:
    """The same five figures as rows: ``summary, content_size``."""
    size = F.col("content_size")
    figures = {
        "count": F.count(size),
        "mean": F.mean(size),
        "stddev": F.stddev_samp(size),
        "min": F.min(size),
        "max": F.max(size),
    }
    return logs.agg(
        *[f.cast("double").alias(name) for name, f in figures.items()]
    ).unpivot([], list(figures), "summary", "content_size")


# -- statuses ---------------------------------------------------------------


def status_frequency(logs: DataFrame) -> DataFrame:
    """Requests per status, in order of status."""
    return counted(logs, "status").orderBy("status")


def distinct_status_count(logs: DataFrame) -> DataFrame:
    """One row: how many different statuses there are, NULL counting as one."""
    return logs.select("status").distinct().agg(
        F.count(F.lit(1)).alias("distinct_statuses")
    )


def status_by_frequency(logs: DataFrame) -> DataFrame:
    """Requests per status, most frequent first."""
    return most_frequent(counted(logs, "status"), "status")


def status_chart_series(logs: DataFrame) -> DataFrame:
    """Requests per status ready for a bar chart: status as text, and the count."""
    return status_by_frequency(logs).select(
        F.col("status").cast("string").alias("status"), "count"
    )


# -- hosts and endpoints ----------------------------------------------------


def host_frequency(logs: DataFrame) -> DataFrame:
    """Requests of every host, most frequent first."""
    return most_frequent(counted(logs, "host"), "host")


def top_hosts(logs: DataFrame, k: int = 10) -> DataFrame:
    return most_frequent(counted(logs, "host"), "host", k)


def top_endpoints(logs: DataFrame, k: int = 10) -> DataFrame:
    return most_frequent(counted(logs, "endpoint"), "endpoint", k)


def top_ok_endpoints(logs: DataFrame, k: int = 10) -> DataFrame:
    """Most frequent endpoints among requests answered with 200."""
    return top_endpoints(logs.filter(F.col("status") == OK), k)


def top_error_endpoints(logs: DataFrame, k: int = 10) -> DataFrame:
    """Most frequent endpoints among requests with a status other than 200."""
    return top_endpoints(logs.filter(F.col("status") != OK), k)


def unique_hosts(logs: DataFrame) -> DataFrame:
    """Every host once."""
    return logs.select("host").distinct()


def unique_host_count(logs: DataFrame) -> DataFrame:
    """One row: number of different hosts."""
    return unique_hosts(logs).agg(F.count(F.lit(1)).alias("unique_hosts"))


def approx_unique_host_count(logs: DataFrame, rsd: float = 0.02) -> DataFrame:
    """One row: number of different hosts within about ``rsd``, with fixed memory.

    As in the exact count, requests without a host make one more.
    """
    without = F.coalesce(F.max(F.col("host").isNull()), F.lit(False)).cast("bigint")
    hosts = F.approx_count_distinct("host", rsd) + without
    return logs.agg(hosts.alias("unique_hosts"))


# -- days -------------------------------------------------------------------


def _with_day(logs: DataFrame, grain: str) -> DataFrame:
    return logs.select(fields.day("time", grain).alias("day"), "host")


def host_day_pairs(logs: DataFrame, grain: str = "day_of_month") -> DataFrame:
    """Every pair of a host and a day it was seen on, once."""
    return _with_day(logs, grain).select("host", "day").distinct()


def daily_unique_hosts(logs: DataFrame, grain: str = "day_of_month") -> DataFrame:
    """Different hosts per day; requests without a time make a NULL day.

    Spread over (host, day) first, so that a busy day is not one task's work.
    """
    return counted(host_day_pairs(logs, grain), "day").orderBy("day")


def daily_requests(logs: DataFrame, grain: str = "day_of_month") -> DataFrame:
    """Requests per day."""
    day = fields.day("time", grain).alias("day")
    totals = logs.groupBy(day).agg(F.count(F.lit(1)).alias("total_reqs"))
    return totals.orderBy("day")


def average_requests(host_days: DataFrame) -> DataFrame:
    """Requests, hosts and their ratio per day from ``host, day, requests`` rows.

    Rows without a day are left out by counting days: a filter on the day itself
    would be moved down to the lines, where the time is parsed for it once more.
    """
    return (
        host_days.groupBy("day")
        .agg(
            F.sum("requests").alias("total_reqs"), F.count("day").alias("total_hosts")
        )
        .filter(F.col("total_hosts") > 0)
        .withColumn("avg_reqs", F.col("total_reqs") / F.col("total_hosts"))
        .orderBy("day")
    )


def avg_daily_requests_per_host(
    logs: DataFrame, grain: str = "day_of_month"
) -> DataFrame:
    """Requests per host and day, for days that are known.

    Counting per (host, day) yields both totals of a day in one scan, where
    joining requests per day to hosts per day would need two.
    """
    per_host = (
        _with_day(logs, grain)
        .groupBy("day", "host")
        .agg(F.count(F.lit(1)).alias("requests"))
    )
    return average_requests(per_host)


def busiest_endpoint_by_weekday(logs: DataFrame) -> DataFrame:
    """For each known weekday, the endpoint requested most, with its count."""
    # Unknown weekdays count for nothing, and are left out by that rather than by
    # a filter that would be moved down to the lines and parse them once more.
    known = F.count_if(F.col("day_of_week") != UNKNOWN).alias("count")
    counts = logs.groupBy("day_of_week", "endpoint").agg(known)
    # An aggregate keeps one row per weekday and task, and needs no order.
    first = F.min(F.struct((-F.col("count")).alias("less"), "endpoint", "count"))
    best = counts.filter(F.col("count") > 0).groupBy("day_of_week").agg(first.alias("best"))
    return best.select("day_of_week", "best.endpoint", "best.count")


# -- SQL --------------------------------------------------------------------


def sql_over_logs(logs: DataFrame, query: str) -> DataFrame:
    """Result of a SQL query that names the log table ``{logs}``.

    No view is left behind, so queries over different tables do not clash.
    """
    return logs.sparkSession.sql(query, logs=logs)
