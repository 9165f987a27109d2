"""All batch analyses from counts that take two scans of the logs.

One aggregates per date, hour and status: sizes, missing values and what is asked by status or time. The
other has the three groupings with many groups in one pass of ``GROUPING SETS``: endpoints by
weekday, hosts by date and endpoints by status. Both are counted before they are shuffled, so
a key with most of the rows is one row a task. The counts are written, and every analysis
is made of them, with the columns and in the order of ``plans.report``.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.functions import fields
from accesslens.functions.patterns import UNKNOWN
from accesslens.operators import quality
from accesslens.operators.not_found import NOT_FOUND
from accesslens.operators.traffic import OK, average_requests, counted, most_frequent
from accesslens.plans import partials

HOURS, GROUPS = "hours", "groups"
#: Groupings of the second scan, by the value of ``part``.
SETS = {
    "weekdays": ("day_of_week", "endpoint"),
    "host_days": ("date", "host"),
    "endpoints": ("endpoint", "status"),
}
GROUPS_SCHEMA = (
    "day_of_week string, endpoint string, date date, host string, status int,"
    " requests bigint, valid bigint, not_found bigint, part string"
)
INCOMPLETE = "incomplete"


def count_hours(logs: DataFrame) -> DataFrame:
    """Requests, sizes, missing values and incomplete rows per date, hour and status."""
    incomplete = reduce(or_, [quality.missing(logs, c) for c in quality.REQUIRED])
    return partials.count_hours(logs, F.count_if(incomplete).alias(INCOMPLETE))


def count_groups(logs: DataFrame) -> DataFrame:
    """``part``, the keys of its grouping, and how many requests, with a status, and 404s."""
    rows = logs.withColumn("date", F.col("time").cast("date"))
    keys = list(dict.fromkeys(key for of_set in SETS.values() for key in of_set))
    # a key that is part of a grouping has the bit 0
    bits = {
        name: sum(1 << (len(keys) - 1 - i) for i, key in enumerate(keys) if key not in of_set)
        for name, of_set in SETS.items()
    }
    status = F.col("status")
    rows = rows.select(*keys, status.alias("answer"))
    answer = F.col("answer")
    grouped = rows.groupingSets([list(of_set) for of_set in SETS.values()], *keys).agg(
        F.grouping_id().alias("part"),
        F.count(F.lit(1)).alias("requests"),
        F.count(answer).alias("valid"),
        F.count_if(answer == NOT_FOUND).alias("not_found"),
    )
    names = F.create_map(*[F.lit(x) for name, bit in bits.items() for x in (bit, name)])
    part = F.element_at(names, F.col("part").cast("int"))
    return grouped.select(part.alias("part"), *keys, "requests", "valid", "not_found")


def write_counts(logs: DataFrame, root: str) -> None:
    """Write both tables of counts below ``root``, in place of what was there."""
    count_hours(logs).write.mode("overwrite").parquet(f"{root}/{HOURS}")
    groups = count_groups(logs).hint("rebalance", "part")
    groups.write.mode("overwrite").partitionBy("part").parquet(f"{root}/{GROUPS}")


def _total(rows: DataFrame, *keys, value: str = "requests") -> DataFrame:
    totals = rows.groupBy(*keys).agg(F.sum(value).alias("count"))
    return totals.filter(F.col("count") > 0)


def _whole(rows: DataFrame, value: str, name: str) -> DataFrame:
    return rows.agg(F.coalesce(F.sum(value), F.lit(0)).cast("bigint").alias(name))


def _filled(hours: DataFrame) -> DataFrame:
    """Counts of sizes with missing ones as 0."""
    some = F.col("requests") > F.col("sized")
    low, high = F.coalesce("size_min", F.lit(0)), F.coalesce("size_max", F.lit(0))
    zero = F.lit(0).cast("decimal(38,0)")
    return hours.withColumns(
        {
            "sized": F.col("requests"),
            "size_sum": F.coalesce("size_sum", zero),
            "size_squares": F.coalesce("size_squares", zero),
            "size_min": F.when(some, F.least(low, F.lit(0))).otherwise(F.col("size_min")),
            "size_max": F.when(some, F.greatest(high, F.lit(0))).otherwise(F.col("size_max")),
        }
    )


def report_of_counts(spark: SparkSession, root: str, columns: list[str]) -> dict[str, DataFrame]:
    """All analyses of ``plans.report`` by name, from counts; ``columns`` are the log table's."""
    hours = spark.read.parquet(f"{root}/{HOURS}")
    groups = spark.read.schema(GROUPS_SCHEMA).parquet(f"{root}/{GROUPS}")

    def part(name: str, *values: str) -> DataFrame:
        return groups.filter(F.col("part") == name).select(*SETS[name], *values)

    weekdays = part("weekdays", "valid", "not_found")
    host_days = part("host_days", "valid", "not_found")
    endpoints = part("endpoints", "requests")
    valid = hours.filter(F.col("status").isNotNull())
    missed = hours.filter(F.col("status") == NOT_FOUND)
    sizes = partials.content_sizes(partials.Partials(_filled(valid), host_days, endpoints))
    sizes = sizes.withColumn("count_content_size", F.coalesce("count_content_size", F.lit(0)))
    figures = {
        "count": "count_content_size", "mean": "mean_content_size",
        "stddev": "std_content_size", "min": "min_content_size", "max": "max_content_size",
    }
    described = sizes.select(*[F.col(c).cast("double").alias(n) for n, c in figures.items()])
    day = fields.day("date").alias("day")
    seen = host_days.filter(F.col("valid") > 0)
    by_host = seen.groupBy(day, "host").agg(F.sum("valid").alias("requests"))
    known = weekdays.filter((F.col("valid") > 0) & (F.col("day_of_week") != UNKNOWN))
    first = F.min(F.struct((-F.col("valid")).alias("less"), "endpoint", "valid")).alias("best")
    missing = [c for c in hours.columns if c.startswith(partials.MISSING)]
    by_day = _total(missed, day).orderBy("day")
    weekday_404 = most_frequent(_total(weekdays, "day_of_week", value="not_found"), "day_of_week")

    def top(rows: DataFrame, key: str, k: int | None, value: str = "requests") -> DataFrame:
        return most_frequent(_total(rows, key, value=value), key, k)

    return {
        "missing_values": hours.agg(
            *[
                F.coalesce(F.sum(c), F.lit(0)).alias(c.removeprefix(partials.MISSING))
                for c in missing
            ]
        ),
        "incomplete_rows": _whole(hours, INCOMPLETE, "incomplete_rows"),
        "shape": _whole(valid, "requests", "rows").withColumn("columns", F.lit(len(columns))),
        "content_size_describe": described.unpivot([], list(figures), "summary", "content_size"),
        "content_size_stats": sizes,
        "status_frequency": _total(valid, "status").orderBy("status"),
        "distinct_statuses": _total(valid, "status").agg(
            F.count(F.lit(1)).alias("distinct_statuses")
        ),
        "status_by_frequency": top(valid, "status", None),
        "top_ok_endpoints": top(endpoints.filter(F.col("status") == OK), "endpoint", 10),
        "host_frequency": top(host_days, "host", None, "valid"),
        "top_endpoints": top(endpoints.filter(F.col("status").isNotNull()), "endpoint", 10),
        "top_error_endpoints": top(endpoints.filter(F.col("status") != OK), "endpoint", 10),
        "unique_hosts": seen.select("host").distinct().agg(
            F.count(F.lit(1)).alias("unique_hosts")
        ),
        "daily_unique_hosts": counted(by_host, "day").orderBy("day"),
        "avg_daily_requests_per_host": average_requests(by_host),
        "not_found_total": _whole(missed, "requests", "not_found"),
        "top_not_found_endpoints": top(
            endpoints.filter(F.col("status") == NOT_FOUND), "endpoint", 20
        ),
        "top_not_found_hosts": top(host_days, "host", 20, "not_found"),
        "not_found_by_day": by_day,
        "top_not_found_days": most_frequent(by_day, "day", 3),
        "not_found_by_hour": _total(missed, "hour").orderBy("hour"),
        "busiest_endpoint_by_weekday": known.groupBy("day_of_week").agg(first).select(
            "day_of_week", "best.endpoint", F.col("best.valid").alias("count")
        ),
        "not_found_by_weekday": weekday_404.select(
            "day_of_week", F.lit(NOT_FOUND).alias("status"), "count"
        ),
    }


def write_report(logs: DataFrame, root: str) -> dict[str, DataFrame]:
    """Count the logs below ``root``; returns the lazy analyses of the counts."""
    write_counts(logs, root)
    return report_of_counts(logs.sparkSession, root, quality.field_names(logs))
