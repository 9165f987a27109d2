"""Counts that add up.

A batch of logs is reduced to three tables of counts. Rows of several batches
can simply be put together, so every result below is right for one batch, for
any choice of batches and for all of them: totals, top-k lists, distinct hosts,
means and deviations. What merging finished results would get wrong (a host in
no batch's top ten, one counted in every batch) cannot happen.

``hours``      per date, hour and status: requests, size moments, missing values
``host_days``  per date and host: requests and 404s
``endpoints``  per endpoint and status: requests
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, fields as members

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.functions import fields
from accesslens.operators import quality
from accesslens.operators.not_found import NOT_FOUND
from accesslens.operators.traffic import OK, average_requests, counted, most_frequent
from accesslens.sources.commits import Snapshot, snapshot
from accesslens.sources.tables import compact, read_batch, read_snapshot, write_batch

# Sums of sizes and of their squares are exact: decimals hold 10^12 squares of sizes up to
# 10^13 without rounding.
_EXACT = "decimal(38,0)"
_SIZE = "decimal(19,0)"
MISSING = "missing_"


#: What the counts of each table are by.
KEYS = {
    "hours": ("date", "hour", "status"),
    "host_days": ("date", "host"),
    "endpoints": ("endpoint", "status"),
}


@dataclass(frozen=True)
class Partials:
    hours: DataFrame
    host_days: DataFrame
    endpoints: DataFrame


def count_hours(logs: DataFrame, *others: Column) -> DataFrame:
    """Requests, size moments and missing values per date, hour and status, and ``others``."""
    date = F.col("time").cast("date").alias("date")
    size = F.col("content_size")
    square = size.cast(_SIZE) * size.cast(_SIZE)
    return logs.groupBy(date, fields.hour("time").alias("hour"), "status").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count(size).alias("sized"),
        F.sum(size.cast(_SIZE)).alias("size_sum"),
        F.sum(square.cast(_EXACT)).alias("size_squares"),
        F.min(size).alias("size_min"),
        F.max(size).alias("size_max"),
        *[F.count_if(missing).alias(MISSING + c) for c, missing in _misses(logs)],
        *others,
    )


def partial_counts(logs: DataFrame) -> Partials:
    """The three tables of counts of a log table, each reading only its columns."""
    date = F.col("time").cast("date").alias("date")
    requests = F.count(F.lit(1)).alias("requests")
    host_days = logs.groupBy(date, "host").agg(
        requests, F.count_if(F.col("status") == NOT_FOUND).alias("not_found")
    )
    endpoints = logs.groupBy("endpoint", "status").agg(requests)
    return Partials(count_hours(logs), host_days, endpoints)


def _misses(logs: DataFrame) -> list[tuple[str, Column]]:
    """For each field, whether a row misses it: from a flag, if there is one."""
    flagged = [c.removeprefix(MISSING) for c in logs.columns if c.startswith(MISSING)]
    return [(c, F.col(MISSING + c)) for c in flagged] or [
        (c, quality.missing(logs, c)) for c in quality.field_names(logs)
    ]


def narrow(logs: DataFrame) -> DataFrame:
    """What ``partial_counts`` reads of a log table: five fields, and which are missing."""
    flags = [missing.alias(MISSING + c) for c, missing in _misses(logs)]
    return logs.select("time", "host", "endpoint", "status", "content_size", *flags)


def write_partials(
    spark: SparkSession, partials: Partials, root: str, batch_id: int
) -> Partials:
    """Write the counts of a batch; returns them as written, not to be redone.

    The three are computed at the same time.
    """

    def write(name: str) -> DataFrame:
        counts = getattr(partials, name)
        write_batch(counts, root, name, batch_id)
        return read_batch(spark, root, name, batch_id, counts.schema)

    names = [member.name for member in members(Partials)]
    with ThreadPoolExecutor(len(names)) as pool:
        return Partials(*pool.map(inheritable_thread_target(spark)(write), names))


def read_partials(spark: SparkSession, root: str, now: Snapshot | None = None) -> Partials:
    """Counts of all committed batches; the three tables are of one snapshot.

    By default that of now, from ``commits.snapshot``.
    """
    now = now or snapshot(spark, root)
    return Partials(*[read_snapshot(spark, now, m.name) for m in members(Partials)])


def compact_results(spark: SparkSession, root: str, upto: int | None = None) -> int | None:
    """Compact what a stream has written below ``root``; see ``tables.compact``.

    Partial counts are added up. Finished results of a batch stay its own, as they
    don't add up; only their files become few.
    """
    tables = {name: lambda rows, by=by: added_up(rows, by) for name, by in KEYS.items()}
    tables |= {name: lambda rows: rows for name in RESULT_TABLES}
    return compact(spark, root, tables, upto)


def added_up(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Counts of several batches as those of one, the last of them."""
    how = {"size_min": F.min, "size_max": F.max, "batch_id": F.max}
    values = [c for c in rows.columns if c not in keys]
    kinds = dict(rows.dtypes)
    added = [how.get(c, F.sum)(c).cast(kinds[c]).alias(c) for c in values]
    return rows.groupBy(*keys).agg(*added)


def _summed(rows: DataFrame, *keys: Column | str, value: str = "requests") -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum(value).alias("count"))


def _host_days(p: Partials, grain: str) -> DataFrame:
    """``host, day, requests`` with one row per host and day."""
    day = fields.day("date", grain).alias("day")
    return p.host_days.groupBy(day, "host").agg(F.sum("requests").alias("requests"))


# -- results ----------------------------------------------------------------


def content_sizes(p: Partials) -> DataFrame:
    """Minimum, maximum, mean, sample deviation and count of sizes.

    Squares are taken about a whole number next to the mean, where they are
    small, and up to that point all sums are whole numbers without rounding. The
    result is the same in whatever order the parts are added.
    """
    totals = p.hours.agg(
        F.sum("sized").alias("n"),
        F.sum("size_sum").cast(_EXACT).alias("s"),
        F.sum("size_squares").cast(_EXACT).alias("q"),
        F.min("size_min").alias("min_content_size"),
        F.max("size_max").alias("max_content_size"),
    ).withColumn("count", F.nullif(F.col("n"), F.lit(0)).cast(_EXACT))
    totals = totals.withColumn("pivot", F.round(F.col("s") / F.col("count")).cast(_EXACT))
    n, s, q, pivot = (F.col(c) for c in ("count", "s", "q", "pivot"))
    about_pivot = (q - pivot * s - pivot * (s - pivot * n)).cast("double")
    rest = (s - pivot * n).cast("double")
    n = n.cast("double")
    squares = about_pivot - rest * rest / n
    return totals.select(
        "min_content_size",
        "max_content_size",
        (s.cast("double") / n).alias("mean_content_size"),
        F.sqrt(squares / F.nullif(n - 1, F.lit(0.0))).alias("std_content_size"),
        F.col("n").alias("count_content_size"),
    )


def missing_values(p: Partials) -> DataFrame:
    """For every column of the logs, how many rows miss it."""
    columns = [c for c in p.hours.columns if c.startswith(MISSING)]
    return p.hours.agg(
        *[F.sum(c).alias(c.removeprefix(MISSING)) for c in columns]
    )


def statuses(p: Partials) -> DataFrame:
    return _summed(p.hours, "status")


def frequent_hosts(p: Partials, k: int = 10) -> DataFrame:
    return most_frequent(_summed(p.host_days, "host"), "host", k)


def frequent_endpoints(p: Partials, k: int = 20) -> DataFrame:
    return most_frequent(_summed(p.endpoints, "endpoint"), "endpoint", k)


def error_endpoints(p: Partials, k: int = 10) -> DataFrame:
    errors = p.endpoints.filter(F.col("status") != OK)
    return most_frequent(_summed(errors, "endpoint"), "endpoint", k)


def unique_hosts(p: Partials) -> DataFrame:
    return p.host_days.select("host").distinct()


def daily_hosts(p: Partials, grain: str = "day_of_month") -> DataFrame:
    return counted(_host_days(p, grain), "day")


def avg_daily(p: Partials, grain: str = "day_of_month") -> DataFrame:
    return average_requests(_host_days(p, grain))


def not_found_endpoints(p: Partials) -> DataFrame:
    return _summed(p.endpoints.filter(F.col("status") == NOT_FOUND), "endpoint")


def not_found_hosts(p: Partials) -> DataFrame:
    seen = p.host_days.filter(F.col("not_found") > 0)
    return _summed(seen, "host", value="not_found")


def not_found_days(p: Partials, grain: str = "day_of_month") -> DataFrame:
    rows = p.hours.filter(F.col("status") == NOT_FOUND)
    return _summed(rows, fields.day("date", grain).alias("day"))


def not_found_hours(p: Partials) -> DataFrame:
    return _summed(p.hours.filter(F.col("status") == NOT_FOUND), "hour")


# Names of the result tables a stream writes.
RESULT_TABLES = {
    "content_size_summary": content_sizes,
    "missing_values": missing_values,
    "http_status": statuses,
    "frequent_hosts": frequent_hosts,
    "frequent_endPoints": frequent_endpoints,
    "error_endpoints": error_endpoints,
    "unique_hosts": unique_hosts,
    "unique_daily_hosts": daily_hosts,
    "avg_daily_reqests_per_host": avg_daily,
    "endpoints_404_count": not_found_endpoints,
    "hosts_404_count_df": not_found_hosts,
    "errors_by_date_sorted": not_found_days,
    "hourly_avg_errors_sorted": not_found_hours,
}
