"""Requests answered with 404: how many, for what, by whom and when."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.functions import fields
from accesslens.operators.traffic import counted, most_frequent

NOT_FOUND = 404


def not_found_rows(logs: DataFrame) -> DataFrame:
    return logs.filter(F.col("status") == NOT_FOUND)


def not_found_total(logs: DataFrame) -> DataFrame:
    """One row: number of 404s."""
    return not_found_rows(logs).agg(F.count(F.lit(1)).alias("not_found"))


def not_found_by_endpoint(logs: DataFrame, k: int | None = None) -> DataFrame:
    """404s per endpoint, most first; all of them, or the first ``k``."""
    return most_frequent(counted(not_found_rows(logs), "endpoint"), "endpoint", k)


def not_found_by_host(logs: DataFrame, k: int | None = None) -> DataFrame:
    """404s per host, most first; all of them, or the first ``k``."""
    return most_frequent(counted(not_found_rows(logs), "host"), "host", k)


def not_found_by_day(logs: DataFrame, grain: str = "day_of_month") -> DataFrame:
    """404s per day; those without a time make a NULL day."""
    day = fields.day("time", grain).alias("day")
    return counted(not_found_rows(logs), day).orderBy("day")


def top_not_found_days(
    logs: DataFrame, k: int = 3, grain: str = "day_of_month"
) -> DataFrame:
    """The ``k`` days with the most 404s."""
    return most_frequent(not_found_by_day(logs, grain), "day", k)


def not_found_by_hour(logs: DataFrame) -> DataFrame:
    """404s per hour of the day."""
    hour = fields.hour("time").alias("hour")
    return counted(not_found_rows(logs), hour).orderBy("hour")


def not_found_by_weekday(logs: DataFrame) -> DataFrame:
    """404s per weekday (``Unknown`` included), most first."""
    # The status is known here, so it need not be parsed or grouped again.
    return most_frequent(
        counted(not_found_rows(logs), "day_of_week"), "day_of_week"
    ).select("day_of_week", F.lit(NOT_FOUND).alias("status"), "count")
