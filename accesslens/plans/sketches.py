"""Distinct hosts within about two percent, in a fixed few kilobytes per day.

For when (host, day) pairs are too many to keep: a sketch per day and batch is
kept instead, and sketches of the same day are merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.functions import fields


def daily_host_sketches(logs: DataFrame, grain: str = "date") -> DataFrame:
    """``day, hosts``: one sketch of the hosts of each day."""
    day = fields.day("time", grain).alias("day")
    # A sketch ignores '', which is a host like any other here.
    host = F.concat(F.lit(":"), F.col("host"))
    return logs.groupBy(day).agg(F.hll_sketch_agg(host).alias("hosts"))


def estimate_daily_hosts(sketches: DataFrame) -> DataFrame:
    """``day, count``: estimated hosts per day from sketches of any batches."""
    merged = sketches.groupBy("day").agg(F.hll_union_agg("hosts").alias("hosts"))
    return merged.select("day", F.hll_sketch_estimate("hosts").alias("count"))


def estimate_hosts(sketches: DataFrame) -> DataFrame:
    """One row: estimated hosts over all days and batches."""
    merged = sketches.agg(F.hll_union_agg("hosts").alias("hosts"))
    return merged.select(F.hll_sketch_estimate("hosts").alias("unique_hosts"))


# -- quantiles of sizes -------------------------------------------------------

#: Of the sketches below; a rank is off by less than this but for one in a hundred.
RANK_ERROR = 0.0133


def hourly_size_sketches(logs: DataFrame) -> DataFrame:
    """``date, hour, sizes``: a sketch of a few kilobytes of the sizes of each hour."""
    size = F.col("content_size").cast("bigint")
    return (
        logs.groupBy(F.col("time").cast("date").alias("date"), F.hour("time").alias("hour"))
        .agg(F.kll_sketch_agg_bigint(size).alias("sizes"))
    )


def size_quantiles(sketches: DataFrame, quantiles: Sequence[float], *keys: str) -> DataFrame:
    """``quantile, content_size`` over all sketches, or for each value of ``keys``.

    The size at which about so large a share of the sizes known is no larger. Sketches of any
    hours and batches are merged; no row if there are none.
    """
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_bigint("sizes").alias("sizes"))
    known = merged.filter(F.kll_sketch_get_n_bigint("sizes") > 0)
    found = [
        F.struct(
            F.lit(float(q)).alias("quantile"),
            F.kll_sketch_get_quantile_bigint("sizes", F.lit(float(q))).alias("content_size"),
        )
        for q in quantiles
    ]
    return known.select(*keys, F.inline(F.array(*found)))
