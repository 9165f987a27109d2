"""From lines to the typed log table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.functions import fields as f


def parse_logs(
    lines: DataFrame,
    style: str = "clf",
    keep: Sequence[str] = (),
    to_utc: bool = False,
) -> DataFrame:
    """Typed table of the lines in column ``value``, one row per line.

    ``style="clf"`` reads ``[dd/MMM/yyyy:HH:mm:ss +zzzz]`` times and adds
    ``day_of_week``; ``style="iso"`` reads ``[yyyy-MM-dd HH:mm:ss]`` times and
    adds ``current_time``, when the row was ingested (the same for all rows of
    a query or micro-batch). ``keep`` names input columns to carry along. ``to_utc``
    applies the offset of a CLF time and its weekday, instead of leaving it out.
    """
    value = F.col("value")
    if style == "clf":
        date, time = f.clf_date(value), f.clf_time(value)
        if to_utc:
            date = time = f.time_of_text(f.bracketed(value), to_utc=True)
        lead = [f.day_of_week(date).alias("day_of_week")]
        lead += [time.alias("time"), f.host(value).alias("host")]
    elif style == "iso":
        lead = [F.current_timestamp().alias("current_time")]
        lead += [f.host(value).alias("host"), f.iso_time(value).alias("time")]
    else:
        raise ValueError(f"style must be 'clf' or 'iso', not {style!r}")
    return lines.select(
        *keep,
        *lead,
        f.method(value).alias("method"),
        f.endpoint(value).alias("endpoint"),
        f.protocol(value).alias("protocol"),
        f.status(value).alias("status"),
        f.content_size(value).alias("content_size"),
    )


def typed_times(logs: DataFrame, source: str = "time_text") -> DataFrame:
    """Log table whose time is text: the same rows with a typed ``time``, last.

    Accepts both ``dd/MMM/yyyy:HH:mm:ss`` with or without an offset, and
    ``yyyy-MM-dd HH:mm:ss``; anything else is NULL.
    """
    text = F.col(source)
    time = F.coalesce(f.time_of_text(text), text.try_cast("timestamp_ntz"))
    return logs.select(
        "host", "method", "endpoint", "protocol", "status", "content_size",
        time.alias("time"),
    )
