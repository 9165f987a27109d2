"""Missing values and table profile.

Text fields of a line that does not parse are ``''`` rather than NULL, so by
default only fields that are really NULL count as missing. ``blank_as_missing``
also counts ``''`` and ``Unknown``.

A text field is NULL only where the line is. If the log table still has the line, as
``value``, that is what is looked at, and no field is matched just to see that it is there.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accesslens.functions.patterns import UNKNOWN

# The columns whose absence makes a row incomplete.
REQUIRED = (
    "host", "time", "method", "endpoint", "protocol", "status", "content_size",
)


# The line a row was parsed from, and fields that are NULL only if it is; a weekday is
# never NULL.
LINE = "value"
FROM_LINE = ("host", "method", "endpoint", "protocol")


def field_names(logs: DataFrame) -> list[str]:
    """The columns of a log table but the line itself."""
    return [c for c in logs.columns if c != LINE]


def missing(logs: DataFrame, name: str, blank_as_missing: bool = False) -> Column:
    """Whether a row misses a column."""
    text = isinstance(logs.schema[name].dataType, T.StringType)
    if blank_as_missing and text:
        return F.col(name).isNull() | F.col(name).isin("", UNKNOWN)
    if LINE in logs.columns and name in FROM_LINE:
        return F.col(LINE).isNull()
    if LINE in logs.columns and name == "day_of_week":
        return F.lit(False)
    return F.col(name).isNull()


def valid_status_rows(logs: DataFrame) -> DataFrame:
    """Rows that have a status."""
    return logs.filter(F.col("status").isNotNull())


def fill_missing_size(logs: DataFrame) -> DataFrame:
    """The same rows with a missing ``content_size`` set to 0."""
    return logs.withColumn("content_size", F.coalesce("content_size", F.lit(0)))


def clean_batch(logs: DataFrame) -> DataFrame:
    """What batch analyses run on: rows with a status, sizes filled.

    Streams run on the rows as parsed, without this step.
    """
    return fill_missing_size(valid_status_rows(logs))


def count_incomplete_rows(
    logs: DataFrame,
    columns: Sequence[str] = REQUIRED,
    blank_as_missing: bool = False,
) -> DataFrame:
    """One row: how many rows miss at least one of the columns."""
    incomplete = reduce(or_, [missing(logs, c, blank_as_missing) for c in columns])
    return logs.agg(F.count_if(incomplete).alias("incomplete_rows"))


def count_missing_per_column(
    logs: DataFrame, blank_as_missing: bool = False
) -> DataFrame:
    """One row: for every column, how many rows miss it."""
    return logs.agg(
        *[
            F.count_if(missing(logs, c, blank_as_missing)).alias(c)
            for c in field_names(logs)
        ]
    )


def table_shape(logs: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return logs.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(logs.columns)).alias("columns")
    )


def preview_rows(
    logs: DataFrame, n: int = 10, order_by: Sequence[str] | None = None
) -> DataFrame:
    """``n`` rows, the first in the order of the given columns if there are any.

    Without an order Spark stops reading when it has them, and any may come.
    """
    return (logs.orderBy(*order_by) if order_by else logs).limit(n)
