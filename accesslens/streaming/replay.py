"""Replay of stored lines as a stream: cut into batches in order, then delivered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslens.sources.text import write_lines


def batch_ranges(rows: DataFrame, key: str, batches: int) -> list[tuple[int, int]]:
    """First and last key of each of ``batches`` equal ranges of a whole-number key."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    if low is None:
        return []
    span = high - low + 1
    starts = [low + -(-i * span // batches) for i in range(batches + 1)]
    return [(first, end - 1) for first, end in zip(starts, starts[1:])]


def batch_number(key: Column, low: int, high: int, batches: int) -> Column:
    """Which of equal ranges from ``low`` to ``high`` a key lies in, from 0."""
    exact = "decimal(38,0)"
    place = (key.cast("decimal(20,0)") - F.lit(low)).cast(exact) * F.lit(batches)
    span = F.lit(str(high - low + 1)).cast(exact)
    return F.call_function("div", place, span).cast("bigint")


def stage_batches(lines: DataFrame, key: str, batches: int, path: str) -> None:
    """Write lines as text shards, one folder ``batch_id=<n>`` for each batch.

    Rows of a batch are brought together first, so that a batch has a file for each
    so many bytes and not one for each task, whatever the order of the input.
    """
    low, high = lines.agg(F.min(key), F.max(key)).first()
    number = batch_number(F.col(key), low or 0, high or 0, batches)
    staged = lines.select(number.alias("batch_id"), "value")
    staged.hint("rebalance", "batch_id").write.partitionBy("batch_id").text(path)


def deliver(lines: DataFrame, path: str) -> None:
    """Add lines to a folder that a file stream reads; complete once it returns."""
    write_lines(lines, path, mode="append")
