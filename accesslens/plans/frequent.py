"""Most frequent hosts and endpoints from sketches, for when there are too many to keep.

``partials`` keeps a row for each host and day and for each endpoint. Here a batch leaves one
row with three sketches of frequent items, whatever it holds, and sketches of any batches are
merged. A sketch of ``TRACKED`` items takes at most about a megabyte of short texts.

What a sketch says of an item is never below its count, and above it by at most ``error_bound``
of the requests it saw. Items are listed whose count is surely over the bound; one with
more than twice the bound always is. So a list may have fewer than k items, where many
have few requests each, but the count at each of its places is that of the exact list to within the bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.operators.traffic import OK
from accesslens.sources.tables import batch_ids, read_batch, read_table, write_batch

#: Items a sketch keeps; the bound shrinks as it grows.
TRACKED = 10_000

TABLE = "frequent_items"

#: The lists that are kept: a column, and which requests count.
LISTS = {
    "hosts": ("host", "true"),
    "endpoints": ("endpoint", "true"),
    "error_endpoints": ("endpoint", f"status <> {OK}"),
}


def error_bound(requests: Column, tracked: Column | int = TRACKED) -> Column:
    """By how much a sketch that saw so many requests may overstate one item, at most.

    A sketch has room for a third more than it tracks, and an item's error is below 3.5 times
    the requests by that room; rooms are powers of two, so this is the bound of the least one.
    """
    return F.ceil(requests * 3.5 * 0.75 / tracked)


def sketched(logs: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """One row: for each list its sketch and ``<list>_requests``, how many requests it saw.

    All from one scan. A host or endpoint that is not known is '' in a log table, and counts
    as an item; NULLs are left out. Without logs the row has empty sketches.
    """
    made = []
    for name, (column, which) in LISTS.items():
        counted = f"filter (where {column} is not null and {which})"
        made.append(F.expr(f"approx_top_k_accumulate({column}, {int(tracked)}) {counted}").alias(name))
        made.append(F.expr(f"count(1) {counted}").alias(f"{name}_requests"))
    return logs.agg(*made)


def add_batch(logs: DataFrame, root: str, batch_id: int, tracked: int = TRACKED) -> None:
    """Write the sketches of a batch, in place of those it had: also a ``foreachBatch``.

    All batches below a ``root`` must track equally many items; reading fails otherwise.
    """
    write_batch(sketched(logs, tracked), root, TABLE, batch_id)


def read_sketches(
    spark: SparkSession, root: str, first: int | None = None, last: int | None = None
) -> DataFrame:
    """Sketches of the batches below ``root``, or of those from ``first`` to ``last``.

    Of the last batch only when its writer has finished.
    """
    done = batch_ids(spark, root, TABLE)
    rows = read_table(spark, root, TABLE)
    chosen = [n for n in done if (first is None or n >= first) and (last is None or n <= last)]
    if not chosen:
        return rows.limit(0)
    return rows.filter(F.col("batch_id").between(chosen[0], chosen[-1]))


def most_frequent(sketches: DataFrame, name: str, k: int = 10) -> DataFrame:
    """``<column>, count, at_least``: the k most frequent items of a list as far as they are sure.

    ``count`` is what the sketch says, the true one is between ``at_least`` and it. The list is
    sorted by count, then item, but which of several with the last place's count are in it is open.
    No row if the sketches saw nothing. ``k`` is at most the number of items tracked.
    """
    column = LISTS[name][0]
    merged = sketches.agg(
        F.expr(f"approx_top_k_combine({name})").alias("items"),
        F.sum(f"{name}_requests").alias("requests"),
    ).filter(F.col("requests") > 0)
    found = merged.select(
        F.expr(f"explode(approx_top_k_estimate(items, {int(k)}))").alias("found"),
        error_bound(F.col("requests"), F.col("items.maxItemsTracked")).alias("bound"),
    )
    count = F.col("found.count")
    return found.select(
        F.col("found.item").alias(column),
        count.alias("count"),
        F.greatest(count - F.col("bound"), F.lit(0)).cast("bigint").alias("at_least"),
    ).orderBy(F.desc("count"), column)
