"""All result tables kept up to date from a stream of lines."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from accesslens.functions.parse import parse_logs
from accesslens.operators.quality import LINE
from accesslens.plans.partials import (
    RESULT_TABLES,
    narrow,
    partial_counts,
    write_partials,
)
from accesslens.sources.tables import commit_batch, place_of_batch, write_batch

TRIGGER = {"processingTime": "10 seconds"}


def write_results(
    logs: DataFrame, root: str, batch_id: int, keep: bool = True, parallel: int = 8
) -> None:
    """Write every table for a batch of logs; a batch without rows writes nothing.

    The batch is reduced to its partial counts, which are written, and the result
    tables are computed from those, ``parallel`` at a time because each is small.
    Everything written belongs to the batch id, so a batch that is retried after
    a failure replaces what it had written. The batch is committed when all is written;
    readers leave out what is not. Written again after that, it counts in place of the
    first; snapshots taken before keep that one. A batch that was compacted stays as it is.

    With ``keep`` the fields that are counted are kept until the counts are written, so
    that lines are read and parsed once. Logs that were landed as Parquet, such as
    years of them in one batch, are better not kept: each count then reads only
    its own columns.
    """
    spark = logs.sparkSession
    counted = narrow(logs)
    if keep:
        counted.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # counting keeps all rows in all tasks; a look at one would begin with one task
        empty = counted.count() == 0 if keep else counted.isEmpty()
        place = None if empty else place_of_batch(spark, root, batch_id)
        if place is None:
            return
        folder = f"{root}/{place}" if place else root
        partials = write_partials(spark, partial_counts(counted), folder, batch_id)
    finally:
        if keep:
            counted.unpersist()

    def write_table(table: str) -> None:
        write_batch(RESULT_TABLES[table](partials), folder, table, batch_id)

    with ThreadPoolExecutor(parallel) as pool:
        # Threads that inherit the query's job group, so that stopping it stops
        # their jobs too.
        list(pool.map(inheritable_thread_target(spark)(write_table), RESULT_TABLES))
    commit_batch(spark, root, batch_id, place)


def start_metrics(
    lines: DataFrame,
    root: str,
    checkpoint: str,
    style: str = "iso",
    trigger: dict | None = None,
    keep: bool = True,
) -> StreamingQuery:
    """Start writing the result tables of streaming ``lines`` below ``root``.

    ``checkpoint`` records which input has been processed, so that a query
    started again with it goes on where the last one ended. ``keep`` is that of
    ``write_results``. How much a batch takes is bounded where the stream is opened.
    """
    return (
        parse_logs(lines, style, keep=[LINE])
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER))
        .foreachBatch(lambda logs, batch_id: write_results(logs, root, batch_id, keep))
        .start()
    )


def run_available(query: StreamingQuery) -> None:
    """Wait for a query started with ``availableNow`` and raise what it raised."""
    try:
        query.awaitTermination()
    finally:
        query.stop()
