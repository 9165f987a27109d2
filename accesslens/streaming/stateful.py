"""Running totals kept in the state of a streaming query.

An alternative to partial counts per batch when only totals are wanted: the
state holds one row per group, so it is meant for groups that are few (statuses)
or that end (hours). Rows are counted per task before they reach the state, so a
group with most of the rows costs no more than any other. The number of state
partitions is the session's ``spark.sql.shuffle.partitions`` at first start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from accesslens.functions import fields
from accesslens.operators.not_found import NOT_FOUND
from accesslens.operators.traffic import counted
from accesslens.sources import commits
from accesslens.sources.tables import (
    batch_ids,
    commit_batch,
    compact,
    delete,
    place_of_batch,
    read_batch,
    read_last,
    read_snapshot,
    read_table,
    write_batch,
)
from accesslens.streaming.results import TRIGGER

STATUS_TOTALS = "status_totals"
HOURLY_TOTALS = "hourly_totals"

# Totals that go on under a new checkpoint: a folder for each checkpoint.
CONTINUED = "status_by_checkpoint"
BASE, SINCE = "base", "since"

# Tables of hours with late requests, below a folder of their own.
HOURLY = "hourly"
ON_TIME, LATE, PROGRESS = "on_time", "late", "progress"


def _start(
    rows: DataFrame,
    mode: str,
    root: str,
    table: str,
    checkpoint: str,
    trigger: dict | None,
) -> StreamingQuery:
    return (
        rows.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER))
        .foreachBatch(lambda batch, n: write_batch(batch, root, table, n))
        .start()
    )


def start_status_totals(
    logs: DataFrame, root: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Requests per status so far; every batch writes all of them."""
    totals = counted(logs, "status")
    return _start(totals, "complete", root, STATUS_TOTALS, checkpoint, trigger)


def status_totals(spark: SparkSession, root: str) -> DataFrame:
    """The totals as of the last batch."""
    return read_last(spark, root, STATUS_TOTALS)


def start_continued_totals(
    logs: DataFrame, root: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Requests per status, going on from the totals so far if ``checkpoint`` is new.

    A checkpoint that was lost, or can't be read by a changed query, takes the state
    with it. A query that starts without one first writes the totals that there are as the base
    of the new one, whose own counts are added to it. ``logs`` then have to be what
    the checkpoints before did not take, such as a topic from given offsets on. Of the totals that
    every batch writes only the last two stay.
    """
    spark = logs.sparkSession
    folder = f"{root}/{CONTINUED}"
    numbers = batch_ids(spark, folder, BASE)
    if not commits.Files(spark, checkpoint).names():
        counts = continued_totals(spark, root) if numbers else None
        number = numbers[-1] + 1 if numbers else 0
        nothing = spark.createDataFrame([], "status int, count bigint")
        write_batch(nothing if counts is None else counts, folder, BASE, number)
    elif not numbers:
        raise ValueError(f"no totals below {folder} that {checkpoint} could go on from")
    else:
        number = numbers[-1]
    table = f"{SINCE}-{number}"

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, folder, table, batch_id)
        old = [n for n in batch_ids(spark, folder, table) if n < batch_id - 1]
        delete(spark, [f"{folder}/{table}/batch_id={n}" for n in old])

    return (
        counted(logs, "status")
        .writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER))
        .foreachBatch(write)
        .start()
    )


def continued_totals(spark: SparkSession, root: str) -> DataFrame:
    """Requests per status over all checkpoints: the last base and what came since.

    Reads two folders, however many batches there were.
    """
    folder = f"{root}/{CONTINUED}"
    numbers = batch_ids(spark, folder, BASE)
    if not numbers:
        raise ValueError(f"no totals below {folder}")
    rows = read_batch(spark, folder, BASE, numbers[-1])
    since = f"{SINCE}-{numbers[-1]}"
    batches = batch_ids(spark, folder, since)
    if batches:
        rows = rows.unionByName(read_batch(spark, folder, since, batches[-1]))
    return rows.groupBy("status").agg(F.sum("count").alias("count"))


def start_hourly_totals(
    logs: DataFrame,
    root: str,
    checkpoint: str,
    delay: str = "2 days",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Requests and 404s per hour of event time, dates kept apart.

    An hour stays open until the stream is ``delay`` past it; requests that come
    in later than that are not counted, nor are those without a time. Every batch
    writes the hours it changed.
    """
    hours = (
        logs.filter(F.col("time").isNotNull())
        .withColumn("time", fields.instant("time"))
        .withWatermark("time", delay)
        .groupBy(F.window("time", "1 hour"))
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.count_if(F.col("status") == NOT_FOUND).alias("not_found"),
        )
        .withColumn("hour_start", fields.wall_clock("window.start"))
        .select("hour_start", "requests", "not_found")
    )
    return _start(hours, "update", root, HOURLY_TOTALS, checkpoint, trigger)


def hourly_totals(spark: SparkSession, root: str) -> DataFrame:
    """The last totals of every hour; as they only grow, these are the largest."""
    return (
        read_table(spark, root, HOURLY_TOTALS)
        .groupBy("hour_start")
        .agg(
            F.max("requests").alias("requests"), F.max("not_found").alias("not_found")
        )
    )


# -- hours with late requests ------------------------------------------------


def start_hourly_with_late(
    logs: DataFrame,
    root: str,
    checkpoint: str,
    delay: str = "2 days",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Requests and 404s per hour of event time; those behind the watermark are kept apart.

    An hour is closed when the latest request of the batches before is ``delay`` past its end,
    as in ``start_hourly_totals``. What comes for a closed hour is written to a table of
    corrections in the same batch, with the batch it came in, and is committed with it.
    """
    return (
        logs.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER))
        .foreachBatch(lambda batch, n: write_hours(batch, f"{root}/{HOURLY}", n, delay))
        .start()
    )


def write_hours(logs: DataFrame, root: str, batch_id: int, delay: str = "2 days") -> None:
    """Write the hours of one batch; a batch without a request that has a time writes nothing.

    Requests are counted per hour once. A batch that is repeated is held against the same
    watermark, that of the batches before it.
    """
    spark = logs.sparkSession
    place = place_of_batch(spark, root, batch_id)
    if place is None:
        return
    folder = f"{root}/{place}" if place else root
    before = [n for n in batch_ids(spark, root, PROGRESS) if n < batch_id]
    latest = read_batch(spark, root, PROGRESS, before[-1]).first()["latest"] if before else None
    hours = (
        logs.filter(F.col("time").isNotNull())
        .groupBy(F.date_trunc("hour", "time").cast("timestamp_ntz").alias("hour_start"))
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.count_if(F.col("status") == NOT_FOUND).alias("not_found"),
            F.max("time").alias("latest"),
        )
        .persist()
    )
    try:
        newest = hours.agg(F.max("latest")).first()[0]
        if newest is None:
            return
        watermark = F.lit(latest).cast("timestamp_ntz") - F.expr(f"interval {delay}")
        end = F.col("hour_start") + F.expr("interval 1 hour")
        late = F.coalesce(end <= watermark, F.lit(False))
        columns = ("hour_start", "requests", "not_found")
        write_batch(hours.filter(~late).select(*columns), folder, ON_TIME, batch_id)
        write_batch(hours.filter(late).select(*columns), folder, LATE, batch_id)
    finally:
        hours.unpersist()
    reached = newest if latest is None else max(newest, latest)
    progress = spark.createDataFrame([(reached,)], "latest timestamp_ntz")
    write_batch(progress, root, PROGRESS, batch_id)
    commit_batch(spark, root, batch_id, place)
    delete(spark, [f"{root}/{PROGRESS}/batch_id={n}" for n in before[:-1]])


def hourly_with_late(spark: SparkSession, root: str) -> DataFrame:
    """Requests and 404s of every hour, and how many of the requests came late.

    Both tables are of one snapshot, so no batch counts by half.
    """
    now = commits.snapshot(spark, f"{root}/{HOURLY}")
    parts = [
        read_snapshot(spark, now, table).select(
            "hour_start", "requests", "not_found",
            (F.col("requests") if table == LATE else F.lit(0)).cast("bigint").alias("late_requests"),
        )
        for table in (ON_TIME, LATE)
    ]
    values = ("requests", "not_found", "late_requests")
    rows = parts[0].unionByName(parts[1])
    return rows.groupBy("hour_start").agg(*[F.sum(c).alias(c) for c in values])


def late_hours(spark: SparkSession, root: str) -> DataFrame:
    """The corrections: what came in which batch for hours that were closed."""
    now = commits.snapshot(spark, f"{root}/{HOURLY}")
    return read_snapshot(spark, now, LATE)


def compact_hourly(spark: SparkSession, root: str, upto: int | None = None) -> int | None:
    """Put the hours of committed batches together; see ``tables.compact``.

    Requests on time are added up per hour. Corrections stay by batch.
    """

    def added(rows: DataFrame) -> DataFrame:
        values = [F.sum(c).alias(c) for c in ("requests", "not_found")]
        return rows.groupBy("hour_start").agg(*values, F.max("batch_id").alias("batch_id"))

    return compact(spark, f"{root}/{HOURLY}", {ON_TIME: added, LATE: lambda rows: rows}, upto)
