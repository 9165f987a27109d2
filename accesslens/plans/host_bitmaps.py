"""Exact distinct hosts by bitmaps over a dictionary of hosts.

Every host has a number from 0 without gaps, given once and for all by the batch that brings it
first. A batch adds its new hosts to the dictionary and writes, for each date, the numbers of the
hosts it has seen as bitmaps of 32,768 bits. Bitmaps of any dates and batches are put together by
"or", so hosts over any span are counted exactly from at most a bit for each host and date, and
no host is compared with another once it has its number.

Both tables of a batch are committed together. A batch that is written again keeps the hosts it
has brought, as later batches may have their numbers, and adds others behind the last number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.functions import fields
from accesslens.session import new_folder
from accesslens.sources import commits
from accesslens.sources.tables import (
    commit_batch,
    delete,
    place_of_batch,
    read_batch,
    read_snapshot,
    write_batch,
)

HOSTS, BITS = "dictionary", "host_bits"
_ROWS = 33  # bits of a row's number within its partition in monotonically_increasing_id
_DICTIONARY = "host string, id bigint"


def _numbered(spark: SparkSession, hosts: DataFrame, first: int) -> DataFrame:
    """(host, id) with numbers from ``first`` on without gaps; ``hosts`` are stored.

    Each partition's rows are numbered by themselves; only the sizes of partitions are put in a
    row, of which there are as many as tasks.
    """
    place = F.col("place")
    part, row = F.shiftright(place, _ROWS), place.bitwiseAND(F.lit((1 << _ROWS) - 1))
    sizes = hosts.groupBy(part.alias("part")).count().orderBy("part").collect()
    starts, total = [], first
    for size in sizes:
        starts.append((size.part, total))
        total += size["count"]
    if not starts:
        return spark.createDataFrame([], _DICTIONARY)
    offsets = F.broadcast(spark.createDataFrame(starts, "part bigint, start bigint"))
    numbered = hosts.select("host", part.alias("part"), row.alias("row"))
    # rows of a partition are numbered from 0 as they are written
    return numbered.join(offsets, "part").select("host", (F.col("start") + F.col("row")).alias("id"))


def add_hosts(logs: DataFrame, root: str, batch_id: int) -> None:
    """Add the hosts of a batch of logs and their bits of each date; commits the batch."""
    spark = logs.sparkSession
    place = place_of_batch(spark, root, batch_id)
    if place is None:
        return
    folder = f"{root}/{place}" if place else root
    now = commits.snapshot(spark, root)
    scratch = new_folder(spark, "new-hosts")
    seen = logs.select(F.col("time").cast("date").alias("date"), "host").distinct()
    seen.write.parquet(f"{scratch}/seen")
    seen = spark.read.schema("date date, host string").parquet(f"{scratch}/seen")
    known = _dictionary(spark, now)
    same = F.col("new.host").eqNullSafe(F.col("known.host"))
    new = seen.select("host").distinct().alias("new").join(known.alias("known"), same, "left_anti")
    new = new.select("host", F.monotonically_increasing_id().alias("place"))
    new.write.parquet(f"{scratch}/new")
    new = spark.read.schema("host string, place bigint").parquet(f"{scratch}/new")
    last = known.agg(F.max("id")).first()[0]
    entries = _numbered(spark, new, 0 if last is None else last + 1)
    if batch_id in now.batches:
        old_place = now.batches[batch_id]
        old = f"{root}/{old_place}" if old_place else root
        entries = entries.unionByName(read_batch(spark, old, HOSTS, batch_id))
    write_batch(entries, folder, HOSTS, batch_id)
    own = read_batch(spark, folder, HOSTS, batch_id, entries.schema)
    everyone = known.unionByName(own).dropDuplicates(["id"])
    same = F.col("seen.host").eqNullSafe(F.col("everyone.host"))
    ids = seen.alias("seen").join(everyone.alias("everyone"), same).select("date", "id")
    bits = ids.groupBy("date", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits")
    )
    write_batch(bits, folder, BITS, batch_id)
    commit_batch(spark, root, batch_id, place)
    delete(spark, [scratch])


def _dictionary(spark: SparkSession, now: commits.Snapshot) -> DataFrame:
    if not now.batches and now.compacted is None:
        return spark.createDataFrame([], _DICTIONARY)
    return read_snapshot(spark, now, HOSTS).select("host", "id")


def dictionary(spark: SparkSession, root: str) -> DataFrame:
    """(host, id) of all hosts."""
    return _dictionary(spark, commits.snapshot(spark, root))


def daily_hosts(spark: SparkSession, root: str, grain: str = "day_of_month") -> DataFrame:
    """Different hosts per day, a missing host being one of them."""
    bits = read_snapshot(spark, commits.snapshot(spark, root), BITS)
    days = bits.groupBy(fields.day("date", grain).alias("day"), "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits")
    )
    return days.groupBy("day").agg(F.sum(F.bitmap_count("bits")).alias("count"))


def unique_hosts(spark: SparkSession, root: str) -> DataFrame:
    """One row: different hosts over all dates."""
    bits = read_snapshot(spark, commits.snapshot(spark, root), BITS)
    whole = bits.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    hosts = F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0))
    return whole.agg(hosts.alias("unique_hosts"))
