"""Result tables and landed logs as Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from accesslens.sources import commits

# Folders of compacted tables, and of batches that were written again after their commit.
COMPACTED = "compacted"
AGAIN = "again"


def write_batch(result: DataFrame, root: str, table: str, batch_id: int) -> None:
    """Add the rows of one batch to a result table.

    A batch owns the folder ``batch_id=<n>`` of the table and replaces it when
    written again, so a batch that is retried does not count twice.
    """
    result.write.mode("overwrite").parquet(f"{root}/{table}/batch_id={batch_id}")


def read_batch(
    spark: SparkSession,
    root: str,
    table: str,
    batch_id: int,
    schema: StructType | None = None,
) -> DataFrame:
    """The rows one batch added to a result table.

    A ``schema`` that is known saves a look into the files.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{root}/{table}/batch_id={batch_id}")


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All rows of a result table, with the batch they came from as ``batch_id``.

    A filter on ``batch_id`` leaves the folders of other batches unread.
    """
    rows = spark.read.parquet(f"{root}/{table}")
    return rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))


def commit_batch(spark: SparkSession, root: str, batch_id: int, place: str = "") -> None:
    """Say that every table has the rows of a batch. To be called when all are written.

    ``place`` is the folder below ``root`` that has the tables, if it isn't ``root``.
    """
    commits.commit(spark, root, {"batch": batch_id, "place": place})


def place_of_batch(spark: SparkSession, root: str, batch_id: int) -> str | None:
    """Where a batch is to be written: '' for the tables' own folders.

    What is committed stays as it is for those who read it, so a batch that is written again
    after its commit goes to a new place. None if it was compacted: it can't be taken out any more,
    and what comes again is what a stream repeats that lost its own note of it.
    """
    now = commits.snapshot(spark, root)
    if now.covers(batch_id):
        return None
    return f"{AGAIN}/{batch_id}-{uuid.uuid4().hex}" if batch_id in now.batches else ""


def batch_ids(spark: SparkSession, root: str, table: str | None = None) -> list[int]:
    """Committed batches that are not compacted, in order, by the log.

    Or those of a ``table`` that is not committed to, by one listing of its folders;
    only those whose writer has finished count.
    """
    if table is None:
        return commits.snapshot(spark, root).ids()
    files = commits.Files(spark, f"{root}/{table}")
    numbers = (name.removeprefix("batch_id=") for name in files.names())
    ids = sorted(int(number) for number in numbers if number.isdigit())
    # only the last one can be unfinished: a stream writes one after the other
    while ids and "_SUCCESS" not in commits.Files(spark, f"{root}/{table}/batch_id={ids[-1]}").names():
        ids.pop()
    return ids


def read_snapshot(spark: SparkSession, now: commits.Snapshot, table: str) -> DataFrame:
    """Rows of a result table as of a snapshot, with their ``batch_id``.

    Tables of one snapshot fit together. Only the folders of its batches are listed and read;
    rows that were compacted have the last of their batches.
    """
    parts = []
    if now.compacted is not None:
        parts.append(spark.read.parquet(f"{now.root}/{now.compacted_place}/{table}"))
    for place in sorted(set(now.batches.values())):
        parts.append(read_place(spark, now.root, place, table, [
            n for n in now.ids() if now.batches[n] == place
        ]))
    if not parts:
        return read_table(spark, now.root, table).limit(0)
    return reduce(DataFrame.unionByName, parts)


def read_place(
    spark: SparkSession, root: str, place: str, table: str, batches: list[int]
) -> DataFrame:
    """Rows of some batches of a table that are in one place, with their ``batch_id``."""
    base = f"{root}/{place}/{table}" if place else f"{root}/{table}"
    rows = spark.read.option("basePath", base).parquet(*[f"{base}/batch_id={n}" for n in batches])
    return rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))


def read_committed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of a result table of the batches that are committed now, with their ``batch_id``.

    For several tables take one snapshot and read all from it.
    """
    return read_snapshot(spark, commits.snapshot(spark, root), table)


def read_as_of(
    spark: SparkSession,
    root: str,
    table: str,
    batch_id: int | None = None,
    version: int | None = None,
) -> DataFrame:
    """Rows of a result table as they were: after a commit, or without batches after one."""
    now = commits.snapshot(spark, root, version)
    return read_snapshot(spark, now if batch_id is None else now.until(batch_id), table)


def compact(
    spark: SparkSession,
    root: str,
    tables: dict[str, Callable[[DataFrame], DataFrame]],
    upto: int | None = None,
) -> int | None:
    """Put the rows of committed batches together, in few files for each table.

    ``upto`` is the last batch to take, by default the last that is committed. A table's
    function makes fewer rows of its own, if they add up. The compaction counts when all
    tables are written; until then, and if it fails, readers see the former state. Folders
    that the compaction before this one covers are deleted with their part of the log, so a
    reader has the time between two compactions to finish. Returns the last batch it covers.
    """
    now = commits.snapshot(spark, root)
    taken = [n for n in now.ids() if upto is None or n <= upto]
    if not taken:
        return now.compacted
    last = taken[-1]
    place = f"{COMPACTED}_tables/{last}"
    upto_last = now.until(last)
    for table, merged in tables.items():
        few = merged(read_snapshot(spark, upto_last, table)).hint("rebalance")
        few.write.mode("overwrite").parquet(f"{root}/{place}/{table}")
    entry = {"upto": last, "place": place, "gone": now.compacted}
    if commits.commit(spark, root, entry, based_on=upto_last) is None:
        return commits.snapshot(spark, root).compacted  # a batch came again meanwhile
    if now.compacted is not None:
        _delete_covered(spark, root, list(tables), now.compacted)
        commits.forget(spark, root, now.version)
    return last


def _delete_covered(spark: SparkSession, root: str, tables: list[str], upto: int) -> None:
    """Delete batches up to one that was compacted, and compactions before that one."""

    def covered(folder: str, number: Callable[[str], str], below: int) -> list[str]:
        numbers = {name: number(name) for name in commits.Files(spark, folder).names()}
        return [
            f"{folder}/{name}" for name, n in numbers.items() if n.isdigit() and int(n) < below
        ]

    old = [
        path
        for table in tables
        for path in covered(f"{root}/{table}", lambda s: s.removeprefix("batch_id="), upto + 1)
    ]
    old += covered(f"{root}/{AGAIN}", lambda s: s.partition("-")[0], upto + 1)
    old += covered(f"{root}/{COMPACTED}_tables", str, upto)
    delete(spark, old)


def delete(spark: SparkSession, paths: list[str]) -> None:
    jvm = spark.sparkContext._jvm
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.delete(path, True)


def read_last(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of the last batch, for tables of which every batch holds all of it.

    Reads one folder, however many there are.
    """
    ids = batch_ids(spark, root, table)
    if not ids:
        raise ValueError(f"no batch of {table} below {root}")
    return read_batch(spark, root, table, ids[-1])


def land_logs(logs: DataFrame, path: str, by_date: bool = False) -> None:
    """Write a parsed log table as Parquet, for when it is queried repeatedly.

    Queries then read only the columns they use, instead of matching every line again;
    their filters run on the columns' values. What is at ``path`` is replaced.
    ``by_date`` makes one folder per date; rows are brought together by date
    first, and a date with much more than the others is spread over several tasks.
    """
    if by_date:
        logs = logs.withColumn("date", F.col("time").cast("date"))
        logs = logs.hint("rebalance", "date")
        logs.write.mode("overwrite").partitionBy("date").parquet(path)
    else:
        logs.write.mode("overwrite").parquet(path)


def land_clustered(
    logs: DataFrame, path: str, by: str = "host", files: int | None = None, distinct: int = 1 << 20
) -> None:
    """Write a parsed log table as Parquet that is sorted by a column, replacing what is there.

    Files take ranges of ``by``, then of time, so a filter on ``by`` leaves out files and row groups
    by their ends. Where a value lies between the ends but isn't there, the bloom filter
    of the row group says so; it is made for ``distinct`` values. A value that very many rows have is
    spread over several files by time and by what else is in the row; only rows that are
    equal in all columns always go together. NULLs come first.
    ``files`` is by default the number of shuffle partitions, of which adaptive execution merges
    small ones.
    """
    order = [by, *[c for c in ("time",) if c != by and c in logs.columns]]
    rest = F.xxhash64(*logs.columns)
    spread = [files] if files else []
    ranged = logs.repartitionByRange(*spread, *order, rest).sortWithinPartitions(*order)
    writer = ranged.write.mode("overwrite")
    writer = writer.option(f"parquet.bloom.filter.enabled#{by}", "true")
    writer.option(f"parquet.bloom.filter.expected.ndv#{by}", str(distinct)).parquet(path)
