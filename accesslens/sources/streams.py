"""Lines as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.functions import fields


# What a micro-batch takes at most, so that the first one, which meets all that was stored
# before, is no larger than an executor can keep.
MAX_FILES = 1_000
MAX_OFFSETS = 5_000_000


def kafka_options(servers: str, topic: str, starting: str = "earliest") -> dict:
    """Options for reading one topic."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }


def open_stream(
    spark: SparkSession,
    kind: str,
    *,
    path: str | None = None,
    glob: str | None = None,
    column: str = "value",
    column_type: str = "string",
    max_files: int | None = MAX_FILES,
    servers: str | None = None,
    topic: str | None = None,
    starting: str = "earliest",
    max_offsets: int | None = MAX_OFFSETS,
    min_partitions: int | None = None,
) -> DataFrame:
    """Streaming ``value: string`` from a topic or from files that arrive.

    ``kind="kafka"`` reads ``topic`` from ``servers`` and needs Spark's Kafka
    connector on the class path. ``kind="text"`` reads text files that appear in
    ``path``; ``kind="parquet"`` reads ``column`` of Parquet files there.
    ``max_files`` and ``max_offsets`` bound a micro-batch; what is beyond them follows
    in the next ones. With None one takes all there is. ``min_partitions`` has more tasks read a topic than it
    has partitions, by splitting those with most to read.
    """
    if kind == "kafka":
        reader = spark.readStream.format("kafka").options(
            **kafka_options(servers, topic, starting)
        )
        if max_offsets:
            reader = reader.option("maxOffsetsPerTrigger", max_offsets)
        if min_partitions:
            reader = reader.option("minPartitions", min_partitions)
        return reader.load().select(fields.decode("value").alias("value"))
    if kind not in ("text", "parquet"):
        raise ValueError(f"kind must be 'kafka', 'text' or 'parquet', not {kind!r}")
    reader = spark.readStream.format(kind)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if kind == "parquet":
        reader = reader.schema(f"`{column}` {column_type}")
        return reader.load(path).select(fields.decode(F.col(column)).alias("value"))
    return reader.load(path).select("value")


def publish_lines(lines: DataFrame, servers: str, topic: str) -> None:
    """Send column ``value`` to a topic, in parallel from all partitions.

    Needs Spark's Kafka connector on the class path.
    """
    (
        lines.select(F.col("value").cast("binary").alias("value"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
