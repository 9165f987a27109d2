"""Jobs for ``spark-submit``: analyse stored logs, follow a topic, sum up, fill a topic.

    spark-submit ... accesslens/jobs.py batch  hdfs:///logs hdfs:///report --glob '*.gz'
    spark-submit ... accesslens/jobs.py stream broker:9092 logs hdfs:///output
    spark-submit ... accesslens/jobs.py results hdfs:///output hdfs:///report
    spark-submit ... accesslens/jobs.py compact hdfs:///output
    spark-submit ... accesslens/jobs.py totals  hdfs:///output hdfs:///report
    spark-submit ... accesslens/jobs.py publish hdfs:///logs/access.log broker:9092 logs

``stream`` and ``publish`` need Spark's Kafka connector (``--packages``).
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from accesslens.functions import fields
from accesslens.functions.parse import parse_logs
from accesslens.plans import partials, rollup, totals
from accesslens.plans.one_scan import write_report
from accesslens.session import build_session
from accesslens.sources.streams import MAX_OFFSETS, open_stream, publish_lines
from accesslens.sources.tables import land_clustered, land_logs
from accesslens.sources.text import read_lines
from accesslens.streaming.results import start_metrics


def run_batch(
    spark: SparkSession,
    lines: DataFrame,
    root: str,
    style: str = "clf",
    by_date: bool = False,
    clustered: str | None = None,
) -> None:
    """Write the parsed logs to ``root/logs`` and every analysis next to them.

    They are in folders ``by_date``, or ``clustered`` by a column, or as they come.

    Lines are parsed once, and what was landed is counted in two scans of the columns that are
    used; the analyses are made of the counts in ``root/counts``. Run again, it replaces what
    it wrote.
    """
    parsed = parse_logs(lines, style)
    if style == "iso":  # analyses of weekdays need them; when it was read says nothing
        weekday = fields.day_of_week("time").alias("day_of_week")
        parsed = parsed.select(weekday, "time", *parsed.columns[1:2], *parsed.columns[3:])
    if clustered:
        land_clustered(parsed, f"{root}/logs", clustered)
    else:
        land_logs(parsed, f"{root}/logs", by_date)
    landed = spark.read.parquet(f"{root}/logs").select(*parsed.columns)
    for name, result in write_report(landed, f"{root}/counts").items():
        result.write.mode("overwrite").parquet(f"{root}/{name}")


#: What a stream's result tables give over all batches: exact, and as sums of results.
EXACT = {
    "content_sizes": partials.content_sizes,
    "missing_values": partials.missing_values,
    "statuses": partials.statuses,
    "frequent_hosts": partials.frequent_hosts,
    "frequent_endpoints": partials.frequent_endpoints,
    "error_endpoints": partials.error_endpoints,
    "unique_hosts": partials.unique_hosts,
    "daily_hosts": partials.daily_hosts,
    "avg_daily": partials.avg_daily,
    "not_found_endpoints": partials.not_found_endpoints,
    "not_found_hosts": partials.not_found_hosts,
    "not_found_days": partials.not_found_days,
    "not_found_hours": partials.not_found_hours,
}
SUMMED = {
    "missing_values": rollup.missing_values,
    "content_size_per_batch": rollup.content_size_per_batch,
    "statuses": rollup.status,
    "hosts": rollup.hosts,
    "endpoints": rollup.endpoints,
    "error_endpoints": rollup.error_endpoints,
    "unique_hosts": rollup.unique_hosts,
    "daily_hosts": rollup.daily_hosts,
    "avg_daily": rollup.avg_daily,
    "not_found_endpoints": rollup.not_found_endpoints,
    "not_found_hosts": rollup.not_found_hosts,
    "not_found_days": rollup.not_found_days,
    "not_found_hours": rollup.not_found_hours,
}


def run_results(spark: SparkSession, root: str, output: str) -> None:
    """Write what the batches of a stream below ``root`` give together."""
    counts = partials.read_partials(spark, root)
    for name, result in EXACT.items():
        result(counts).write.mode("overwrite").parquet(f"{output}/exact/{name}")
    for name, summed in SUMMED.items():
        summed(spark, root).write.mode("overwrite").parquet(f"{output}/summed/{name}")


def run_totals(spark: SparkSession, root: str, output: str | None = None) -> None:
    """Add newer batches of a stream below ``root`` to its totals; write their results."""
    totals.update_totals(spark, root)
    if output:
        counts = totals.read_totals(spark, root)
        for name, result in EXACT.items():
            result(counts).write.mode("overwrite").parquet(f"{output}/exact/{name}")


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)

    batch = jobs.add_parser("batch", help="analyse stored log files")
    batch.add_argument("input")
    batch.add_argument("output")
    batch.add_argument("--glob", help="file names to read, such as *.gz")
    batch.add_argument("--partitions", type=int, help="spread few large gzip files")
    batch.add_argument("--style", choices=("clf", "iso"), default="clf")
    batch.add_argument("--large", type=int, help="spread gzip files of more bytes than this")
    layout = batch.add_mutually_exclusive_group()
    layout.add_argument("--by-date", action="store_true", help="a folder for each date")
    layout.add_argument("--clustered", metavar="COLUMN", help="sorted by a column, such as host")

    stream = jobs.add_parser("stream", help="keep result tables up to date")
    stream.add_argument("servers")
    stream.add_argument("topic")
    stream.add_argument("output")
    stream.add_argument("--checkpoint", help="default: checkpoint below the output")
    stream.add_argument("--style", choices=("clf", "iso"), default="iso")
    stream.add_argument("--every", default="10 seconds", help="time between batches")
    stream.add_argument("--max-offsets", type=int, default=MAX_OFFSETS,
                        help="messages in a batch at most (default: %(default)s)")
    stream.add_argument("--min-partitions", type=int, help="tasks that read the topic")

    results = jobs.add_parser("results", help="sum up the result tables of a stream")
    results.add_argument("input")
    results.add_argument("output")

    smaller = jobs.add_parser("compact", help="make few files of a stream's tables")
    smaller.add_argument("input")
    smaller.add_argument("--upto", type=int, help="last batch to take")

    newer = jobs.add_parser("totals", help="add newer batches to a stream's totals")
    newer.add_argument("input")
    newer.add_argument("output", nargs="?", help="where to write their results")

    publish = jobs.add_parser("publish", help="send the lines of files to a topic")
    publish.add_argument("input")
    publish.add_argument("servers")
    publish.add_argument("topic")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    job = _arguments(argv)
    spark = build_session(f"accesslens {job.job}")
    if job.job == "batch":
        lines = read_lines(spark, job.input, job.glob, False, job.partitions, job.large)
        run_batch(spark, lines, job.output.rstrip("/"), job.style, job.by_date, job.clustered)
    elif job.job == "results":
        run_results(spark, job.input.rstrip("/"), job.output.rstrip("/"))
    elif job.job == "compact":
        partials.compact_results(spark, job.input.rstrip("/"), job.upto)
    elif job.job == "totals":
        run_totals(spark, job.input.rstrip("/"), job.output and job.output.rstrip("/"))
    elif job.job == "publish":
        publish_lines(read_lines(spark, job.input), job.servers, job.topic)
    else:
        output = job.output.rstrip("/")
        lines = open_stream(
            spark, "kafka", servers=job.servers, topic=job.topic,
            max_offsets=job.max_offsets, min_partitions=job.min_partitions,
        )
        start_metrics(
            lines,
            output,
            job.checkpoint or f"{output}/checkpoint",
            job.style,
            {"processingTime": job.every},
        ).awaitTermination()


if __name__ == "__main__":
    main()
