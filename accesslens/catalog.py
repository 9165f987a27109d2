"""Every operator as a query over the given tables.

A query takes a session and the folder of the tables. Its log lines are derived
from all rows of ``events`` (or ``orders``, for results that span months).
Queries about streams deliver those lines in four batches to a folder in the
cluster's shared checkpoint folder, and run a real streaming query over it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.functions import fields
from accesslens.functions.parse import parse_logs, typed_times
from accesslens.operators import not_found, quality, traffic
from accesslens.plans import partials as exact
from accesslens.plans import frequent, host_bitmaps, one_scan, rollup, sketches, totals
from accesslens.session import new_folder
from accesslens.sources.samples import event_lines, order_lines
from accesslens.sources.streams import open_stream
from accesslens.sources.tables import land_clustered, read_as_of, read_table, write_batch
from accesslens.sources.text import read_lines, write_lines
from accesslens.streaming import replay, results, stateful

Query = Callable[[SparkSession, str], DataFrame]

BATCHES = 4
AVAILABLE = {"availableNow": True}


# -- inputs -----------------------------------------------------------------


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet")


def lines(spark: SparkSession, sf: str, style: str = "clf") -> DataFrame:
    return event_lines(_events(spark, sf), style)


def logs(spark: SparkSession, sf: str) -> DataFrame:
    """Parsed log table, as the stream sees it but with weekdays."""
    return parse_logs(lines(spark, sf))


def logs_with_line(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the line itself, from which missing text fields are known."""
    return parse_logs(lines(spark, sf), keep=[quality.LINE])


def clean_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Log table that batch analyses run on."""
    return quality.clean_batch(logs(spark, sf))


def order_logs(spark: SparkSession, sf: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    return quality.clean_batch(parse_logs(order_lines(orders)))


def _batch(spark: SparkSession, sf: str, number: tuple[int, int]) -> DataFrame:
    # A range of ids reaches the Parquet scan as a filter; a computed batch
    # number would not.
    events = _events(spark, sf).filter(F.col("event_id").between(*number))
    return event_lines(events, "iso")


def _spread_batch(spark: SparkSession, sf: str, number: tuple[int, int]) -> DataFrame:
    # The rows of a range of ids are next to each other, so few of the scan's tasks have
    # any: they are spread before they become lines, which take longer than the rows.
    events = _events(spark, sf).filter(F.col("event_id").between(*number))
    return event_lines(events.repartition("event_id", "ts"), "iso")


def _rounded(result: DataFrame, *columns: str) -> DataFrame:
    return result.withColumns({c: F.round(c, 2) for c in columns})


# -- sources and sinks ------------------------------------------------------


def scan_text_lines(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "text")
    write_lines(lines(spark, sf), folder, compression="gzip")
    return read_lines(spark, folder, glob="*.gz")


def scan_uneven_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of a large compressed file, which are spread, and of seven small ones, which aren't."""
    folder = new_folder(spark, "uneven")
    table = lines(spark, sf).select("value", (F.col("event_id") % 16).alias("part"))
    write_lines(table.filter("part < 9").coalesce(1), folder, compression="gzip")
    small = table.filter("part >= 9").repartitionByRange(7, "part")
    write_lines(small, folder, compression="gzip", mode="append")
    sizes = spark.read.format("binaryFile").load(folder).agg(F.max("length"))
    return read_lines(spark, folder, glob="*.gz", large=sizes.first()[0] // 2)


def decode_binary_lines(spark: SparkSession, sf: str) -> DataFrame:
    messages = lines(spark, sf).withColumn("value", F.col("value").cast("binary"))
    return messages.select("event_id", fields.decode("value").alias("value"))


def stamp_ingest_time(spark: SparkSession, sf: str) -> DataFrame:
    stamped = parse_logs(lines(spark, sf, "iso"), "iso")
    return stamped.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("current_time").alias("stamps"),
        F.count_if(F.col("current_time").isNull()).alias("unstamped"),
    )


def sql_over_logs(spark: SparkSession, sf: str) -> DataFrame:
    return traffic.sql_over_logs(
        clean_logs(spark, sf),
        """
        SELECT method, status, count(*) AS requests, sum(content_size) AS bytes
        FROM {logs}
        GROUP BY method, status
        """,
    )


def append_result_table(spark: SparkSession, sf: str) -> DataFrame:
    root = new_folder(spark, "append")
    ranges = replay.batch_ranges(_events(spark, sf), "event_id", BATCHES)
    batches = list(enumerate(ranges))
    for n, ids in batches + batches[2:3]:  # the third arrives twice
        batch = parse_logs(_batch(spark, sf, ids), "iso")
        write_batch(traffic.counted(batch, "status"), root, "http_status", n)
    return read_table(spark, root, "http_status")


def replay_lines_to_batches(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "replay")
    replay.stage_batches(lines(spark, sf, "iso"), "event_id", BATCHES, folder)
    staged = spark.read.text(folder)
    return staged.select(F.col("batch_id").cast("bigint").alias("batch_id"), "value")


# -- parsing ----------------------------------------------------------------


def _extract(**columns: Callable) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        found = [make("value").alias(name) for name, make in columns.items()]
        return lines(spark, sf).select("event_id", *found)

    return query


def parse_clf_logs(spark: SparkSession, sf: str) -> DataFrame:
    return parse_logs(lines(spark, sf), keep=["event_id"])


def parse_iso_logs(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_logs(lines(spark, sf, "iso"), "iso", keep=["event_id"])
    return parsed.drop("current_time")


def clf_time_with_offset(spark: SparkSession, sf: str) -> DataFrame:
    text = fields.bracketed("value")
    return lines(spark, sf).select(
        "event_id",
        fields.time_of_text(text).alias("time"),
        fields.time_of_text(text, to_utc=True).alias("time_utc"),
    )


def typed_time_projection(spark: SparkSession, sf: str) -> DataFrame:
    table = logs(spark, sf)
    return typed_times(table.withColumn("time_text", fields.time_text("time")))


def iso_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    return lines(spark, sf, "iso").select(
        "event_id", fields.iso_time("value").alias("time")
    )


# -- batch analyses ---------------------------------------------------------


def _on(table: Callable, operator: Callable, **options) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return operator(table(spark, sf), **options)

    return query


def _by_date(operator: Callable) -> Query:
    """An analysis per date, over lines that span years; the date as text."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        result = operator(order_logs(spark, sf), grain="date")
        return result.withColumn("day", F.col("day").cast("string"))

    return query


def content_size_stats(spark: SparkSession, sf: str) -> DataFrame:
    result = traffic.content_size_stats(clean_logs(spark, sf))
    return _rounded(result, "mean_content_size", "std_content_size")


def content_size_describe(spark: SparkSession, sf: str) -> DataFrame:
    result = traffic.content_size_describe(clean_logs(spark, sf))
    return _rounded(result, "content_size")


# -- streams ----------------------------------------------------------------

# Folder of delivered lines and result tables, by application and tables. The
# queries below that read results back do so from one run of the stream.
_runs: dict[tuple[str, str], str] = {}


def _deliver_and_run(
    spark: SparkSession, sf: str, folder: str, start: Callable, runs: int = BATCHES
) -> None:
    """Deliver the lines in batches, starting the query again after each one."""
    for ids in replay.batch_ranges(_events(spark, sf), "event_id", runs):
        replay.deliver(_batch(spark, sf, ids), f"{folder}/lines")
        results.run_available(start(open_stream(spark, "text", path=f"{folder}/lines")))


def _start_metrics(folder: str) -> Callable:
    def start(stream: DataFrame):
        return results.start_metrics(
            stream, f"{folder}/results", f"{folder}/checkpoint", trigger=AVAILABLE
        )

    return start


def stream_run(spark: SparkSession, sf: str) -> str:
    """Folder with ``lines`` in four batches and ``results`` of streaming them."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _runs:
        folder = new_folder(spark, "stream")
        _deliver_and_run(spark, sf, folder, _start_metrics(folder))
        _runs[key] = folder
    return _runs[key]


def stream_all_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Runs the stream; rows each batch wrote to each of the result tables."""
    folder = new_folder(spark, "stream")
    _deliver_and_run(spark, sf, folder, _start_metrics(folder))
    _runs[(spark.sparkContext.applicationId, sf)] = folder
    written = None
    for table in exact.RESULT_TABLES:
        rows = read_table(spark, f"{folder}/results", table)
        rows = rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"))
        rows = rows.select(F.lit(table).alias("table_name"), "batch_id", "rows")
        written = rows if written is None else written.unionByName(rows)
    return written


def stream_source_lines(spark: SparkSession, sf: str) -> DataFrame:
    source = stream_run(spark, sf)
    folder = new_folder(spark, "source")
    stream = open_stream(spark, "text", path=f"{source}/lines")
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**AVAILABLE)
        .start(f"{folder}/lines")
    )
    results.run_available(query)
    return spark.read.parquet(f"{folder}/lines")


def stream_resume_from_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs with new input and one without: requests per batch."""
    folder = new_folder(spark, "resume")
    start = _start_metrics(folder)
    _deliver_and_run(spark, sf, folder, start, runs=2)
    results.run_available(start(open_stream(spark, "text", path=f"{folder}/lines")))
    hours = read_table(spark, f"{folder}/results", "hours")
    return hours.groupBy("batch_id").agg(F.sum("requests").alias("requests"))


def stream_status_complete(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "status")

    def start(stream: DataFrame):
        return stateful.start_status_totals(
            parse_logs(stream, "iso"), folder, f"{folder}/checkpoint", AVAILABLE
        )

    _deliver_and_run(spark, sf, folder, start)
    return stateful.status_totals(spark, folder)


def stream_status_continued(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of four batches, of which the last two come under another checkpoint."""
    folder = new_folder(spark, "continued")
    for n, ids in enumerate(replay.batch_ranges(_events(spark, sf), "event_id", BATCHES)):
        source, checkpoint = f"{folder}/lines-{n // 2}", f"{folder}/checkpoint-{n // 2}"
        replay.deliver(_batch(spark, sf, ids), source)
        logs = parse_logs(open_stream(spark, "text", path=source), "iso")
        query = stateful.start_continued_totals(logs, folder, checkpoint, AVAILABLE)
        results.run_available(query)
    return stateful.continued_totals(spark, folder)


def stream_hourly_windowed(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "hourly")

    def start(stream: DataFrame):
        return stateful.start_hourly_totals(
            parse_logs(stream, "iso"), folder, f"{folder}/checkpoint", trigger=AVAILABLE
        )

    _deliver_and_run(spark, sf, folder, start)
    return stateful.hourly_totals(spark, folder)


def stream_hourly_with_late(spark: SparkSession, sf: str) -> DataFrame:
    """Hours of a stream whose second quarter comes after the third, days behind it."""
    folder = new_folder(spark, "late")
    first, second, third, last = replay.batch_ranges(_events(spark, sf), "event_id", BATCHES)
    for ids in (first, third, second, last):
        replay.deliver(_batch(spark, sf, ids), f"{folder}/lines")
        logs = parse_logs(open_stream(spark, "text", path=f"{folder}/lines"), "iso")
        query = stateful.start_hourly_with_late(
            logs, folder, f"{folder}/checkpoint", trigger=AVAILABLE
        )
        results.run_available(query)
    return stateful.hourly_with_late(spark, folder)


def _stored(read: Callable, *rounded: str) -> Query:
    """A query over the result tables of the stream."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        return _rounded(read(spark, f"{stream_run(spark, sf)}/results"), *rounded)

    return query


def _merged(read: Callable, *rounded: str) -> Query:
    """A query over the partial counts of all batches of the stream."""
    return _stored(lambda spark, root: read(exact.read_partials(spark, root)), *rounded)


def read_result_table(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "http_status")


def read_results_as_of(spark: SparkSession, root: str) -> DataFrame:
    """A result table as it was after the second batch."""
    return read_as_of(spark, root, "http_status", batch_id=1)


def daily_hosts_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Hosts per day from totals that were updated after each batch.

    The third batch comes with the lines of the second first, and then again with its own.
    """
    root = new_folder(spark, "totals")
    ranges = replay.batch_ranges(_events(spark, sf), "event_id", BATCHES)
    order = [(n, ids) for n, ids in enumerate(ranges)]
    order[2:2] = [(2, ids) for ids in ranges[1:2]]
    for n, ids in order:
        batch = parse_logs(_spread_batch(spark, sf, ids), "iso")
        results.write_results(batch, root, n)
        totals.update_totals(spark, root)
    return exact.daily_hosts(totals.read_totals(spark, root))


def _close_ranks(name: str, k: int, exact_list: Callable) -> Query:
    """Whether sketches of four batches, the third written twice, give the k largest counts.

    Next to each rank the exact count.
    """

    def query(spark: SparkSession, sf: str) -> DataFrame:
        root = new_folder(spark, "frequent")
        ranges = list(enumerate(replay.batch_ranges(_events(spark, sf), "event_id", BATCHES)))
        for n, ids in ranges + ranges[2:3]:
            frequent.add_batch(parse_logs(_batch(spark, sf, ids), "iso"), root, n)
        found = frequent.most_frequent(frequent.read_sketches(spark, root), name, k)
        about = [(row["count"], row["at_least"]) for row in found.collect()]  # k
        true = exact_list(logs(spark, sf)).agg(
            F.sort_array(F.collect_list("count"), asc=False).alias("counts")  # k
        )
        ranks = [
            F.struct(
                F.lit(rank).alias("rank"),
                F.get("counts", F.lit(rank - 1)).alias("count"),
                F.get("counts", F.lit(rank - 1)).between(least, most).alias("close"),
            )
            for rank, (most, least) in enumerate(about, 1)
        ]
        if not ranks:
            return true.selectExpr("0 AS rank", "0L AS count", "true AS close").limit(0)
        return true.select(F.inline(F.array(*ranks)))

    return query


def host_requests_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """One host's requests from logs that were landed by host."""
    folder = f"{new_folder(spark, 'landed')}/logs"
    land_clustered(parse_logs(lines(spark, sf), keep=["event_id"]), folder)
    landed = spark.read.parquet(folder)
    return landed.filter(F.col("host") == "localhost").select(
        "event_id", "time", "method", "endpoint", "status", "content_size"
    )


def daily_hosts_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    """Hosts per day from the bitmaps of four batches; the third is written twice."""
    root = new_folder(spark, "bitmaps")
    ranges = list(enumerate(replay.batch_ranges(_events(spark, sf), "event_id", BATCHES)))
    for n, ids in ranges + ranges[2:3]:
        host_bitmaps.add_hosts(parse_logs(_batch(spark, sf, ids), "iso"), root, n)
    return host_bitmaps.daily_hosts(spark, root)


def close_size_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Whether ranks of sizes from merged hourly sketches are within the error they state."""
    table = logs(spark, sf)
    quantiles = sketches.size_quantiles(sketches.hourly_size_sketches(table), (0.5, 0.9, 0.99))
    size, error = F.col("content_size"), sketches.RANK_ERROR
    rows = []
    for quantile, found in quantiles.collect():  # three
        known = F.count(size)
        close = (F.count_if(size < found) <= known * (quantile + error)) & (
            F.count_if(size <= found) >= known * (quantile - error)
        )
        rows.append(F.struct(
            F.lit(quantile).alias("quantile"), known.alias("known"), close.alias("close")
        ))
    return table.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


#: Analyses with a key and a count, under the names they have as queries.
COUNTED = {
    "status_frequency": "status",
    "top_ok_endpoints": "endpoint",
    "host_frequency": "host",
    "top_endpoints": "endpoint",
    "top_error_endpoints": "endpoint",
    "daily_unique_hosts": "day",
    "top_not_found_endpoints": "endpoint",
    "top_not_found_hosts": "host",
    "not_found_by_day": "day",
    "top_not_found_days": "day",
    "not_found_by_hour": "hour",
    "busiest_endpoint_by_weekday": "day_of_week",
    "not_found_by_weekday": "day_of_week",
}


def report_in_two_scans(spark: SparkSession, sf: str) -> DataFrame:
    """The analyses that have a key and a count, one below the other, of the same counts."""
    analyses = one_scan.write_report(logs(spark, sf), new_folder(spark, "report"))
    rows = [
        analyses[name].select(
            F.lit(name).alias("analysis"), F.col(key).cast("string").alias("key"), "count"
        )
        for name, key in COUNTED.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def close_unique_host_count(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the approximate number of hosts is within 5 % of the exact one."""
    table = clean_logs(spark, sf)
    about = traffic.approx_unique_host_count(table).withColumnRenamed("unique_hosts", "about")
    rows = traffic.unique_host_count(table).unionByName(about, allowMissingColumns=True)
    both = rows.agg(F.max("unique_hosts").alias("unique_hosts"), F.max("about").alias("about"))
    close = F.abs(F.col("about") - F.col("unique_hosts")) <= F.col("unique_hosts") * 0.05
    return both.select("unique_hosts", close.alias("close"))


PREVIEW_ORDER = (
    "day_of_week", "time", "host", "method", "endpoint", "protocol", "status",
    "content_size",
)
SIZE_DOUBLES = ("mean_content_size", "std_content_size")

QUERIES: dict[str, Query] = {
    # sources and sinks
    "scan_text_lines": scan_text_lines,
    "scan_uneven_lines": scan_uneven_lines,
    "stream_source_lines": stream_source_lines,
    "decode_binary_lines": decode_binary_lines,
    "stamp_ingest_time": stamp_ingest_time,
    "sql_over_logs": sql_over_logs,
    "read_result_table": _stored(read_result_table),
    "read_results_as_of": _stored(read_results_as_of),
    "append_result_table": append_result_table,
    "host_requests_pruned": host_requests_pruned,
    "replay_lines_to_batches": replay_lines_to_batches,
    "stream_resume_from_checkpoint": stream_resume_from_checkpoint,
    # parsing
    "parse_clf_logs": parse_clf_logs,
    "parse_iso_logs": parse_iso_logs,
    "extract_host": _extract(host=fields.host),
    "extract_request": _extract(
        method=fields.method, endpoint=fields.endpoint, protocol=fields.protocol
    ),
    "extract_status": _extract(status=fields.status),
    "extract_content_size": _extract(content_size=fields.content_size),
    "clf_timestamp": _extract(timestamp=lambda v: fields.time_text(fields.clf_time(v))),
    "clf_day_of_week": _extract(
        day_of_week=lambda v: fields.day_of_week(fields.clf_date(v))
    ),
    "clf_time_with_offset": clf_time_with_offset,
    "typed_time_projection": typed_time_projection,
    "iso_timestamp": iso_timestamp,
    "status_chart_series": _on(clean_logs, traffic.status_chart_series),
    # data quality
    "valid_status_rows": _on(logs, quality.valid_status_rows),
    "count_incomplete_rows": _on(logs_with_line, quality.count_incomplete_rows),
    "count_missing_per_column": _on(logs_with_line, quality.count_missing_per_column),
    "count_blank_per_column": _on(
        logs, quality.count_missing_per_column, blank_as_missing=True
    ),
    "fill_missing_size": _on(logs, quality.fill_missing_size),
    "not_found_rows": _on(clean_logs, not_found.not_found_rows),
    "table_shape": _on(clean_logs, quality.table_shape),
    "preview_rows": _on(clean_logs, quality.preview_rows, order_by=PREVIEW_ORDER),
    # sizes and statuses
    "content_size_stats": content_size_stats,
    "content_size_describe": content_size_describe,
    "status_frequency": _on(clean_logs, traffic.status_frequency),
    "distinct_status_count": _on(clean_logs, traffic.distinct_status_count),
    "status_by_frequency": _on(clean_logs, traffic.status_by_frequency),
    # hosts and endpoints
    "top_ok_endpoints": _on(clean_logs, traffic.top_ok_endpoints),
    "host_frequency": _on(clean_logs, traffic.host_frequency),
    "top_hosts": _on(clean_logs, traffic.top_hosts),
    "top_endpoints": _on(clean_logs, traffic.top_endpoints),
    "top_error_endpoints": _on(clean_logs, traffic.top_error_endpoints),
    "unique_host_count": _on(clean_logs, traffic.unique_host_count),
    "unique_hosts": _on(clean_logs, traffic.unique_hosts),
    "close_unique_host_count": close_unique_host_count,
    # days
    "host_day_pairs": _on(clean_logs, traffic.host_day_pairs),
    "daily_unique_hosts": _on(clean_logs, traffic.daily_unique_hosts),
    "daily_requests": _on(clean_logs, traffic.daily_requests),
    "avg_daily_requests_per_host": _on(
        clean_logs, traffic.avg_daily_requests_per_host
    ),
    "daily_unique_hosts_over_months": _on(order_logs, traffic.daily_unique_hosts),
    "daily_unique_hosts_by_date": _by_date(traffic.daily_unique_hosts),
    "daily_requests_by_date": _by_date(traffic.daily_requests),
    "avg_daily_requests_per_host_by_date": _by_date(
        traffic.avg_daily_requests_per_host
    ),
    "busiest_endpoint_by_weekday": _on(
        clean_logs, traffic.busiest_endpoint_by_weekday
    ),
    # 404s
    "not_found_total": _on(clean_logs, not_found.not_found_total),
    "not_found_by_endpoint": _on(clean_logs, not_found.not_found_by_endpoint),
    "top_not_found_endpoints": _on(clean_logs, not_found.not_found_by_endpoint, k=20),
    "not_found_by_host": _on(clean_logs, not_found.not_found_by_host),
    "top_not_found_hosts": _on(clean_logs, not_found.not_found_by_host, k=20),
    "not_found_by_day": _on(clean_logs, not_found.not_found_by_day),
    "top_not_found_days": _on(clean_logs, not_found.top_not_found_days),
    "not_found_by_hour": _on(clean_logs, not_found.not_found_by_hour),
    "not_found_by_weekday": _on(clean_logs, not_found.not_found_by_weekday),
    "report_in_two_scans": report_in_two_scans,
    # streams
    "stream_all_metrics": stream_all_metrics,
    "stream_status_complete": stream_status_complete,
    "stream_status_continued": stream_status_continued,
    "stream_hourly_windowed": stream_hourly_windowed,
    "stream_hourly_with_late": stream_hourly_with_late,
    # finished results of batches, rolled up
    "missing_values_batch_rollup": _stored(rollup.missing_values),
    "content_size_per_batch": _stored(rollup.content_size_per_batch, *SIZE_DOUBLES),
    "status_batch_rollup": _stored(rollup.status),
    "hosts_batch_rollup": _stored(rollup.hosts),
    "endpoints_batch_rollup": _stored(rollup.endpoints),
    "error_endpoints_batch_rollup": _stored(rollup.error_endpoints),
    "unique_hosts_batch_rollup": _stored(rollup.unique_hosts),
    "daily_hosts_batch_rollup": _stored(rollup.daily_hosts),
    "avg_daily_batch_rollup": _stored(rollup.avg_daily),
    "not_found_endpoints_batch_rollup": _stored(rollup.not_found_endpoints),
    "not_found_hosts_batch_rollup": _stored(rollup.not_found_hosts),
    "not_found_day_batch_rollup": _stored(rollup.not_found_days),
    "not_found_hour_batch_rollup": _stored(rollup.not_found_hours),
    # partial counts of batches, merged
    "hosts_exact_topk": _merged(exact.frequent_hosts),
    "endpoints_exact_topk": _merged(exact.frequent_endpoints),
    "error_endpoints_exact_topk": _merged(exact.error_endpoints),
    "unique_hosts_exact": _merged(
        lambda p: exact.unique_hosts(p).agg(F.count(F.lit(1)).alias("unique_hosts"))
    ),
    "daily_hosts_exact": _merged(exact.daily_hosts),
    "daily_hosts_incremental": daily_hosts_incremental,
    "daily_hosts_bitmap": daily_hosts_bitmap,
    "close_size_quantiles": close_size_quantiles,
    "close_top_hosts": _close_ranks("hosts", 10, traffic.top_hosts),
    "close_top_endpoints": _close_ranks("endpoints", 10, traffic.top_endpoints),
    "close_top_error_endpoints": _close_ranks(
        "error_endpoints", 10, traffic.top_error_endpoints
    ),
    "avg_daily_exact": _merged(exact.avg_daily),
    "content_size_merged": _merged(exact.content_sizes, *SIZE_DOUBLES),
}
