"""Streams: what is written, when it is written twice, and going on after a stop."""

import datetime
from collections import Counter

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from accesslens.catalog import AVAILABLE, lines
from accesslens.functions.parse import parse_logs
from accesslens.operators import not_found, traffic
from accesslens.plans import partials as exact
from accesslens.plans import rollup, sketches
from accesslens.session import new_folder
from accesslens.sources.streams import kafka_options, open_stream, publish_lines
from accesslens.sources.tables import batch_ids, commit_batch, read_batch, read_table, write_batch
from accesslens.streaming import replay, results, stateful


def _rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def all_lines(spark, sf_dir):
    return lines(spark, sf_dir, "iso").persist()


@pytest.fixture(scope="module")
def slices(all_lines):
    ranges = replay.batch_ranges(all_lines, "event_id", 3)
    return [all_lines.filter(F.col("event_id").between(*r)) for r in ranges]


def _start(spark, folder, **options):
    stream = open_stream(spark, "text", path=f"{folder}/lines", **options)
    return results.start_metrics(
        stream, f"{folder}/results", f"{folder}/checkpoint", trigger=AVAILABLE
    )


@pytest.fixture(scope="module")
def run(spark, slices):
    folder = new_folder(spark, "run")
    for part in slices:
        replay.deliver(part, f"{folder}/lines")
        results.run_available(_start(spark, folder))
    return folder


@pytest.fixture(scope="module")
def batch_logs(all_lines):
    return parse_logs(all_lines, "iso")


def test_every_batch_writes_every_table(spark, run):
    for table in [*exact.RESULT_TABLES, "hours", "host_days", "endpoints"]:
        batches = read_table(spark, f"{run}/results", table).select("batch_id")
        assert {row[0] for row in batches.distinct().collect()} == {0, 1, 2}, table


def test_result_schemas(spark, run):
    schemas = {
        table: read_batch(spark, f"{run}/results", table, 0).dtypes
        for table in exact.RESULT_TABLES
    }
    logged = (
        "current_time", "host", "time", "method", "endpoint", "protocol", "status",
        "content_size",
    )
    count = ("count", "bigint")
    assert schemas == {
        "content_size_summary": [
            ("min_content_size", "bigint"), ("max_content_size", "bigint"),
            ("mean_content_size", "double"), ("std_content_size", "double"),
            ("count_content_size", "bigint"),
        ],
        "missing_values": [(c, "bigint") for c in logged],
        "http_status": [("status", "int"), count],
        "frequent_hosts": [("host", "string"), count],
        "frequent_endPoints": [("endpoint", "string"), count],
        "error_endpoints": [("endpoint", "string"), count],
        "unique_hosts": [("host", "string")],
        "unique_daily_hosts": [("day", "int"), count],
        "avg_daily_reqests_per_host": [
            ("day", "int"), ("total_reqs", "bigint"), ("total_hosts", "bigint"),
            ("avg_reqs", "double"),
        ],
        "endpoints_404_count": [("endpoint", "string"), count],
        "hosts_404_count_df": [("host", "string"), count],
        "errors_by_date_sorted": [("day", "int"), count],
        "hourly_avg_errors_sorted": [("hour", "int"), count],
    }


def test_merged_counts_equal_the_batch_analyses(spark, run, batch_logs):
    p = exact.read_partials(spark, f"{run}/results")
    for merged, batch in [
        (exact.statuses(p), traffic.status_frequency(batch_logs)),
        (exact.frequent_hosts(p), traffic.top_hosts(batch_logs)),
        (exact.frequent_endpoints(p, 10), traffic.top_endpoints(batch_logs)),
        (exact.error_endpoints(p), traffic.top_error_endpoints(batch_logs)),
        (exact.unique_hosts(p), traffic.unique_hosts(batch_logs)),
        (exact.daily_hosts(p), traffic.daily_unique_hosts(batch_logs)),
        (
            exact.daily_hosts(p, "date"),
            traffic.daily_unique_hosts(batch_logs, "date"),
        ),
        (exact.avg_daily(p), traffic.avg_daily_requests_per_host(batch_logs)),
        (exact.not_found_endpoints(p), not_found.not_found_by_endpoint(batch_logs)),
        (exact.not_found_hosts(p), not_found.not_found_by_host(batch_logs)),
        (exact.not_found_days(p), not_found.not_found_by_day(batch_logs)),
        (exact.not_found_hours(p), not_found.not_found_by_hour(batch_logs)),
    ]:
        assert _rows(merged) == _rows(batch)
    merged = exact.content_sizes(p).first()
    batch = traffic.content_size_stats(batch_logs).first()
    assert merged.asDict() == pytest.approx(batch.asDict(), rel=1e-12)


def test_rolled_up_results_bound_the_exact_ones(spark, run):
    root = f"{run}/results"
    p = exact.read_partials(spark, root)
    true = dict(map(tuple, exact.frequent_hosts(p, 10**6).collect()))
    summed = rollup.hosts(spark, root, 10).collect()
    assert all(count <= true[host] for host, count in summed)
    naive = rollup.unique_hosts(spark, root).first()["host"]
    assert naive > exact.unique_hosts(p).count()
    hours = rollup.not_found_hours(spark, root).agg(F.sum("count")).first()[0]
    assert hours == rollup.status(spark, root).filter("status = 404").first()["count"]


def test_rollup_leaves_out_missing_keys_and_sums_nothing_to_zero(spark):
    root = new_folder(spark, "rollup")
    rows = spark.createDataFrame(
        [(None, 5), (200, 1), (200, 2), (500, None)], "status int, count bigint"
    )
    write_batch(rows, root, "http_status", 0)
    assert rollup.status(spark, root).isEmpty()  # not yet committed
    commit_batch(spark, root, 0)
    assert [tuple(r) for r in rollup.status(spark, root).collect()] == [
        (200, 3), (500, 0)
    ]


def test_a_batch_written_again_replaces_itself(spark, batch_logs):
    root = new_folder(spark, "twice")
    results.write_results(batch_logs, root, 7)
    first = {t: _rows(read_table(spark, root, t)) for t in exact.RESULT_TABLES}
    results.write_results(batch_logs, root, 7, keep=False)
    assert first == {t: _rows(read_table(spark, root, t)) for t in exact.RESULT_TABLES}


def _answers(spark, root):
    p = exact.read_partials(spark, root)
    results_of = [make(p) for make in exact.RESULT_TABLES.values()]
    summed = [rollup.status, rollup.hosts, rollup.unique_hosts, rollup.avg_daily,
              rollup.missing_values, rollup.content_size_per_batch]
    return [_rows(df) for df in [*results_of, *[make(spark, root) for make in summed]]]


def test_compaction_changes_no_answer(spark, slices, tmp_path):
    root = str(tmp_path / "results")
    parts = [parse_logs(part, "iso") for part in slices]
    for n in (0, 1):
        results.write_results(parts[n], root, n)
    before = _answers(spark, root)
    assert exact.compact_results(spark, root) == 1
    assert _answers(spark, root) == before
    results.write_results(parts[2], root, 2)
    before = _answers(spark, root)
    # a batch that is only half written, and a compaction that is not done
    write_batch(exact.partial_counts(parts[0]).hours, root, "hours", 3)
    assert _answers(spark, root) == before
    assert exact.compact_results(spark, root, upto=2) == 2
    assert _answers(spark, root) == before
    folders = [p.name for p in (tmp_path / "results/host_days").glob("batch_id=*")]
    assert folders == ["batch_id=2"]  # what the first compaction covers is gone
    assert exact.compact_results(spark, root, upto=2) == 2
    assert _answers(spark, root) == before
    compacted = list((tmp_path / "results/compacted_tables/2/hours").glob("*.parquet"))
    assert len(compacted) == 1


def test_a_batch_without_rows_writes_nothing(spark, batch_logs):
    root = new_folder(spark, "empty")
    results.write_results(batch_logs.filter("false"), root, 0)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_table(spark, root, "http_status")


def test_an_empty_file_is_a_batch_without_rows(spark, slices):
    folder = new_folder(spark, "empty")
    for part in (slices[0], slices[0].filter("false"), slices[1]):
        replay.deliver(part, f"{folder}/lines")
        results.run_available(_start(spark, folder))
    hours = read_table(spark, f"{folder}/results", "hours")
    per_batch = hours.groupBy("batch_id").agg(F.sum("requests")).collect()
    counts = [part.count() for part in slices[:2]]
    assert [n for _, n in sorted(map(tuple, per_batch))] == counts


def test_nothing_stays_cached(spark, batch_logs):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    results.write_results(batch_logs, new_folder(spark, "cache"), 0)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_failed_batch_is_repeated_after_restart(spark, slices, monkeypatch):
    folder = new_folder(spark, "failure")
    replay.deliver(slices[0], f"{folder}/lines")
    results.run_available(_start(spark, folder))
    replay.deliver(slices[1], f"{folder}/lines")

    real = exact.RESULT_TABLES["unique_hosts"]

    def fails(p):
        raise RuntimeError("lost")

    # Some tables of the batch are written, one fails, and so does the query.
    monkeypatch.setitem(exact.RESULT_TABLES, "unique_hosts", fails)
    with pytest.raises(StreamingQueryException, match="lost"):
        results.run_available(_start(spark, folder))
    monkeypatch.setitem(exact.RESULT_TABLES, "unique_hosts", real)

    query = _start(spark, folder)
    results.run_available(query)
    assert [p["batchId"] for p in query.recentProgress if p["numInputRows"]] == [1]
    query = _start(spark, folder)
    results.run_available(query)
    assert [p for p in query.recentProgress if p["numInputRows"]] == []

    root = f"{folder}/results"
    both = parse_logs(slices[0].unionByName(slices[1]), "iso")
    assert _rows(exact.statuses(exact.read_partials(spark, root))) == _rows(
        traffic.status_frequency(both)
    )
    for n in (0, 1):
        assert _rows(read_batch(spark, root, "unique_hosts", n)) == _rows(
            traffic.unique_hosts(parse_logs(slices[n], "iso"))
        )


def test_bounded_batches_give_the_same_totals(spark, run, batch_logs):
    folder = new_folder(spark, "bounded")
    stream = open_stream(spark, "text", path=f"{run}/lines", max_files=1)
    results.run_available(
        results.start_metrics(
            stream, f"{folder}/results", f"{folder}/checkpoint", trigger=AVAILABLE
        )
    )
    p = exact.read_partials(spark, f"{folder}/results")
    assert p.hours.select("batch_id").distinct().count() == 3
    assert _rows(exact.statuses(p)) == _rows(traffic.status_frequency(batch_logs))


def test_parquet_stream_of_bytes(spark, slices):
    folder = new_folder(spark, "parquet")
    messages = slices[0].select(F.col("value").cast("binary").alias("message"))
    messages.write.parquet(f"{folder}/in")
    stream = open_stream(
        spark, "parquet", path=f"{folder}/in", glob="*.parquet",
        column="message", column_type="binary",
    )
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**AVAILABLE)
        .start(f"{folder}/out")
    )
    results.run_available(query)
    assert _rows(spark.read.parquet(f"{folder}/out")) == _rows(slices[0].select("value"))


def test_kafka_needs_its_connector(spark, all_lines):
    assert kafka_options("localhost:9092", "logs") == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "logs",
        "startingOffsets": "earliest",
    }
    with pytest.raises(AnalysisException, match="kafka"):
        open_stream(spark, "kafka", servers="localhost:9092", topic="logs")
    with pytest.raises(AnalysisException, match="kafka"):
        publish_lines(all_lines, "localhost:9092", "logs")
    with pytest.raises(ValueError, match="kind"):
        open_stream(spark, "socket")


def test_hours_with_late_requests(spark):
    """A late request counts while its hour is open, and not after."""
    folder = new_folder(spark, "late")
    stamp = '1.2.3.4 - - [{}] "GET / HTTP/1.0" {} 1'

    def arrive(*requests):
        table = spark.createDataFrame(
            [(stamp.format(time, status),) for time, status in requests],
            "value string",
        )
        replay.deliver(table, f"{folder}/lines")
        stream = open_stream(spark, "text", path=f"{folder}/lines")
        results.run_available(
            stateful.start_hourly_totals(
                parse_logs(stream, "iso"), folder, f"{folder}/checkpoint",
                delay="2 hours", trigger=AVAILABLE,
            )
        )

    arrive(("2024-01-01 10:10:00", 200), ("2024-01-01 11:00:00", 404))
    arrive(("2024-01-01 10:59:59", 404), ("2024-01-01 14:00:00", 200))
    arrive(("2024-01-01 10:20:00", 200), ("2024-01-01 13:00:00", 200), ("none", 200))
    rows = stateful.hourly_totals(spark, folder).collect()
    at = lambda hour: datetime.datetime(2024, 1, 1, hour)
    assert sorted(map(tuple, rows)) == [
        (at(10), 2, 1), (at(11), 1, 1), (at(13), 1, 0), (at(14), 1, 0)
    ]


def test_totals_go_on_under_a_new_checkpoint(spark, slices, tmp_path):
    """After the checkpoint is lost, twice; few folders stay."""
    root = f"{tmp_path}/totals"
    counted = None
    for n, part in enumerate([slices[0], slices[1], slices[2]]):
        for repeat in range(3):
            few = part.filter(F.col("event_id") % 3 == repeat)
            replay.deliver(few, f"{tmp_path}/lines-{n}")
            logs = parse_logs(open_stream(spark, "text", path=f"{tmp_path}/lines-{n}"), "iso")
            results.run_available(
                stateful.start_continued_totals(logs, root, f"{tmp_path}/c-{n}", AVAILABLE)
            )
        counted = part if counted is None else counted.unionByName(part)
        expected = traffic.status_frequency(parse_logs(counted, "iso"))
        assert _rows(stateful.continued_totals(spark, root)) == _rows(expected)
        since = tmp_path / "totals" / stateful.CONTINUED / f"since-{n}"
        assert sorted(p.name for p in since.glob("batch_id=*")) == ["batch_id=1", "batch_id=2"]
    logs = parse_logs(open_stream(spark, "text", path=f"{tmp_path}/lines-0"), "iso")
    with pytest.raises(ValueError, match="go on"):
        stateful.start_continued_totals(logs, f"{tmp_path}/other", f"{tmp_path}/c-0")


def test_late_requests_go_to_corrections(spark):
    """They count, are told apart with their batch, and once if the batch is repeated."""
    folder = new_folder(spark, "corrections")
    at = lambda hour, day=1: datetime.datetime(2024, 1, day, hour, 20)

    def arrive(n, *requests):
        logs = spark.createDataFrame([*requests], "time timestamp_ntz, status int")
        stateful.write_hours(logs, f"{folder}/{stateful.HOURLY}", n, delay="2 hours")

    def hours():
        rows = stateful.hourly_with_late(spark, folder).collect()
        return sorted((r.hour_start.hour, r.requests, r.not_found, r.late_requests) for r in rows)

    arrive(0, (at(10), 200), (at(11), 404))
    arrive(1)
    arrive(2, (None, 200))  # neither has a request with a time
    arrive(3, (at(14), 200), (at(8), 404))  # 8 to 9 is just closed, as 11:20 was seen
    late = [(at(10), 200), (at(10), 404), (at(13), 200), (at(11), None)]
    arrive(4, *late)
    expected = [(8, 1, 1, 1), (10, 3, 1, 2), (11, 2, 1, 1), (13, 1, 0, 0), (14, 1, 0, 0)]
    assert hours() == expected
    arrive(4, *late)  # repeated after its commit, against the same watermark
    assert hours() == expected
    corrections = stateful.late_hours(spark, folder).collect()
    assert sorted((r.batch_id, r.hour_start.hour, r.requests) for r in corrections) == [
        (3, 8, 1), (4, 10, 2), (4, 11, 1)
    ]
    assert stateful.compact_hourly(spark, folder) == 4
    assert hours() == expected
    arrive(4, *late)  # a batch that was compacted comes again
    arrive(5, (at(23), 200), (at(9), 200))
    assert hours() == sorted([*expected, (9, 1, 0, 1), (23, 1, 0, 0)])


def test_a_failed_batch_of_hours_counts_once(spark, monkeypatch):
    folder = new_folder(spark, "hours")
    root = f"{folder}/{stateful.HOURLY}"
    logs = spark.createDataFrame(
        [(datetime.datetime(2024, 1, 1, 10), 404)], "time timestamp_ntz, status int"
    )
    real = stateful.commit_batch
    monkeypatch.setattr(stateful, "commit_batch", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        stateful.write_hours(logs, root, 0)
    monkeypatch.setattr(stateful, "commit_batch", real)
    stateful.write_hours(logs, root, 0)
    rows = stateful.hourly_with_late(spark, folder).collect()
    assert [tuple(r) for r in rows] == [(datetime.datetime(2024, 1, 1, 10), 1, 1, 0)]


def test_sketches_of_batches_merge(spark, slices, batch_logs):
    root = new_folder(spark, "sketch")
    for n, part in enumerate(slices):
        daily = sketches.daily_host_sketches(parse_logs(part, "iso"))
        write_batch(daily, root, "host_sketches", n)
    stored = read_table(spark, root, "host_sketches")
    true = traffic.unique_host_count(batch_logs).first()[0]
    assert sketches.estimate_hosts(stored).first()[0] == pytest.approx(true, rel=0.05)
    days = dict(map(tuple, traffic.daily_unique_hosts(batch_logs, "date").collect()))
    found = dict(map(tuple, sketches.estimate_daily_hosts(stored).collect()))
    assert found.keys() == days.keys()
    assert all(found[d] == pytest.approx(days[d], rel=0.05) for d in days)


@pytest.mark.parametrize(
    "sizes",
    [
        [], [None], [7], [5, 5, 5], [2**31 - 1] * 3 + [2**31 - 2], [0, 2**31 - 1],
        [10**9 + i for i in range(50)], [5 * 10**9 + i for i in range(20)], [10**13, 1],
    ],
)
def test_merged_deviation(spark, sizes):
    """Exact where adding up squares as doubles would lose all digits."""
    import statistics

    logs = spark.createDataFrame(
        [(datetime.datetime(2024, 1, 1, i % 24), "h", "/", 200, s)
         for i, s in enumerate(sizes)],
        "time timestamp_ntz, host string, endpoint string, status int,"
        " content_size bigint",
    )
    row = exact.content_sizes(exact.partial_counts(logs)).first()
    known = [s for s in sizes if s is not None]
    assert row["count_content_size"] == (len(known) if sizes else None)
    if known:
        assert row["mean_content_size"] == pytest.approx(
            statistics.fmean(known), rel=1e-15
        )
        assert row["min_content_size"] == min(known)
    if len(known) > 1:
        assert row["std_content_size"] == pytest.approx(
            statistics.stdev(known), rel=1e-12
        )
    else:
        assert row["std_content_size"] is None


def test_replay_numbers_any_amount_of_batches(spark, tmp_path):
    keys = spark.range(100, 30_100).withColumnRenamed("id", "event_id")
    ranges = replay.batch_ranges(keys, "event_id", 5_000)
    number = replay.batch_number(F.col("event_id"), 100, 30_099, 5_000)
    numbered = dict(keys.select("event_id", number).collect())
    assert all(numbered[first] == n == numbered[last] for n, (first, last) in enumerate(ranges))
    wide = spark.createDataFrame([(-(2**62),), (2**62,)], "k bigint")
    number = replay.batch_number(F.col("k"), -(2**62), 2**62, 7)
    assert {r[0] for r in wide.select(number).collect()} == {0, 6}
    lines = keys.select("event_id", F.col("event_id").cast("string").alias("value"))
    replay.stage_batches(lines.repartition(16), "event_id", 3, f"{tmp_path}/staged")
    folders = list((tmp_path / "staged").glob("batch_id=*"))
    assert len(folders) == 3
    assert all(len(list(folder.glob("part-*"))) == 1 for folder in folders)


def test_a_processing_time_trigger_takes_files_in_batches(spark, tmp_path):
    source, root = f"{tmp_path}/lines", f"{tmp_path}/results"
    for part in range(3):
        lines = spark.range(part * 10, part * 10 + 10).select(
            F.format_string('a.bc - - [2024-01-01 00:00:00] "GET /x" 200 %d', "id").alias("value")
        )
        replay.deliver(lines.coalesce(1), source)
    stream = open_stream(spark, "text", path=source, max_files=1)
    query = results.start_metrics(
        stream, root, f"{tmp_path}/checkpoint", trigger={"processingTime": "1 second"}, keep=False
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert batch_ids(spark, root) == [0, 1, 2]
    rows = exact.statuses(exact.read_partials(spark, root)).collect()
    assert [tuple(row) for row in rows] == [(200, 30)]


def test_replay_cuts_into_equal_ranges(spark):
    keys = spark.range(10, 21)
    assert replay.batch_ranges(keys, "id", 4) == [(10, 12), (13, 15), (16, 18), (19, 20)]
    assert replay.batch_ranges(keys.filter("false"), "id", 4) == []
    assert replay.batch_ranges(keys.limit(1), "id", 2) == [(10, 10), (11, 10)]
