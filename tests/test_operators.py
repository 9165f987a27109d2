"""Rules of the operators that the oracle's tables do not show."""

import datetime
from collections import Counter

import pytest
from pyspark.sql import functions as F

from accesslens import session
from accesslens.catalog import clean_logs, logs
from accesslens.functions import fields, patterns
from accesslens.functions.parse import parse_logs
from accesslens.operators import not_found, quality, traffic
from accesslens.sources.tables import (
    land_logs,
    batch_ids,
    commit_batch,
    read_committed,
    read_last,
    read_batch,
    read_table,
    write_batch,
)
from accesslens.sources.text import read_lines, write_lines

LINE = '{host} - - [{time} -0400] "GET {endpoint} HTTP/1.0" {status} {size}'


def _logs(spark, *rows):
    keys = ("host", "time", "endpoint", "status", "size")
    lines = [
        (None if row is None else LINE.format(**dict(zip(keys, row))),) for row in rows
    ]
    return parse_logs(spark.createDataFrame(lines, "value string"))


@pytest.fixture(scope="module")
def small(spark):
    return _logs(
        spark,
        ("a.org", "01/Jul/1995:10:00:00", "/x", 200, 10),
        ("a.org", "01/Jul/1995:11:00:00", "/y", 404, 20),
        ("b.org", "01/Aug/1995:10:00:00", "/y", 404, "-"),
        ("b.org", "02/Aug/1995:10:00:00", "/x", 500, 40),
        ("local", "31/Feb/1995:10:00:00", "/z", 404, 50),
        ("a.org", "02/Aug/1995:10:00:00", "/z", "-", 60),
        None,
    ).persist()


def _tuples(df):
    return list(map(tuple, df.collect()))


def test_missing_values(small):
    assert quality.count_incomplete_rows(small).first()[0] == 4
    missing = quality.count_missing_per_column(small).first().asDict()
    assert missing == {
        "day_of_week": 0, "time": 2, "host": 1, "method": 1, "endpoint": 1,
        "protocol": 1, "status": 2, "content_size": 2,
    }
    blank = quality.count_missing_per_column(small, blank_as_missing=True).first()
    assert blank.asDict() == missing | {"host": 2, "day_of_week": 2}
    filled = quality.fill_missing_size(small)
    assert quality.count_missing_per_column(filled).first()["content_size"] == 0
    assert filled.schema["content_size"].dataType.simpleString() == "bigint"
    assert quality.clean_batch(small).count() == 5
    assert _tuples(quality.table_shape(small)) == [(7, 8)]
    first = quality.preview_rows(small, 3, ["host"]).collect()
    assert [row["host"] for row in first] == [None, "", "a.org"]


def test_days_keep_or_join_months(small):
    clean = quality.clean_batch(small)
    july, august = datetime.date(1995, 7, 1), datetime.date(1995, 8, 1)
    assert _tuples(traffic.daily_unique_hosts(clean)) == [(None, 1), (1, 2), (2, 1)]
    assert _tuples(traffic.daily_unique_hosts(clean, "date")) == [
        (None, 1), (july, 1), (august, 1), (datetime.date(1995, 8, 2), 1)
    ]
    assert _tuples(traffic.daily_requests(clean)) == [(None, 1), (1, 3), (2, 1)]
    assert _tuples(traffic.avg_daily_requests_per_host(clean)) == [
        (1, 3, 2, 1.5), (2, 1, 1, 1.0)
    ]
    assert _tuples(not_found.not_found_by_day(clean)) == [(None, 1), (1, 2)]
    with pytest.raises(ValueError, match="grain"):
        traffic.daily_requests(clean, "week")


def test_missing_status_is_neither_ok_nor_error(small):
    assert _tuples(traffic.top_error_endpoints(small)) == [
        ("/y", 2), ("/x", 1), ("/z", 1)
    ]
    assert _tuples(traffic.top_ok_endpoints(small)) == [("/x", 1)]
    assert _tuples(traffic.status_frequency(small)) == [
        (None, 2), (200, 1), (404, 3), (500, 1)
    ]
    assert traffic.distinct_status_count(small).first()[0] == 4


def test_a_missing_host_counts_as_one(small):
    assert traffic.unique_host_count(small).first()[0] == 4
    assert traffic.approx_unique_host_count(small).first()[0] == 4


def test_ties_go_to_the_smaller_key(small):
    clean = quality.clean_batch(small)
    assert _tuples(traffic.top_endpoints(clean, 2)) == [("/x", 2), ("/y", 2)]
    busiest = dict(
        (r["day_of_week"], (r["endpoint"], r["count"]))
        for r in traffic.busiest_endpoint_by_weekday(small).collect()
    )
    assert busiest == {
        "Saturday": ("/x", 1), "Tuesday": ("/y", 1), "Wednesday": ("/x", 1)
    }


def test_unknown_weekday_counts_among_404s_only(small):
    assert ("Unknown", 404, 1) in _tuples(not_found.not_found_by_weekday(small))
    weekdays = traffic.busiest_endpoint_by_weekday(small).select("day_of_week")
    assert ("Unknown",) not in _tuples(weekdays)


def test_statistics_of_no_rows(spark, small):
    none = small.filter("false")
    assert _tuples(traffic.content_size_stats(none)) == [(None,) * 4 + (0,)]
    assert dict(_tuples(traffic.content_size_describe(none))) == {
        "count": 0.0, "mean": None, "stddev": None, "min": None, "max": None
    }
    assert _tuples(not_found.not_found_total(none)) == [(0,)]


def test_sql_leaves_no_view_behind(spark, small):
    result = traffic.sql_over_logs(
        small, "SELECT count(*) AS n FROM {logs} WHERE status = 404"
    )
    assert result.first()["n"] == 3
    assert [t.name for t in spark.catalog.listTables()] == []


def test_text_files(spark, tmp_path, sf_dir):
    lines = spark.range(1000).select(F.concat(F.lit("line "), "id").alias("value"))
    write_lines(lines.repartition(3), f"{tmp_path}/logs/a", compression="gzip")
    write_lines(lines.limit(5), f"{tmp_path}/logs/b")
    expected = Counter(r[0] for r in lines.collect())
    zipped = read_lines(spark, f"{tmp_path}/logs/*", glob="*.gz")
    assert Counter(r[0] for r in zipped.collect()) == expected
    nested = read_lines(spark, f"{tmp_path}/logs", recursive=True)
    assert nested.count() == 1005
    both = read_lines(spark, [f"{tmp_path}/logs/a", f"{tmp_path}/logs/b"])
    assert both.count() == 1005
    # A compressed file is one task's work; its lines need not be.
    one = read_lines(spark, f"{tmp_path}/logs/a", partitions=6)
    assert one.rdd.getNumPartitions() == 6
    assert Counter(r[0] for r in one.collect()) == expected


def test_latest_batch_and_pruning(spark):
    root = session.new_folder(spark, "table")
    for n in (0, 2, 1):
        write_batch(spark.range(n, n + 2), root, "t", n)
    rows = read_table(spark, root, "t")
    last = read_last(spark, root, "t")
    assert Counter(_tuples(last)) == Counter([(2,), (3,)])
    assert all("batch_id=2/" in file for file in last.inputFiles())
    assert sorted(_tuples(read_batch(spark, root, "t", 0))) == [(0,), (1,)]
    plan = rows.filter("batch_id = 1")._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "batch_id" in plan.split(
        "PartitionFilters: ["
    )[1].split("]")[0]


def test_a_batch_counts_when_it_is_committed(spark):
    root = session.new_folder(spark, "table")
    for n in (0, 1):
        write_batch(spark.range(n, n + 1), root, "t", n)
    assert batch_ids(spark, root) == []
    assert read_committed(spark, root, "t").count() == 0
    commit_batch(spark, root, 0)
    assert batch_ids(spark, root) == [0]
    assert _tuples(read_committed(spark, root, "t")) == [(0, 0)]
    with pytest.raises(ValueError, match="no batch"):
        read_last(spark, root, "nothing")


def test_counts_beyond_32_bits(spark):
    line = LINE.format(
        host="a.bc", time="01/Jan/2024:00:00:00", endpoint="/", status=200, size=3 * 10**9
    )
    rows = parse_logs(spark.createDataFrame([(line,)], "value string"))
    assert quality.clean_batch(rows).first()["content_size"] == 3_000_000_000
    many = spark.createDataFrame([(200, 3_000_000_000)], "status int, count bigint")
    series = traffic.most_frequent(many, "status").select(F.col("count"))
    assert series.first()[0] == 3_000_000_000
    assert traffic.status_chart_series(rows).schema["count"].dataType.simpleString() == "bigint"


def test_missing_text_is_known_from_the_line(spark):
    lines = spark.createDataFrame([(None,), ("x",)], "value string")
    with_line = quality.count_missing_per_column(parse_logs(lines, keep=["value"]))
    assert with_line.first() == quality.count_missing_per_column(parse_logs(lines)).first()
    table = spark.createDataFrame([("x",)], "value string").filter("length(value) > 0")
    counts = quality.count_missing_per_column(parse_logs(table, keep=["value"]))
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert patterns.STATUS in plan
    assert patterns.HOST not in plan and patterns.REQUEST not in plan


def test_landed_logs_answer_like_lines(spark, sf_dir, tmp_path):
    parsed = logs(spark, sf_dir)
    land_logs(parsed, f"{tmp_path}/flat")
    land_logs(parsed, f"{tmp_path}/by_date", by_date=True)
    flat = spark.read.parquet(f"{tmp_path}/flat")
    by_date = spark.read.parquet(f"{tmp_path}/by_date")
    assert flat.schema.simpleString() == parsed.schema.simpleString()
    assert Counter(_tuples(flat)) == Counter(_tuples(parsed))
    expected = _tuples(not_found.not_found_by_endpoint(clean_logs(spark, sf_dir)))
    for landed in (flat, by_date.drop("date")):
        result = not_found.not_found_by_endpoint(quality.clean_batch(landed))
        assert _tuples(result) == expected


def test_shared_folder_is_the_clusters(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.new_folder(spark, "x") != session.new_folder(spark, "x")


class _Cluster:
    """As much of a session as is asked about its checkpoint folder."""

    def __init__(self, master, settings=None, folder=None):
        self.settings = settings or {}
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.folder = folder

    def get(self, key, default):
        return self.settings.get(key, default)

    def getCheckpointDir(self):
        return self.folder


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(_Cluster("yarn"))
    named = _Cluster("yarn", {"spark.checkpoint.dir": "hdfs://nn/ckpt/"})
    assert session.shared_folder(named) == "hdfs://nn/ckpt"
    assert session.shared_folder(_Cluster("yarn", folder="s3a://b/c")) == "s3a://b/c"
    local = _Cluster("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)


def test_wrong_style(small, spark):
    with pytest.raises(ValueError, match="style"):
        parse_logs(spark.range(1), "csv")


def test_time_text(small):
    texts = small.select(fields.time_text("time")).distinct()
    assert ("Unknown",) in _tuples(texts) and ("1995-07-01 10:00:00",) in _tuples(texts)
