"""What Spark makes of the queries, where that decides whether they scale."""

import re

import pytest

from accesslens.catalog import QUERIES, clean_logs, logs
from accesslens.functions.parse import parse_logs
from accesslens.operators import not_found, quality, traffic
from accesslens.plans import one_scan
from accesslens.plans.report import ANALYSES, PROFILE, report
from accesslens.sources.tables import land_logs
from accesslens.sources.text import write_lines


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def text_logs(spark, sf_dir, tmp_path_factory):
    """Logs parsed from text files, whose plans are plainer than those of events."""
    from accesslens.catalog import lines

    folder = tmp_path_factory.mktemp("text")
    write_lines(lines(spark, sf_dir), f"{folder}/lines")
    return parse_logs(spark.read.text(f"{folder}/lines"))


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_no_python_and_no_cross_join(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    assert not re.search(r"Python|CartesianProduct|NestedLoopJoin", text)
    # One partition for everything only where it holds one row or k rows a task.
    for line in text.splitlines():
        if "Exchange SinglePartition" in line:
            before = text.split(line, 1)[0]
            assert re.search(r"Aggregate\(keys=\[\]", before.splitlines()[-1])


def test_top_k_sorts_no_more_than_k_rows(text_logs):
    for result in (
        traffic.top_hosts(text_logs),
        traffic.top_error_endpoints(text_logs),
        not_found.not_found_by_host(text_logs, 20),
        quality.preview_rows(text_logs, order_by=["host", "time"]),
    ):
        assert "TakeOrderedAndProject" in plan(result)
        assert "rangepartitioning" not in plan(result)


def test_only_fields_that_are_used_are_matched(text_logs):
    def matches(df):
        return plan(df).count("regexp_extract(")

    assert matches(text_logs.groupBy("status").count()) == 1
    assert matches(text_logs.groupBy("host").count()) == 1
    assert matches(quality.table_shape(text_logs)) == 0


def test_counts_are_partial_before_the_shuffle(text_logs):
    for result in (
        traffic.host_frequency(text_logs),
        traffic.daily_unique_hosts(text_logs),
        traffic.avg_daily_requests_per_host(text_logs),
    ):
        text = plan(result)
        last = text.rindex("Exchange hashpartitioning")
        assert "Aggregate(" in text[last:].split("FileScan")[0]


def test_average_is_one_scan_without_a_join(text_logs):
    text = plan(traffic.avg_daily_requests_per_host(text_logs))
    assert text.count("FileScan") == 1 and "Join" not in text
    # A filter on the day would match the line again for every part of the time.
    assert "Filter" not in text.split("HashAggregate(keys=[day")[-1].split("FileScan")[0]


def test_weekday_winners_are_cut_before_the_shuffle(text_logs):
    text = plan(traffic.busiest_endpoint_by_weekday(text_logs))
    assert "Window" not in text
    assert text.count("Exchange hashpartitioning(day_of_week") == 2


def test_landed_logs_push_filters_and_prune_columns(spark, sf_dir, tmp_path):
    land_logs(logs(spark, sf_dir), f"{tmp_path}/landed")
    landed = quality.clean_batch(spark.read.parquet(f"{tmp_path}/landed"))
    text = not_found.not_found_by_endpoint(landed)
    text = text._jdf.queryExecution().toString()
    assert "EqualTo(status,404)" in text
    assert "ReadSchema: struct<endpoint:string,status:int>" in text


def test_tables_are_read_no_wider_than_needed(spark, sf_dir):
    text = quality.table_shape(logs(spark, sf_dir))._jdf.queryExecution().toString()
    assert "ReadSchema: struct<>" in text
    clean = clean_logs(spark, sf_dir)
    assert clean.columns[0] == "day_of_week"


def test_the_report_takes_two_scans(spark, sf_dir, tmp_path, text_logs):
    """Each grouping is counted before the shuffle; no analysis reads the logs again."""
    both = [plan(make(text_logs)) for make in (one_scan.count_hours, one_scan.count_groups)]
    assert [text.count("FileScan") for text in both] == [1, 1]
    for text in both:
        assert "Aggregate(" in text.split("Exchange hashpartitioning")[-1].split("FileScan")[0]
    analyses = one_scan.write_report(logs(spark, sf_dir), f"{tmp_path}/report")
    assert set(analyses) == {*PROFILE, *ANALYSES}
    for result in analyses.values():
        files = result.inputFiles()
        assert files and all(f"{tmp_path}/report" in file for file in files)


def test_the_report_of_no_logs(spark, sf_dir, tmp_path):
    none = logs(spark, sf_dir).filter("false")
    plain = report(none)
    for name, result in one_scan.write_report(none, f"{tmp_path}/none").items():
        assert result.collect() == plain[name].collect(), name
