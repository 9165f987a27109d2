"""Jobs as they are submitted."""

from collections import Counter

import pytest
from pyspark.errors import AnalysisException

from accesslens import jobs
from accesslens.catalog import QUERIES, lines, stream_run
from accesslens.plans.report import ANALYSES, PROFILE
from accesslens.sources.text import write_lines

# Analyses that are also queries, under the names they have there.
QUERY_OF = {name: name for name in ANALYSES} | {
    "missing_values": "count_missing_per_column",
    "incomplete_rows": "count_incomplete_rows",
    "shape": "table_shape",
    "distinct_statuses": "distinct_status_count",
    "unique_hosts": "unique_host_count",
}


def _rows(df):
    rounded = [
        tuple(round(v, 2) if isinstance(v, float) else v for v in row)
        for row in df.collect()
    ]
    return Counter(rounded)


def test_batch_job(spark, sf_dir, tmp_path):
    write_lines(lines(spark, sf_dir), f"{tmp_path}/in", compression="gzip")
    arguments = ["batch", f"{tmp_path}/in", f"{tmp_path}/out/", "--glob", "*.gz"]
    jobs.main(arguments)
    jobs.main([*arguments, "--partitions", "4"])  # again, in place of the first
    for name in [*PROFILE, *ANALYSES]:
        written = spark.read.parquet(f"{tmp_path}/out/{name}")
        assert _rows(written) == _rows(QUERIES[QUERY_OF[name]](spark, sf_dir)), name


def test_batch_job_of_iso_lines_by_date(spark, sf_dir, tmp_path):
    write_lines(lines(spark, sf_dir, "iso"), f"{tmp_path}/in")
    jobs.main(["batch", f"{tmp_path}/in", f"{tmp_path}/out", "--style", "iso", "--by-date"])
    for name in [*PROFILE, *ANALYSES]:
        if name in ("shape", "busiest_endpoint_by_weekday", "not_found_by_weekday"):
            continue  # weekdays of garbage lines are unknown either way
        written = spark.read.parquet(f"{tmp_path}/out/{name}")
        assert _rows(written) == _rows(QUERIES[QUERY_OF[name]](spark, sf_dir)), name


def test_results_job(spark, sf_dir, tmp_path):
    root = f"{stream_run(spark, sf_dir)}/results"
    jobs.main(["results", root, f"{tmp_path}/out"])
    assert set(jobs.EXACT) == {p.name for p in (tmp_path / "out/exact").iterdir()}
    assert set(jobs.SUMMED) == {p.name for p in (tmp_path / "out/summed").iterdir()}
    hosts = spark.read.parquet(f"{tmp_path}/out/exact/frequent_hosts")
    assert _rows(hosts) == _rows(QUERIES["hosts_exact_topk"](spark, sf_dir))
    hosts = spark.read.parquet(f"{tmp_path}/out/summed/hosts")
    assert _rows(hosts) == _rows(QUERIES["hosts_batch_rollup"](spark, sf_dir))


def test_jobs_on_topics_need_the_connector(spark, tmp_path, sf_dir):
    write_lines(lines(spark, sf_dir), f"{tmp_path}/in")
    for arguments in (
        ["stream", "localhost:9092", "logs", f"{tmp_path}/out", "--max-offsets", "9"],
        ["publish", f"{tmp_path}/in", "localhost:9092", "logs"],
    ):
        with pytest.raises(AnalysisException, match="kafka"):
            jobs.main(arguments)


def test_job_must_be_known():
    with pytest.raises(SystemExit):
        jobs.main(["serve"])
