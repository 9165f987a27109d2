"""Frequent items from merged sketches against exact counts, with few items tracked."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from accesslens.plans import frequent
from accesslens.session import new_folder

TRACKED = 2048  # of 5,000 hosts
COLUMNS = "host string, endpoint string, status int"


@pytest.fixture(scope="module")
def requests(spark):
    """A third from one host, every seventh from 20 others, the rest spread over thousands."""
    i = F.col("id")
    host = (
        F.when(i % 3 == 0, "hot")
        .when(i % 7 == 0, F.concat(F.lit("warm"), (i % 20).cast("string")))
        .otherwise(F.concat(F.lit("h"), (i * 7919 % 5000).cast("string")))
    )
    status = F.when(i % 5 == 0, 404).otherwise(200)
    return spark.range(0, 60_000, 1, 8).select(
        "id", host.alias("host"), F.concat(F.lit("/"), i % 11).alias("endpoint"), status.alias("status")
    )


def _exact(rows, key):
    return Counter(r[0] for r in rows.select(key).collect())


def _check(found, column, true, k):
    rows = found.collect()
    for row in rows:
        assert row["at_least"] <= true[row[column]] <= row["count"]
    assert [r["count"] for r in rows] == sorted((r["count"] for r in rows), reverse=True)
    bound = max(r["count"] - r["at_least"] for r in rows)
    ranked = [n for _, n in true.most_common(k)]
    for row, n in zip(rows, ranked):
        assert n <= row["count"] <= n + bound
    # a list is short only if the next has no more than twice the bound
    assert len(rows) == min(k, len(true)) or ranked[len(rows)] <= 2 * bound


def test_merged_batches_are_within_the_bound(spark, requests):
    root = new_folder(spark, "frequent")
    for n in (0, 1, 2, 1):  # one batch comes twice
        frequent.add_batch(requests.filter(F.col("id") % 3 == n), root, n, TRACKED)
    read = frequent.read_sketches(spark, root)
    assert read.count() == 3
    assert frequent.most_frequent(read, "hosts", 5).count() == 5
    _check(frequent.most_frequent(read, "hosts", 5), "host", _exact(requests, "host"), 5)
    _check(frequent.most_frequent(read, "hosts", 100), "host", _exact(requests, "host"), 100)
    _check(frequent.most_frequent(read, "endpoints", 20), "endpoint", _exact(requests, "endpoint"), 20)
    errors = _exact(requests.filter("status <> 200"), "endpoint")
    _check(frequent.most_frequent(read, "error_endpoints", 3), "endpoint", errors, 3)
    last = frequent.read_sketches(spark, root, first=1)
    part = _exact(requests.filter("id % 3 >= 1"), "host")
    _check(frequent.most_frequent(last, "hosts", 5), "host", part, 5)


def test_what_is_not_sure_is_not_listed(spark, requests):
    made = frequent.sketched(requests, 64)
    found = frequent.most_frequent(made, "hosts", 5)
    assert [r["host"] for r in found.collect()] == ["hot"]
    _check(found, "host", _exact(requests, "host"), 5)


def test_a_sketch_has_a_bounded_size(spark, requests):
    size = "length(hosts.sketch)"
    few = frequent.sketched(requests, TRACKED).selectExpr(size).first()[0]
    many = requests.withColumn("host", F.concat("host", F.col("id").cast("string")))
    assert frequent.sketched(many, TRACKED).selectExpr(size).first()[0] < 2 * few + 4096


def test_nulls_and_no_logs(spark):
    rows = [(None, "/a", 404), ("", None, 404), ("x", "/a", None), ("x", "/b", 500)]
    made = frequent.sketched(spark.createDataFrame(rows, COLUMNS))
    tops = {name: frequent.most_frequent(made, name).collect() for name in frequent.LISTS}
    assert [tuple(r)[:2] for r in tops["hosts"]] == [("x", 2), ("", 1)]
    assert [tuple(r)[:2] for r in tops["endpoints"]] == [("/a", 2), ("/b", 1)]
    assert [tuple(r)[:2] for r in tops["error_endpoints"]] == [("/a", 1), ("/b", 1)]
    none = frequent.sketched(spark.createDataFrame([], COLUMNS))
    assert none.count() == 1
    for name in frequent.LISTS:
        assert frequent.most_frequent(none, name).count() == 0
    both = none.unionByName(made)
    assert frequent.most_frequent(both, "hosts").first()["host"] == "x"


def test_unfinished_and_unlike_batches(spark, requests):
    root = new_folder(spark, "frequent")
    frequent.add_batch(requests.limit(10), root, 0, TRACKED)
    frequent.add_batch(requests.limit(10), root, 1, 2 * TRACKED)
    assert frequent.read_sketches(spark, root, first=2).count() == 0
    with pytest.raises(Exception, match="(?i)top_?k|sketch"):
        frequent.most_frequent(frequent.read_sketches(spark, root), "hosts").collect()


def test_one_scan_and_partial_sketches(spark, requests, tmp_path):
    requests.drop("id").write.parquet(f"{tmp_path}/logs")
    made = frequent.sketched(spark.read.parquet(f"{tmp_path}/logs"))
    text = made._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "partial_approx_top_k_accumulate" in text
