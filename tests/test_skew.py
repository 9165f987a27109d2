"""A third of all rows from one host to one endpoint on one day, counted by hand too."""

from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest

from accesslens.functions.parse import parse_logs
from accesslens.operators import not_found, traffic
from accesslens.plans import partials as exact
from accesslens.session import new_folder
from accesslens.streaming.results import write_results

ROWS = 30_000
START = datetime(2024, 1, 1)


def _request(i):
    if i % 3 == 0:
        return "hot.example.org", START, "/hot", 404
    time = START + timedelta(minutes=7 * (i % 5_000))
    return f"h{i % 2_003}.example.org", time, f"/p{i % 17}", (200, 404, 500)[i % 7 % 3]


REQUESTS = [_request(i) for i in range(ROWS)]


@pytest.fixture(scope="module")
def logs(spark):
    lines = [
        (f'{host} - - [{time}] "GET {endpoint} HTTP/1.0" {status} 5',)
        for host, time, endpoint, status in REQUESTS
    ]
    table = spark.createDataFrame(lines, "value string").repartition(8)
    return parse_logs(table, "iso").persist()


@pytest.fixture(scope="module")
def merged(spark, logs):
    root = new_folder(spark, "skew")
    hot = logs.host == "hot.example.org"
    write_results(logs.filter(hot), root, 0)
    write_results(logs.filter(~hot), root, 1)
    return exact.read_partials(spark, root)


def _rows(df):
    return {tuple(row) for row in df.collect()}


def _top(keys, k):
    ranked = sorted(Counter(keys).items(), key=lambda item: (-item[1], item[0]))
    return set(ranked[:k])


def test_top_lists(logs, merged):
    hosts = _top((r[0] for r in REQUESTS), 10)
    assert _rows(traffic.top_hosts(logs)) == hosts
    assert _rows(exact.frequent_hosts(merged)) == hosts
    errors = _top((r[2] for r in REQUESTS if r[3] != 200), 10)
    assert _rows(traffic.top_error_endpoints(logs)) == errors
    assert _rows(exact.error_endpoints(merged)) == errors


def test_days(logs, merged):
    requests, hosts = Counter(), defaultdict(set)
    for host, time, _, _ in REQUESTS:
        requests[time.day] += 1
        hosts[time.day].add(host)
    expected = {
        (day, n, len(hosts[day]), n / len(hosts[day])) for day, n in requests.items()
    }
    assert _rows(traffic.avg_daily_requests_per_host(logs)) == expected
    assert _rows(exact.avg_daily(merged)) == expected


def test_not_found(logs, merged):
    hosts = _top((r[0] for r in REQUESTS if r[3] == 404), ROWS)
    assert _rows(not_found.not_found_by_host(logs)) == hosts
    assert _rows(exact.not_found_hosts(merged)) == hosts
    hours = set(Counter(r[1].hour for r in REQUESTS if r[3] == 404).items())
    assert _rows(not_found.not_found_by_hour(logs)) == hours
    assert _rows(exact.not_found_hours(merged)) == hours


def test_unique_hosts(logs, merged):
    hosts = {r[0] for r in REQUESTS}
    assert traffic.unique_host_count(logs).first()[0] == len(hosts)
    assert _rows(exact.unique_hosts(merged)) == {(host,) for host in hosts}
