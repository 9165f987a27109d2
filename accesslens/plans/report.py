"""All batch analyses of a log table."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame

from accesslens.operators import not_found, quality, traffic

# Of the table as parsed.
PROFILE = {
    "missing_values": quality.count_missing_per_column,
    "incomplete_rows": quality.count_incomplete_rows,
}

# Of rows with a status, sizes filled.
ANALYSES = {
    "shape": quality.table_shape,
    "content_size_describe": traffic.content_size_describe,
    "content_size_stats": traffic.content_size_stats,
    "status_frequency": traffic.status_frequency,
    "distinct_statuses": traffic.distinct_status_count,
    "status_by_frequency": traffic.status_by_frequency,
    "top_ok_endpoints": traffic.top_ok_endpoints,
    "host_frequency": traffic.host_frequency,
    "top_endpoints": traffic.top_endpoints,
    "top_error_endpoints": traffic.top_error_endpoints,
    "unique_hosts": traffic.unique_host_count,
    "daily_unique_hosts": traffic.daily_unique_hosts,
    "avg_daily_requests_per_host": traffic.avg_daily_requests_per_host,
    "not_found_total": not_found.not_found_total,
    "top_not_found_endpoints": partial(not_found.not_found_by_endpoint, k=20),
    "top_not_found_hosts": partial(not_found.not_found_by_host, k=20),
    "not_found_by_day": not_found.not_found_by_day,
    "top_not_found_days": not_found.top_not_found_days,
    "not_found_by_hour": not_found.not_found_by_hour,
    "busiest_endpoint_by_weekday": traffic.busiest_endpoint_by_weekday,
    "not_found_by_weekday": not_found.not_found_by_weekday,
}


def report(logs: DataFrame) -> dict[str, DataFrame]:
    """Lazy results of all analyses of a log table as parsed, by name."""
    clean = quality.clean_batch(logs)
    profile = {name: analyse(logs) for name, analyse in PROFILE.items()}
    return profile | {name: analyse(clean) for name, analyse in ANALYSES.items()}
