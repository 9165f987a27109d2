"""The same queries in SQL, for an independent engine to check results against.

Lines are built and parsed again here from the tables, in SQL only. Nothing is
shared with the Spark expressions but the meaning of the fields.
"""

from __future__ import annotations

_STAMP = {
    "clf": "strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' -0400'",
    "iso": "strftime(ts, '%Y-%m-%d %H:%M:%S')",
}


def _lines(style: str) -> str:
    return f"""
lines AS (
  SELECT event_id,
    CASE WHEN event_id % 211 = 0 THEN 'garbage ' || event_id
    ELSE
      CASE WHEN event_id % 97 = 0 THEN 'localhost'
           WHEN event_id % 2 = 0 THEN 'h' || user_id || '.example.org'
           ELSE '10.0.0.' || user_id END
      || ' - - [' || {_STAMP[style]} || '] "'
      || CASE WHEN event_type IN ('signup', 'purchase') THEN 'POST'
              WHEN event_id % 50 = 0 THEN 'HEAD' ELSE 'GET' END
      || ' /' || event_type || '/' || (props->>'$.k')
      || CASE WHEN event_id % 89 = 0 THEN '' ELSE ' HTTP/1.0' END
      || '" ' || code || ' '
      || CASE WHEN event_id % 101 = 0 OR code = '304' THEN '-'
              WHEN event_id % 103 = 0
              THEN CAST(CAST(floor(value * 100) AS BIGINT) + 3000000000 AS VARCHAR)
              ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END
    END AS value
  FROM (
    SELECT *,
      CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN '500'
           WHEN event_type = 'error' THEN '404'
           WHEN event_id % 10 = 7 THEN '304'
           WHEN event_id % 10 = 3 THEN '302'
           ELSE '200' END AS code
    FROM events
  )
)"""


_ORDER_LINES = """
lines AS (
  SELECT o_orderkey AS event_id,
    'c' || o_custkey || '.example.net - - ['
    || strftime(o_orderdate, '%d/%b/%Y:%H:%M:%S') || ' -0400] "GET /'
    || o_orderstatus || '/' || replace(o_orderpriority, ' ', '_')
    || ' HTTP/1.0" 200 ' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR)
    AS value
  FROM orders
)"""

# What the fields of a line are.
_CLF_TEXT = r"regexp_extract(value, '\[(\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2})', 1)"
_ISO_TEXT = (
    r"regexp_extract(value, '\[(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})]', 1)"
)
_DATE_TEXT = r"regexp_extract(value, '\[(\d{2}/\w{3}/\d{4})', 1)"
_REQUEST = r"""'"(\S+)\s(\S+)\s*(\S*)"'"""
_TIME = {
    "clf": f"try_strptime({_CLF_TEXT}, '%d/%b/%Y:%H:%M:%S')",
    "iso": f"try_strptime({_ISO_TEXT}, '%Y-%m-%d %H:%M:%S')",
}
_WEEKDAY = f"coalesce(dayname(try_strptime({_DATE_TEXT}, '%d/%b/%Y')), 'Unknown')"
_FIELDS = {
    "host": r"regexp_extract(value, '^(\S+\.\S\S+)\s', 1)",
    "method": f"regexp_extract(value, {_REQUEST}, 1)",
    "endpoint": f"regexp_extract(value, {_REQUEST}, 2)",
    "protocol": f"regexp_extract(value, {_REQUEST}, 3)",
    "status": r"try_cast(regexp_extract(value, '\s(\d{3})\s', 1) AS INTEGER)",
    "content_size": r"try_cast(regexp_extract(value, '\s(\d+)$', 1) AS BIGINT)",
}
_COLUMNS = ", ".join(_FIELDS)


def _parsed(style: str) -> str:
    chosen = ", ".join(f"{e} AS {name}" for name, e in _FIELDS.items())
    return f"""parsed AS (
  SELECT event_id, {_TIME[style]} AS time, {_WEEKDAY} AS day_of_week, {chosen}
  FROM lines
)"""


_CLEAN = """logs AS (
  SELECT * REPLACE (coalesce(content_size, 0) AS content_size)
  FROM parsed WHERE status IS NOT NULL
)"""


def _on_lines(select: str, style: str = "clf") -> str:
    return f"WITH {_lines(style)}\n{select}"


def _on_parsed(select: str, style: str = "clf") -> str:
    return f"WITH {_lines(style)}, {_parsed(style)}\n{select}"


def _on_clean(select: str) -> str:
    return f"WITH {_lines('clf')}, {_parsed('clf')}, {_CLEAN}\n{select}"


def _on_orders(select: str) -> str:
    return f"WITH {_ORDER_LINES}, {_parsed('clf')}, {_CLEAN}\n{select}"


def _batch(batches: int) -> str:
    return f"""((event_id - (SELECT min(event_id) FROM events)) * {batches}
    // (SELECT max(event_id) - min(event_id) + 1 FROM events))"""


def _on_batches(select: str, batches: int = 4) -> str:
    """Over ``batched``: the stream's rows with the batch each came in."""
    return f"""WITH {_lines("iso")}, {_parsed("iso")}, batched AS (
  SELECT CAST({_batch(batches)} AS BIGINT) AS batch_id,
    CAST(dayofmonth(time) AS INTEGER) AS day, CAST(hour(time) AS INTEGER) AS hour, *
  FROM parsed
)
{select}"""


_DAY = "CAST(dayofmonth(time) AS INTEGER)"
_DATE = "CAST(CAST(time AS DATE) AS VARCHAR)"
_SIZES = """min(content_size) AS min_content_size,
  max(content_size) AS max_content_size,
  round(avg(content_size), 2) AS mean_content_size,
  round(stddev_samp(content_size), 2) AS std_content_size,
  count(content_size) AS count_content_size"""


def _top(key: str, source: str, k: int | None = None) -> str:
    limit = f" LIMIT {k}" if k else ""
    return (
        f"SELECT {key}, count(*) AS count FROM {source} GROUP BY {key}"
        f" ORDER BY count DESC, {key} ASC NULLS FIRST{limit}"
    )


def _close_ranks(key: str, table: str) -> str:
    """Counts of the ten most frequent by rank, to which what is found is close."""
    return _on_parsed(f"""SELECT CAST(row_number() OVER (ORDER BY count DESC) AS INTEGER) AS rank,
      count, true AS close FROM ({_top(key, table, 10)})""")


def _total(key: str, source: str, value: str = "count", k: int | None = None) -> str:
    limit = f" LIMIT {k}" if k else ""
    return (
        f"SELECT {key}, CAST(sum({value}) AS BIGINT) AS count FROM {source}"
        f" WHERE {key} IS NOT NULL GROUP BY {key}"
        f" ORDER BY count DESC, {key}{limit}"
    )


def _per_batch_top(key: str, k: int, where: str = "true") -> str:
    return f"""(
  SELECT batch_id, {key}, count(*) AS count FROM batched WHERE {where}
  GROUP BY batch_id, {key}
  QUALIFY row_number() OVER (
    PARTITION BY batch_id ORDER BY count(*) DESC, {key} NULLS FIRST) <= {k}
)"""


def _per_batch(key: str, where: str = "true") -> str:
    return f"""(
  SELECT batch_id, {key}, count(*) AS count FROM batched WHERE {where}
  GROUP BY batch_id, {key}
)"""


def _daily_hosts(day: str, source: str) -> str:
    return f"""SELECT day, count(*) AS count
FROM (SELECT DISTINCT host, {day} AS day FROM {source}) GROUP BY day"""


def _daily_requests(day: str, source: str) -> str:
    return f"SELECT {day} AS day, count(*) AS total_reqs FROM {source} GROUP BY 1"


def _avg_daily(day: str, source: str) -> str:
    # In the form with a join of two aggregates, unlike the Spark query.
    return f"""SELECT day, total_reqs, count AS total_hosts,
  total_reqs / count AS avg_reqs
FROM ({_daily_requests(day, source)}) JOIN ({_daily_hosts(day, source)}) USING (day)"""


def _missing(columns: dict[str, str]) -> str:
    return ", ".join(
        f"CAST(coalesce(sum(CASE WHEN {test} THEN 1 ELSE 0 END), 0) AS BIGINT) AS {c}"
        for c, test in columns.items()
    )


_CLF_COLUMNS = ("day_of_week", "time", *_FIELDS)
_TEXTS = ("day_of_week", "host", "method", "endpoint", "protocol")
_IS_NULL = {c: f"{c} IS NULL" for c in _CLF_COLUMNS}
_IS_BLANK = {
    c: f"{c} IS NULL" + (f" OR {c} IN ('', 'Unknown')" if c in _TEXTS else "")
    for c in _CLF_COLUMNS
}
_STREAM_NULL = {"current_time": "false", "time": "time IS NULL"} | {
    c: f"{c} IS NULL" for c in _FIELDS
}

_PER_BATCH_ROWS = {
    "content_size_summary": "SELECT 1 AS one, batch_id FROM batched GROUP BY batch_id",
    "missing_values": "SELECT 1 AS one, batch_id FROM batched GROUP BY batch_id",
    "http_status": "SELECT DISTINCT status, batch_id FROM batched",
    "frequent_hosts": f"SELECT * FROM {_per_batch_top('host', 10)}",
    "frequent_endPoints": f"SELECT * FROM {_per_batch_top('endpoint', 20)}",
    "error_endpoints":
        f"SELECT * FROM {_per_batch_top('endpoint', 10, 'status <> 200')}",
    "unique_hosts": "SELECT DISTINCT host, batch_id FROM batched",
    "unique_daily_hosts": "SELECT DISTINCT day, batch_id FROM batched",
    "avg_daily_reqests_per_host":
        "SELECT DISTINCT day, batch_id FROM batched WHERE day IS NOT NULL",
    "endpoints_404_count":
        "SELECT DISTINCT endpoint, batch_id FROM batched WHERE status = 404",
    "hosts_404_count_df":
        "SELECT DISTINCT host, batch_id FROM batched WHERE status = 404",
    "errors_by_date_sorted":
        "SELECT DISTINCT day, batch_id FROM batched WHERE status = 404",
    "hourly_avg_errors_sorted":
        "SELECT DISTINCT hour, batch_id FROM batched WHERE status = 404",
}

_NOT_FOUND = "(SELECT * FROM logs WHERE status = 404)"

ORACLE: dict[str, str] = {
    # sources and sinks
    "scan_text_lines": _on_lines("SELECT value FROM lines"),
    "scan_uneven_lines": _on_lines("SELECT value FROM lines"),
    "stream_source_lines": _on_lines("SELECT value FROM lines", "iso"),
    "decode_binary_lines": _on_lines("SELECT event_id, value FROM lines"),
    "stamp_ingest_time": _on_lines(
        "SELECT count(*) AS rows, CAST(1 AS BIGINT) AS stamps,"
        " CAST(0 AS BIGINT) AS unstamped FROM lines",
        "iso",
    ),
    "sql_over_logs": _on_clean(
        "SELECT method, status, count(*) AS requests,"
        " CAST(sum(content_size) AS BIGINT) AS bytes FROM logs GROUP BY method, status"
    ),
    "read_result_table": _on_batches(f"SELECT * FROM {_per_batch('status')}"),
    "read_results_as_of": _on_batches(
        f"SELECT * FROM {_per_batch('status', 'batch_id <= 1')}"
    ),
    "host_requests_pruned": _on_parsed(
        "SELECT event_id, time, method, endpoint, status, content_size"
        " FROM parsed WHERE host = 'localhost'"
    ),
    "append_result_table": _on_batches(f"SELECT * FROM {_per_batch('status')}"),
    "replay_lines_to_batches": _on_lines(
        f"SELECT CAST({_batch(4)} AS BIGINT) AS batch_id, value FROM lines", "iso"
    ),
    "stream_resume_from_checkpoint": _on_batches(
        "SELECT batch_id, count(*) AS requests FROM batched GROUP BY batch_id", 2
    ),
    # parsing
    "parse_clf_logs": _on_parsed(
        f"SELECT event_id, day_of_week, time, {_COLUMNS} FROM parsed"
    ),
    "parse_iso_logs": _on_parsed(
        f"SELECT event_id, time, {_COLUMNS} FROM parsed", "iso"
    ),
    "extract_host": _on_parsed("SELECT event_id, host FROM parsed"),
    "extract_request": _on_parsed(
        "SELECT event_id, method, endpoint, protocol FROM parsed"
    ),
    "extract_status": _on_parsed("SELECT event_id, status FROM parsed"),
    "extract_content_size": _on_parsed("SELECT event_id, content_size FROM parsed"),
    "clf_timestamp": _on_parsed(
        "SELECT event_id, coalesce(strftime(time, '%Y-%m-%d %H:%M:%S'), 'Unknown')"
        ' AS "timestamp" FROM parsed'
    ),
    "clf_day_of_week": _on_parsed("SELECT event_id, day_of_week FROM parsed"),
    "clf_time_with_offset": _on_parsed(
        "SELECT event_id, time, time + INTERVAL 4 HOUR AS time_utc FROM parsed"
    ),
    "typed_time_projection": _on_parsed(f"SELECT {_COLUMNS}, time FROM parsed"),
    "iso_timestamp": _on_parsed("SELECT event_id, time FROM parsed", "iso"),
    "status_chart_series": _on_clean(
        "SELECT CAST(status AS VARCHAR) AS status, count(*) AS count"
        " FROM logs GROUP BY ALL"
    ),
    # data quality
    "valid_status_rows": _on_parsed(
        f"SELECT day_of_week, time, {_COLUMNS} FROM parsed WHERE status IS NOT NULL"
    ),
    "count_incomplete_rows": _on_parsed(
        "SELECT count(*) AS incomplete_rows FROM parsed WHERE "
        + " OR ".join(f"{c} IS NULL" for c in ("time", *_FIELDS))
    ),
    "count_missing_per_column": _on_parsed(f"SELECT {_missing(_IS_NULL)} FROM parsed"),
    "count_blank_per_column": _on_parsed(f"SELECT {_missing(_IS_BLANK)} FROM parsed"),
    "fill_missing_size": _on_parsed(
        f"SELECT day_of_week, time, {_COLUMNS.replace('content_size', '')}"
        " coalesce(content_size, 0) AS content_size FROM parsed"
    ),
    "not_found_rows": _on_clean(
        f"SELECT day_of_week, time, {_COLUMNS} FROM {_NOT_FOUND}"
    ),
    "table_shape": _on_clean(
        "SELECT count(*) AS rows, CAST(8 AS INTEGER) AS columns FROM logs"
    ),
    "preview_rows": _on_clean(
        f"SELECT day_of_week, time, {_COLUMNS} FROM logs ORDER BY "
        + ", ".join(f"{c} ASC NULLS FIRST" for c in _CLF_COLUMNS)
        + " LIMIT 10"
    ),
    # sizes and statuses
    "content_size_stats": _on_clean(f"SELECT {_SIZES} FROM logs"),
    "content_size_describe": _on_clean(
        " UNION ALL ".join(
            f"SELECT '{name}' AS summary, round(CAST({e} AS DOUBLE), 2)"
            " AS content_size FROM logs"
            for name, e in {
                "count": "count(content_size)",
                "mean": "avg(content_size)",
                "stddev": "stddev_samp(content_size)",
                "min": "min(content_size)",
                "max": "max(content_size)",
            }.items()
        )
    ),
    "status_frequency": _on_clean(_top("status", "logs")),
    "distinct_status_count": _on_clean(
        "SELECT count(*) AS distinct_statuses FROM (SELECT DISTINCT status FROM logs)"
    ),
    "status_by_frequency": _on_clean(_top("status", "logs")),
    # hosts and endpoints
    "top_ok_endpoints": _on_clean(
        _top("endpoint", "(SELECT * FROM logs WHERE status = 200)", 10)
    ),
    "host_frequency": _on_clean(_top("host", "logs")),
    "top_hosts": _on_clean(_top("host", "logs", 10)),
    "top_endpoints": _on_clean(_top("endpoint", "logs", 10)),
    "top_error_endpoints": _on_clean(
        _top("endpoint", "(SELECT * FROM logs WHERE status <> 200)", 10)
    ),
    "unique_host_count": _on_clean(
        "SELECT count(*) AS unique_hosts FROM (SELECT DISTINCT host FROM logs)"
    ),
    "unique_hosts": _on_clean("SELECT DISTINCT host FROM logs"),
    "close_unique_host_count": _on_clean(
        "SELECT count(*) AS unique_hosts, true AS close FROM (SELECT DISTINCT host FROM logs)"
    ),
    # days
    "host_day_pairs": _on_clean(f"SELECT DISTINCT host, {_DAY} AS day FROM logs"),
    "daily_unique_hosts": _on_clean(_daily_hosts(_DAY, "logs")),
    "daily_requests": _on_clean(_daily_requests(_DAY, "logs")),
    "avg_daily_requests_per_host": _on_clean(_avg_daily(_DAY, "logs")),
    "daily_unique_hosts_over_months": _on_orders(_daily_hosts(_DAY, "logs")),
    "daily_unique_hosts_by_date": _on_orders(_daily_hosts(_DATE, "logs")),
    "daily_requests_by_date": _on_orders(_daily_requests(_DATE, "logs")),
    "avg_daily_requests_per_host_by_date": _on_orders(_avg_daily(_DATE, "logs")),
    "busiest_endpoint_by_weekday": _on_clean(
        """SELECT day_of_week, endpoint, count(*) AS count FROM logs
WHERE day_of_week <> 'Unknown' GROUP BY day_of_week, endpoint
QUALIFY row_number() OVER (
  PARTITION BY day_of_week ORDER BY count(*) DESC, endpoint) = 1"""
    ),
    # 404s
    "not_found_total": _on_clean(f"SELECT count(*) AS not_found FROM {_NOT_FOUND}"),
    "not_found_by_endpoint": _on_clean(_top("endpoint", _NOT_FOUND)),
    "top_not_found_endpoints": _on_clean(_top("endpoint", _NOT_FOUND, 20)),
    "not_found_by_host": _on_clean(_top("host", _NOT_FOUND)),
    "top_not_found_hosts": _on_clean(_top("host", _NOT_FOUND, 20)),
    "not_found_by_day": _on_clean(
        f"SELECT {_DAY} AS day, count(*) AS count FROM {_NOT_FOUND} GROUP BY 1"
    ),
    "top_not_found_days": _on_clean(
        f"SELECT {_DAY} AS day, count(*) AS count FROM {_NOT_FOUND} GROUP BY 1"
        " ORDER BY count DESC, day ASC NULLS FIRST LIMIT 3"
    ),
    "not_found_by_hour": _on_clean(
        "SELECT CAST(hour(time) AS INTEGER) AS hour, count(*) AS count"
        f" FROM {_NOT_FOUND} GROUP BY 1"
    ),
    "not_found_by_weekday": _on_clean(
        f"SELECT day_of_week, status, count(*) AS count FROM {_NOT_FOUND} GROUP BY ALL"
    ),
    # streams
    "stream_all_metrics": _on_batches(
        " UNION ALL ".join(
            f"SELECT '{table}' AS table_name, batch_id, count(*) AS rows"
            f" FROM ({select}) GROUP BY batch_id"
            for table, select in _PER_BATCH_ROWS.items()
        )
    ),
    "stream_status_complete": _on_parsed(
        "SELECT status, count(*) AS count FROM parsed GROUP BY status", "iso"
    ),
    "stream_status_continued": _on_parsed(
        "SELECT status, count(*) AS count FROM parsed GROUP BY status", "iso"
    ),
    "stream_hourly_windowed": _on_parsed(
        "SELECT date_trunc('hour', time) AS hour_start, count(*) AS requests,"
        " count(*) FILTER (WHERE status = 404) AS not_found"
        " FROM parsed WHERE time IS NOT NULL GROUP BY 1",
        "iso",
    ),
    "stream_hourly_with_late": _on_batches(
        """SELECT date_trunc('hour', time) AS hour_start, count(*) AS requests,
  count(*) FILTER (WHERE status = 404) AS not_found,
  count(*) FILTER (
    WHERE batch_id = 1 AND date_trunc('hour', time) + INTERVAL 1 HOUR <= (
      SELECT max(time) - INTERVAL 2 DAY FROM batched WHERE batch_id IN (0, 2))
  ) AS late_requests
FROM batched WHERE time IS NOT NULL GROUP BY 1"""
    ),
    # finished results of batches, rolled up
    "missing_values_batch_rollup": _on_batches(
        f"SELECT {_missing(_STREAM_NULL)} FROM batched"
    ),
    "content_size_per_batch": _on_batches(
        f"SELECT batch_id, {_SIZES} FROM batched GROUP BY batch_id"
    ),
    "status_batch_rollup": _on_batches(_total("status", _per_batch("status"))),
    "hosts_batch_rollup": _on_batches(
        _total("host", _per_batch_top("host", 10), k=5)
    ),
    "endpoints_batch_rollup": _on_batches(
        _total("endpoint", _per_batch_top("endpoint", 20), k=20)
    ),
    "error_endpoints_batch_rollup": _on_batches(
        _total("endpoint", _per_batch_top("endpoint", 10, "status <> 200"), k=10)
    ),
    "unique_hosts_batch_rollup": _on_batches(
        "SELECT count(*) AS host FROM (SELECT DISTINCT batch_id, host FROM batched)"
        " WHERE host IS NOT NULL"
    ),
    "daily_hosts_batch_rollup": _on_batches(
        "SELECT day, count(*) AS count"
        " FROM (SELECT DISTINCT batch_id, day, host FROM batched)"
        " WHERE day IS NOT NULL GROUP BY day"
    ),
    "avg_daily_batch_rollup": _on_batches(
        """SELECT day, CAST(sum(requests) AS BIGINT) AS total_reqs,
  count(*) AS total_hosts, sum(requests) / count(*) AS avg_reqs
FROM (
  SELECT batch_id, day, host, count(*) AS requests
  FROM batched WHERE day IS NOT NULL GROUP BY batch_id, day, host
) GROUP BY day"""
    ),
    "not_found_endpoints_batch_rollup": _on_batches(
        _total("endpoint", _per_batch("endpoint", "status = 404"), k=20)
    ),
    "not_found_hosts_batch_rollup": _on_batches(
        _total("host", _per_batch("host", "status = 404"), k=20)
    ),
    "not_found_day_batch_rollup": _on_batches(
        _total("day", _per_batch("day", "status = 404"))
    ),
    "not_found_hour_batch_rollup": _on_batches(
        _total("hour", _per_batch("hour", "status = 404"))
    ),
    # partial counts of batches, merged: the answers over all rows
    "hosts_exact_topk": _on_parsed(_top("host", "parsed", 10), "iso"),
    "endpoints_exact_topk": _on_parsed(_top("endpoint", "parsed", 20), "iso"),
    "error_endpoints_exact_topk": _on_parsed(
        _top("endpoint", "(SELECT * FROM parsed WHERE status <> 200)", 10), "iso"
    ),
    "unique_hosts_exact": _on_parsed(
        "SELECT count(*) AS unique_hosts FROM (SELECT DISTINCT host FROM parsed)",
        "iso",
    ),
    "daily_hosts_exact": _on_parsed(_daily_hosts(_DAY, "parsed"), "iso"),
    "daily_hosts_incremental": _on_parsed(_daily_hosts(_DAY, "parsed"), "iso"),
    "daily_hosts_bitmap": _on_parsed(_daily_hosts(_DAY, "parsed"), "iso"),
    "close_size_quantiles": _on_parsed(
        "SELECT quantile, count(content_size) AS known, true AS close FROM parsed,"
        " (VALUES (0.5::DOUBLE), (0.9::DOUBLE), (0.99::DOUBLE)) q(quantile) GROUP BY quantile"
    ),
    "close_top_hosts": _close_ranks("host", "parsed"),
    "close_top_endpoints": _close_ranks("endpoint", "parsed"),
    "close_top_error_endpoints": _close_ranks(
        "endpoint", "(SELECT * FROM parsed WHERE status <> 200)"
    ),
    "avg_daily_exact": _on_parsed(_avg_daily(_DAY, "parsed"), "iso"),
    "content_size_merged": _on_parsed(f"SELECT {_SIZES} FROM parsed", "iso"),
}

#: Keys of the analyses that have a key and a count.
_COUNTED = {
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
ORACLE["report_in_two_scans"] = " UNION ALL ".join(
    f"SELECT '{name}' AS analysis, CAST({key} AS VARCHAR) AS key, count FROM ({ORACLE[name]})"
    for name, key in _COUNTED.items()
)
