"""Lines that are odd in one way each, and fields of arbitrary text."""

import datetime
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from accesslens.functions import fields, patterns
from accesslens.functions.parse import parse_logs, typed_times

BASE = '1.2.3.4 - - [01/Jul/1995:10:00:01 -0400] "GET /x HTTP/1.0" 200 62'
TIME = datetime.datetime(1995, 7, 1, 10, 0, 1)
OK = {
    "host": "1.2.3.4", "method": "GET", "endpoint": "/x", "protocol": "HTTP/1.0",
    "status": 200, "content_size": 62, "time": TIME, "day_of_week": "Saturday",
}
NOTHING = {
    "host": "", "method": "", "endpoint": "", "protocol": "", "status": None,
    "content_size": None, "time": None, "day_of_week": "Unknown",
}


def _changed(old, new):
    assert old in BASE
    return BASE.replace(old, new)


def _request(method="", endpoint="", protocol=""):
    return {"method": method, "endpoint": endpoint, "protocol": protocol}


NO_TIME = {"time": None}
NO_DATE = {"time": None, "day_of_week": "Unknown"}

CASES = {
    "plain": (BASE, {}),
    "ends in LF": (BASE + "\n", {}),
    "ends in CR": (BASE + "\r", {}),
    "ends in CRLF": (BASE + "\r\n", {}),
    "trailing space": (BASE + " ", {"content_size": None}),
    "leading space": (" " + BASE, {"host": ""}),
    "combined format": (BASE + ' "http://r/" "agent"', {"content_size": None}),
    "no protocol": (_changed(" HTTP/1.0", ""), {"protocol": ""}),
    "four tokens": (
        _changed('/x HTTP/1.0" 200 62', '/x 123 HTTP/1.0" 404 7'),
        _request() | {"status": 123, "content_size": 7},
    ),
    "two spaces after method": (_changed("GET /x", "GET  /x"), _request()),
    "two spaces before protocol": (_changed("/x HTTP", "/x  HTTP"), {}),
    "tab after method": (_changed("GET /x", "GET\t/x"), {}),
    "space after endpoint": (_changed("/x HTTP/1.0", "/x "), {"protocol": ""}),
    "quote in endpoint": (_changed("/x", '/a"b'), {"endpoint": '/a"b'}),
    "quote in protocol": (_changed("HTTP/1.0", 'H"T'), {"protocol": 'H"T'}),
    "no closing quote": (_changed('1.0"', "1.0"), _request()),
    "no status": (
        _changed("200 62", "- 512"), {"status": None, "content_size": 512}
    ),
    "ends after status": (
        _changed("200 62", "200"), {"status": None, "content_size": 200}
    ),
    "user of three digits": (
        _changed("- - [", "- 777 [").replace("200 62", "404 0"),
        {"status": 777, "content_size": 0},
    ),
    "size missing": (_changed(" 62", " -"), {"content_size": None}),
    "largest size": (_changed(" 62", " 2147483647"), {"content_size": 2147483647}),
    "size beyond int": (_changed(" 62", " 2147483648"), {"content_size": 2147483648}),
    "size beyond long": (_changed(" 62", " 9223372036854775808"), {"content_size": None}),
    "size of many digits": (_changed(" 62", " " + "9" * 40), {"content_size": None}),
    "size with zeros": (_changed(" 62", " " + "0" * 20 + "62"), {}),
    "shortest host": (_changed("1.2.3.4", "a.bc"), {"host": "a.bc"}),
    "host with one after dot": (_changed("1.2.3.4", "a.b"), {"host": ""}),
    "host with dot first": (_changed("1.2.3.4", ".a.bc"), {"host": ".a.bc"}),
    "host of dots": (_changed("1.2.3.4", "...."), {"host": "...."}),
    "host of three dots": (_changed("1.2.3.4", "..."), {"host": ""}),
    "host without dot": (_changed("1.2.3.4", "localhost"), {"host": ""}),
    "upper-case month": (_changed("Jul", "JUL"), {}),
    "lower-case month": (_changed("Jul", "jul"), {}),
    "no such day": (_changed("01/Jul", "31/Feb"), NO_DATE),
    "no leap year": (_changed("01/Jul/1995", "29/Feb/2023"), NO_DATE),
    "leap year": (
        _changed("01/Jul/1995", "29/Feb/2024"),
        {
            "time": datetime.datetime(2024, 2, 29, 10, 0, 1),
            "day_of_week": "Thursday",
        },
    ),
    "no such month": (_changed("01/Jul", "01/Xyz"), NO_DATE),
    "year 0": (_changed("1995", "0000"), NO_DATE),
    "hour 24": (_changed("10:00:01", "24:00:00"), NO_TIME),
    "hour 25": (_changed("10:00:01", "25:00:01"), NO_TIME),
    "second 60": (_changed("10:00:01", "10:00:60"), NO_TIME),
    "date only": (_changed(":10:00:01 -0400", ""), NO_TIME),
    "other time format": (
        _changed("01/Jul/1995:10:00:01 -0400", "1995-07-01 10:00:01"), NO_DATE
    ),
    "garbage": ("garbage", NOTHING),
    "empty": ("", NOTHING),
    "null": (None, dict.fromkeys(OK) | {"day_of_week": "Unknown"}),
}


@pytest.fixture(scope="module")
def parsed(spark):
    table = spark.createDataFrame(
        [(name, line) for name, (line, _) in CASES.items()], "case string, value string"
    )
    rows = parse_logs(table, keep=["case"]).collect()
    return {row["case"]: row.asDict() for row in rows}


@pytest.mark.parametrize("case", CASES)
def test_odd_line(case, parsed):
    line, change = CASES[case]
    base = NOTHING if line == "garbage" else OK
    assert parsed[case] == {"case": case} | base | change


def test_clocks_that_skip_an_hour_do_not_move_times(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        lines = spark.createDataFrame(
            [(BASE.replace("01/Jul/1995:10:00:01", "02/Apr/1995:02:30:00"),)],
            "value string",
        )
        row = (
            parse_logs(lines)
            .select(
                "time",
                fields.time_text("time").alias("text"),
                fields.day_of_week("time").alias("weekday"),
                fields.wall_clock(fields.instant("time")).alias("through_instant"),
            )
            .first()
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    time = datetime.datetime(1995, 4, 2, 2, 30)
    assert tuple(row) == (time, "1995-04-02 02:30:00", "Sunday", time)


def test_iso_lines(spark):
    stamp = "01/Jul/1995:10:00:01 -0400"
    lines = [
        BASE.replace(stamp, "1995-07-01 10:00:01"),
        BASE.replace(stamp, "1995-02-30 10:00:01"),
        BASE.replace(stamp, "1995-07-01 10:00:01 "),
        BASE,
    ]
    table = spark.createDataFrame([(line,) for line in lines], "value string")
    rows = parse_logs(table, "iso").collect()
    assert [row["time"] for row in rows] == [TIME, None, None, None]
    assert len({row["current_time"] for row in rows}) == 1
    assert rows[0]["current_time"] is not None
    assert [f.name for f in parse_logs(table, "iso").schema] == [
        "current_time", "host", "time", "method", "endpoint", "protocol", "status",
        "content_size",
    ]


def test_time_with_offset(spark):
    cases = {
        "01/Jul/1995:10:00:01 -0400": (TIME, TIME + datetime.timedelta(hours=4)),
        "01/Jul/1995:10:00:01 +0530": (
            TIME, TIME - datetime.timedelta(hours=5, minutes=30)
        ),
        "01/Jul/1995:10:00:01": (TIME, None),
        "01/Jul/1995:10:00:01 0400": (TIME, None),
        "31/Feb/1995:10:00:01 -0400": (None, None),
        "Unknown": (None, None),
        "": (None, None),
    }
    table = spark.createDataFrame([(t,) for t in cases], "text string")
    rows = table.select(
        "text", fields.time_of_text("text"), fields.time_of_text("text", to_utc=True)
    ).collect()
    assert {row[0]: (row[1], row[2]) for row in rows} == cases


def test_typed_times_of_text(spark):
    texts = ["1995-07-01 10:00:01", "01/Jul/1995:10:00:01 -0400", "Unknown", None]
    table = spark.createDataFrame([(t,) for t in texts], "value string")
    logs = table.select(
        *[F.lit(None).cast("string").alias(c)
          for c in ("host", "method", "endpoint", "protocol")],
        *[F.lit(None).cast("int").alias(c) for c in ("status", "content_size")],
        F.col("value").alias("time_text"),
    )
    rows = typed_times(logs).collect()
    assert [row["time"] for row in rows] == [TIME, TIME, None, None]
    assert "day_of_week" not in typed_times(logs).columns


def test_binary_messages(spark):
    table = spark.createDataFrame([(bytearray(BASE + "\n", "utf-8"),)], "value binary")
    text = table.select(fields.decode("value").alias("value"))
    row = parse_logs(text).first()
    assert (row["content_size"], row["time"]) == (62, TIME)


# The fields as plain patterns that may backtrack, to compare with.
PLAIN = {
    "host": (r"(^\S+\.[\S+\.]+\S+)\s", 1),
    "method": (r'"(\S+)\s(\S+)\s*(\S*)"', 1),
    "endpoint": (r'"(\S+)\s(\S+)\s*(\S*)"', 2),
    "protocol": (r'"(\S+)\s(\S+)\s*(\S*)"', 3),
}
PIECES = st.lists(
    st.sampled_from(
        ['"', " ", "\t", "a", ".", "bc", "+", "/", "200", "5", " 404 ", '"GET', "[", "-"]
    ),
    max_size=14,
).map("".join)


@settings(max_examples=15, deadline=None)
@given(st.lists(PIECES, min_size=150, max_size=200))
def test_any_text_parses_like_the_plain_patterns(spark, lines):
    table = spark.createDataFrame(
        [(i, line) for i, line in enumerate(lines)], "i int, value string"
    )
    rows = parse_logs(table, keep=["i"]).collect()
    for row in rows:
        line = lines[row["i"]]
        for name, (pattern, group) in PLAIN.items():
            found = re.search(pattern, line, re.ASCII)
            expected = (found.group(group) or "") if found else ""
            assert row[name] == expected, (name, line)


def test_a_long_line_parses_like_a_short_one(spark):
    path = "/" + "x" * 10_000
    table = spark.createDataFrame([(BASE.replace("/x", path),)], "value string")
    row = parse_logs(table).first()
    assert row.asDict() == OK | {"endpoint": path}


@pytest.mark.parametrize(
    "line",
    [
        "a." * 100_000,
        BASE.replace("/x", "/" + "a." * 100_000).replace('1.0"', "1.0"),
        BASE + " " + "7" * 200_000,
        " " * 200_000,
        '"' * 200_000,
        '{"a":1,"b":[2]}' * 30_000,
        "[" * 200_000,
    ],
    ids=["one token", "open request", "digits", "blanks", "quotes", "json", "brackets"],
)
def test_long_junk_takes_linear_time(spark, line):
    # A pattern that backtracks over pairs of positions would need hours.
    table = spark.createDataFrame([(line,)], "value string")
    assert parse_logs(table).count() == 1
    assert len(parse_logs(table).collect()) == 1
    assert table.select(fields.bracketed("value")).first() is not None
