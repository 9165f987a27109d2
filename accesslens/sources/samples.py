"""Access lines built from the given tables, for queries, tests and the bench.

The tables hold no log text, so the lines are derived from them row by row with
native expressions; every event (or order) becomes exactly one line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How a line writes its time.
CLF_TIME = "dd/MMM/yyyy:HH:mm:ss"
ISO_TIME = "yyyy-MM-dd HH:mm:ss"

# What some responses have on top, to be larger than 32 bits tell.
LARGE = 3_000_000_000


def event_lines(events: DataFrame, style: str = "clf") -> DataFrame:
    """``event_id, value``: one access line per event, in CLF or ISO form."""
    event_id = F.col("event_id")
    kind = F.col("event_type")
    user = F.col("user_id").cast("string")
    status = (
        F.when((kind == "error") & (event_id % 3 == 0), "500")
        .when(kind == "error", "404")
        .when(event_id % 10 == 7, "304")
        .when(event_id % 10 == 3, "302")
        .otherwise("200")
    )
    line = _line(
        host=F.when(event_id % 97 == 0, "localhost")
        .when(event_id % 2 == 0, F.concat(F.lit("h"), user, F.lit(".example.org")))
        .otherwise(F.concat(F.lit("10.0.0."), user)),
        stamp=_stamp(F.col("ts"), style),
        method=F.when(kind.isin("signup", "purchase"), "POST")
        .when(event_id % 50 == 0, "HEAD")
        .otherwise("GET"),
        endpoint=F.concat(
            F.lit("/"), kind, F.lit("/"), F.get_json_object("props", "$.k")
        ),
        protocol=F.when(event_id % 89 == 0, "").otherwise(" HTTP/1.0"),
        status=status,
        size=F.when((event_id % 101 == 0) | (status == "304"), "-")
        .when(event_id % 103 == 0, (F.floor(F.col("value") * 100) + LARGE).cast("string"))
        .otherwise(F.floor(F.col("value") * 100).cast("string")),
    )
    garbage = F.concat(F.lit("garbage "), event_id.cast("string"))
    return events.select(
        "event_id", F.when(event_id % 211 == 0, garbage).otherwise(line).alias("value")
    )


def order_lines(orders: DataFrame) -> DataFrame:
    """``o_orderkey, value``: one CLF line per order; spans several years."""
    line = _line(
        host=F.concat(
            F.lit("c"), F.col("o_custkey").cast("string"), F.lit(".example.net")
        ),
        stamp=_stamp(F.col("o_orderdate"), "clf"),
        method=F.lit("GET"),
        endpoint=F.concat(
            F.lit("/"),
            F.col("o_orderstatus"),
            F.lit("/"),
            F.translate("o_orderpriority", " ", "_"),
        ),
        protocol=F.lit(" HTTP/1.0"),
        status=F.lit("200"),
        size=F.floor("o_totalprice").cast("string"),
    )
    return orders.select("o_orderkey", line.alias("value"))


def _stamp(ts: Column, style: str) -> Column:
    if style == "clf":
        return F.concat(F.date_format(ts, CLF_TIME), F.lit(" -0400"))
    if style == "iso":
        return F.date_format(ts, ISO_TIME)
    raise ValueError(f"style must be 'clf' or 'iso', not {style!r}")


def _line(host, stamp, method, endpoint, protocol, status, size) -> Column:
    return F.concat(
        host, F.lit(" - - ["), stamp, F.lit('] "'), method, F.lit(" "), endpoint,
        protocol, F.lit('" '), status, F.lit(" "), size,
    )
