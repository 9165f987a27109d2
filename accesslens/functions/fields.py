"""Column expressions: from the text of a line to one typed field.

All are native expressions, so they run inside code generation and Spark drops
those a query does not read. Nothing here can fail on bad text: what does not
parse is ``''`` for text fields and NULL for typed ones. Times are wall-clock
``timestamp_ntz`` values, which makes them independent of the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from accesslens.functions import patterns as p

def _text(line: Column | str) -> Column:
    return F.col(line) if isinstance(line, str) else line


def decode(value: Column | str) -> Column:
    """Bytes of a message as text."""
    return _text(value).cast("string")


def host(line: Column | str) -> Column:
    return F.regexp_extract(_text(line), p.HOST, 1)


def _request(line: Column | str, part: int) -> Column:
    # Named alike by all three fields, so a projection of them matches a line once; inside
    # a CASE it would not be shared. Blanks behind the parts stand for those that are missing.
    request = F.regexp_extract(_text(line), p.REQUEST, 1)
    blanks = F.array(*[F.lit("")] * 3)
    return F.get(F.concat(F.split(request, p.REQUEST_PARTS, -1), blanks), F.lit(part))


def method(line: Column | str) -> Column:
    return _request(line, 0)


def endpoint(line: Column | str) -> Column:
    return _request(line, 1)


def protocol(line: Column | str) -> Column:
    return _request(line, 2)


def status(line: Column | str) -> Column:
    # A cast that fails is some 100 times dearer than one that succeeds; this has
    # no such cost, and names the match once, which counts when filters repeat it.
    found = F.regexp_extract(_text(line), p.STATUS, 1)
    return F.try_to_number(found, F.lit("999")).cast("int")


def content_size(line: Column | str) -> Column:
    """Size in bytes; NULL without digits at the line's end or beyond 2^63 - 1."""
    # Of any length, so it does need a cast; but sizes are often missing, and ''
    # is better made NULL before.
    found = F.regexp_extract(_text(line), p.CONTENT_SIZE, 1)
    return F.nullif(found, F.lit("")).try_cast("bigint")


def clf_to_iso(text: Column | str) -> Column:
    """``dd/MMM/yyyy:HH:mm:ss`` as ``yyyy-MM-dd HH:mm:ss``; NULL for other months.

    Rearranging the text and casting it costs no more than parsing by format,
    and unlike that it has a form without a time zone that does not raise. There
    is no CASE in it: Spark would match the line once per branch, whereas it
    shares the match between the plain pieces here.
    """
    text = _text(text)
    clock = F.concat(F.lit(" "), F.substring(text, 13, 8))
    return F.concat(_clf_to_iso_date(text), clock)


def _clf_to_iso_date(text: Column) -> Column:
    months = F.create_map(
        *[F.lit(v) for i, name in enumerate(p.MONTHS, 1) for v in (name, f"{i:02d}")]
    )
    month = F.try_element_at(months, F.lower(F.substring(text, 4, 3)))
    dash = F.lit("-")
    return F.concat(
        F.substring(text, 8, 4), dash, month, dash, F.substring(text, 1, 2)
    )


def clf_time(line: Column | str) -> Column:
    """Wall-clock time of a Common Log Format line; the offset is not applied."""
    found = F.regexp_extract(_text(line), p.CLF_TIME, 1)
    return clf_to_iso(found).try_cast("timestamp_ntz")


def clf_date(line: Column | str) -> Column:
    found = F.regexp_extract(_text(line), p.CLF_DATE, 1)
    return _clf_to_iso_date(found).try_cast("date")


def iso_time(line: Column | str) -> Column:
    """Time of a line that writes it as ``[yyyy-MM-dd HH:mm:ss]``."""
    found = F.regexp_extract(_text(line), p.ISO_TIME, 1)
    return found.try_cast("timestamp_ntz")


def bracketed(line: Column | str) -> Column:
    """What stands between the brackets, such as a time with its offset."""
    return F.regexp_extract(_text(line), p.BRACKETED, 1)


def time_of_text(text: Column | str, to_utc: bool = False) -> Column:
    """Time from ``dd/MMM/yyyy:HH:mm:ss +zzzz``.

    The offset is ignored, or with ``to_utc`` applied; either way the result is
    a ``timestamp_ntz``. Without a usable offset the UTC form is NULL.
    """
    text = _text(text)
    wall = clf_to_iso(F.substring(text, 1, 20)).try_cast("timestamp_ntz")
    if not to_utc:
        return wall
    offset = F.regexp_extract(
        text, r"^.{20} ([+-](?:0\d|1[0-4])[0-5]\d)$", 1
    )
    minutes = F.substring(offset, 2, 2).try_cast("int") * 60 + F.substring(
        offset, 4, 2
    ).try_cast("int")
    east = F.when(F.startswith(offset, F.lit("-")), -minutes).otherwise(minutes)
    return wall - F.make_dt_interval(mins=east)


def instant(time: Column | str) -> Column:
    """A wall-clock time as the ``timestamp`` at which clocks in UTC show it.

    Watermarks need a ``timestamp``. A plain cast would take the session's zone
    and move times that its clocks skip in spring.
    """
    return F.concat(_text(time).cast("string"), F.lit("Z")).cast("timestamp")


def wall_clock(instant: Column | str) -> Column:
    """What clocks in UTC show at a ``timestamp``, to the second."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=F.unix_seconds(_text(instant)))


def time_text(time: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, or ``Unknown`` for a missing time."""
    # Parsed times have no fraction, and the cast prints whole seconds like this.
    return F.coalesce(_text(time).cast("string"), F.lit(p.UNKNOWN))


def day_of_week(date: Column | str) -> Column:
    """Full English weekday name of a date or time, ``Unknown`` for a missing one."""
    names = F.array(*[F.lit(name) for name in p.WEEKDAYS])
    index = F.weekday(_text(date).cast("date"))
    return F.coalesce(F.get(names, index), F.lit(p.UNKNOWN))


def day(time: Column | str, grain: str = "day_of_month") -> Column:
    """The day a time falls on: its number in the month (1 to 31), or its date.

    Numbers put days of different months together; dates keep them apart.
    """
    if grain == "day_of_month":
        return F.dayofmonth(_text(time).cast("date"))
    if grain == "date":
        return _text(time).cast("date")
    raise ValueError(f"grain must be 'day_of_month' or 'date', not {grain!r}")


def hour(time: Column | str) -> Column:
    return F.hour(_text(time))
