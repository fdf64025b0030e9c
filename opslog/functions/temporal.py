"""Date/time helpers with the log semantics of the source system.

* integer-coded dates (``yyyymmdd``) and times/durations (``hhmmss``)
* second differences that count second *boundaries* crossed
* durations shown as a time of day, wrapping at 24 hours
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "1970-01-01 00:00:00"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 00:00:00 of a wall-clock timestamp, floored.

    Built from the calendar day and the time-of-day fields of a TIMESTAMP_NTZ,
    which do not depend on the session time zone (a difference of two NTZ
    values through the session zone would shift by an hour across a DST change).
    """
    t = _c(ts).cast("timestamp_ntz")
    days = F.datediff(F.to_date(t), F.lit(_EPOCH[:10]).cast("date")).cast("long")
    return days * 86400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def second_boundaries(start, end) -> Column:
    """Number of second boundaries crossed from ``start`` to ``end``.

    0.900 s -> 1.100 s gives 1, although only 0.2 s elapsed.
    """
    return epoch_seconds(end) - epoch_seconds(start)


def _two_digits(n: Column) -> Column:
    """Non-negative integer as text, at least two digits (more are kept).

    Plain concatenation: unlike printf it stays in generated code.
    """
    t = n.cast("string")
    return F.when(n < 10, F.concat(F.lit("0"), t)).otherwise(t)


def _clock(h: Column, m: Column, s: Column) -> Column:
    return F.concat(_two_digits(h), F.lit(":"), _two_digits(m), F.lit(":"), _two_digits(s))


def seconds_as_time_text(seconds) -> Column:
    """Add ``seconds`` to 00:00:00 as a time of day: wraps at 24 h, ``HH:mm:ss``."""
    s = F.pmod(_c(seconds).cast("long"), F.lit(86400))
    return _clock(
        F.floor(s / 3600).cast("int"),
        F.pmod(F.floor(s / 60), F.lit(60)).cast("int"),
        F.pmod(s, F.lit(60)).cast("int"),
    )


def coded_datetime(date_int, time_int) -> Column:
    """``yyyymmdd`` + ``hhmmss`` integers -> TIMESTAMP_NTZ; date 0 means never run (NULL).

    The time is zero-padded on the left and the right six digits are kept.
    """
    d = _c(date_int)
    t = F.right(F.concat(F.lit("000000"), _c(time_int).cast("string")), F.lit(6))
    ts = F.to_timestamp_ntz(F.concat(d.cast("string"), F.lit(" "), t), F.lit("yyyyMMdd HHmmss"))
    return F.when(d == 0, F.lit(None).cast("timestamp_ntz")).otherwise(ts)


def coded_duration_text(duration_int) -> Column:
    """``hhmmss`` integer -> ``HH:MM:SS``; hours keep all their digits (``100:00:00``)."""
    n = _c(duration_int).cast("long")
    return _clock(
        F.floor(n / 10000).cast("long"),
        F.pmod(F.floor(n / 100), F.lit(100)).cast("int"),
        F.pmod(n, F.lit(100)).cast("int"),
    )


def elapsed_clock_text(start, now, total_hours: bool = False) -> Column:
    """Elapsed time ``now - start`` as ``H:MI:SS``.

    Hours are not padded. By default the hours wrap at 24 (the day part of the
    difference is dropped, as the source view does); ``total_hours=True`` keeps
    the full hour count.
    """
    e = epoch_seconds(now) - epoch_seconds(start)
    h = F.floor(e / 3600)
    if not total_hours:
        h = F.pmod(h, F.lit(24))
    return F.concat(
        h.cast("long").cast("string"),
        F.lit(":"),
        _two_digits(F.pmod(F.floor(e / 60), F.lit(60)).cast("int")),
        F.lit(":"),
        _two_digits(F.pmod(e, F.lit(60)).cast("int")),
    )


def sql_datetime_text(ts) -> Column:
    """Canonical ``yyyy-MM-dd HH:mm:ss`` text (ODBC canonical style)."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss")
