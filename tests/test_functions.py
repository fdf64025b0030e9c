"""Column helpers on hand-made edge rows."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from opslog.functions import (
    bytes_to_kb, coded_datetime, coded_duration_text, elapsed_clock_text, html_escape, int_avg, int_div,
    package_file_name, parent_folder, second_boundaries, seconds_as_time_text, strip_domain,
    trimmed_length,
)


def one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_second_boundaries_counts_crossings(spark):
    a = dt.datetime(2020, 1, 1, 0, 0, 0, 900000)
    b = dt.datetime(2020, 1, 1, 0, 0, 1, 100000)
    out = one(spark, second_boundaries("a", "b"), [(a, b), (b, a), (a, a)], "a timestamp_ntz, b timestamp_ntz")
    assert out == [1, -1, 0]


def test_second_boundaries_before_epoch(spark):
    a = dt.datetime(1969, 12, 31, 23, 59, 59, 500000)
    b = dt.datetime(1970, 1, 1, 0, 0, 0, 100000)
    assert one(spark, second_boundaries("a", "b"), [(a, b)], "a timestamp_ntz, b timestamp_ntz") == [1]


def test_time_of_day_wraps(spark):
    out = one(spark, seconds_as_time_text("s"), [(0,), (90061,), (-1,), (25 * 3600,), (None,)], "s long")
    assert out == ["00:00:00", "01:01:01", "23:59:59", "01:00:00", None]


def test_coded_duration(spark):
    out = one(spark, coded_duration_text("d"), [(5,), (93005,), (1000000,), (0,)], "d int")
    assert out == ["00:00:05", "09:30:05", "100:00:00", "00:00:00"]


def test_coded_datetime(spark):
    out = one(spark, coded_datetime("d", "t"), [(20240105, 305), (0, 101010), (None, 5), (19991231, 235959)],
              "d int, t int")
    assert out == [dt.datetime(2024, 1, 5, 0, 3, 5), None, None, dt.datetime(1999, 12, 31, 23, 59, 59)]


def test_parent_folder(spark):
    data = [("/A/B/r1",), ("/r2",), ("nop",), ("",), (None,), ("/A/B/r1 ",)]
    out = one(spark, parent_folder("p"), data, "p string")
    # a trailing blank is not counted by the length but is by the reverse search
    assert out == ["/A/B/", "/", "nop", "", None, "/A/B"]


def test_trimmed_length(spark):
    assert one(spark, trimmed_length("s"), [("ab  ",), ("  ab",)], "s string") == [2, 4]


def test_package_file_name(spark):
    data = [('/FILE "C:\\ssis\\Pkg1.dtsx" /X',), ("C:\\a\\b.dtsx\\c.dtsx",), ("no extension",), ("Pkg.dtsx",), (None,)]
    out = one(spark, package_file_name("c"), data, "c string")
    assert out == ["Pkg1.dtsx", "b.dtsx", None, None, None]


def test_strip_domain_and_escape(spark):
    assert one(spark, strip_domain("u", "DOM\\"), [("DOM\\alice",), ("bob",)], "u string") == ["alice", "bob"]
    assert one(spark, html_escape("s"), [("a<b>&c",)], "s string") == ["a&lt;b&gt;&amp;c"]


def test_integer_division_truncates(spark):
    out = one(spark, int_div("a", "b"), [(103423, 1024), (-7, 2), (7, -2), (1, 0), (None, 1)], "a long, b long")
    assert out == [100, -3, -3, None, None]


def test_int_avg_truncates_and_ignores_nulls(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert df.agg(int_avg("x").alias("a")).first()["a"] == 1
    df = spark.createDataFrame([(-1,), (-2,)], "x int")
    assert df.agg(int_avg("x").alias("a")).first()["a"] == -1


def test_bytes_to_kb_half_up(spark):
    out = one(spark, bytes_to_kb("n"), [(128,), (384,), (1024,), (103423,)], "n long")
    assert out == [Decimal("0.13"), Decimal("0.38"), Decimal("1.00"), Decimal("101.00")]


def test_elapsed_clock(spark):
    start = dt.datetime(2020, 1, 1, 0, 0, 0)
    now = F.lit("2020-01-02 01:02:03").cast("timestamp_ntz")
    df = spark.createDataFrame([(start,)], "s timestamp_ntz")
    assert df.select(elapsed_clock_text("s", now)).first()[0] == "1:02:03"
    assert df.select(elapsed_clock_text("s", now, total_hours=True)).first()[0] == "25:02:03"


def test_second_boundaries_ignore_session_zone(spark):
    # 2020-03-08 02:00 does not exist in Los Angeles; the wall-clock difference is still 2 h
    a, b = dt.datetime(2020, 3, 8, 1, 0, 0), dt.datetime(2020, 3, 8, 3, 0, 0)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        out = one(spark, second_boundaries("a", "b"), [(a, b)], "a timestamp_ntz, b timestamp_ntz")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert out == [7200]


def test_case_insensitive_mode(spark):
    from opslog.functions import text_equals, text_like, text_replace, text_startswith

    df = spark.createDataFrame([("DOM\\Alice", '/FILE "C:\\SSIS\\Pkg.DTSX"')], "u string, c string")
    r = df.select(
        text_replace("u", "dom\\", "", case_sensitive=False).alias("a"),
        text_replace("u", "dom\\", "").alias("b"),
        text_equals("u", "dom\\alice", case_sensitive=False).alias("c"),
        text_startswith("u", "DOM", case_sensitive=True).alias("d"),
        text_like("c", "%ssis%", case_sensitive=False).alias("e"),
        package_file_name("c", case_sensitive=False).alias("f"),
        package_file_name("c").alias("g"),
    ).first()
    assert (r.a, r.b, r.c, r.d, r.e, r.f, r.g) == ("Alice", "DOM\\Alice", True, True, True, "Pkg.dtsx", None)


def test_integer_division_is_exact_beyond_doubles(spark):
    big = [(9007199254740993, 1), (90071992547409931, 10), (-90071992547409931, 10), (7, -2), (5, 0), (None, 3)]
    assert one(spark, int_div("x", "y"), big, "x long, y long") == [9007199254740993, 9007199254740993, -9007199254740993, -3, None, None]
