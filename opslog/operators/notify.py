"""Failure report: the new failures as an HTML table.

The report is produced as ordered *lines* (header, one ``<tr>`` per failure,
footer) rather than one string aggregated in a single task: the rows are
built in parallel and written with a global sort, so the concatenation of the
written part files in name order is the document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opslog.functions.temporal import sql_datetime_text
from opslog.functions.text import html_escape
from opslog.operators.state import failure_rows

# The report's heading, table header and footer.
REPORT_HEADING = '<H1 align="center" style="font-family:Cambria;">{server} Job Failure Report</H1>'
REPORT_TABLE_OPEN = '<table border="1" style="border: solid black 1px;font-family:Calibri;font-size:13">'
REPORT_HEADER_ROW = (
    "<tr><th>Job Name</th><th>Step Name</th>"
    "<th>Step Message</th><th>Last Run DateTime</th><th>Last Run Duration</th></tr>"
)
REPORT_TABLE_CLOSE = "</table>"

LINE_ORDER = ["part", "JobName", "StepName", "LastRunDateTime", "InstanceID"]


def _cell(c, empty_null_cells: bool):
    cell = F.concat(F.lit("<td>"), html_escape(c), F.lit("</td>"))
    # A NULL value leaves its cell out (the source's row serialisation drops
    # NULL elements); empty_null_cells=True writes <td></td> instead.
    return F.coalesce(cell, F.lit("<td></td>")) if empty_null_cells else cell


def failure_report(state: DataFrame, server: str, empty_null_cells: bool = False) -> DataFrame:
    """Report lines for the failure rows of ``state``: part 0 = heading + table
    header, 1 = one row per failure, 2 = table end. Sorting by ``LINE_ORDER``
    gives document order. No lines at all when there is no failure.

    Every failure gives its own line, equal ones too. The two frame lines hang on
    a one-row existence test of the same failures, so nothing is de-duplicated
    and no message text is shuffled.
    """
    row_html = F.concat_ws(
        "",
        F.lit("<tr>"),
        _cell(F.col("JobName"), empty_null_cells),
        _cell(F.col("StepName"), empty_null_cells),
        _cell(F.col("StepMessage"), empty_null_cells),
        _cell(sql_datetime_text("LastRunDateTime"), empty_null_cells),
        _cell(F.col("LastRunDuration"), empty_null_cells),
        F.lit("</tr>"),
    )
    head_text = REPORT_HEADING.format(server=server) + REPORT_TABLE_OPEN + REPORT_HEADER_ROW

    def line(part, job, step, ts, inst, html):
        return F.struct(
            F.lit(part).alias("part"), job.cast("string").alias("JobName"), step.cast("string").alias("StepName"),
            ts.cast("timestamp_ntz").alias("LastRunDateTime"), inst.cast("long").alias("InstanceID"),
            html.alias("html"),
        )

    none = F.lit(None)
    failures = failure_rows(state)
    body = failures.select(line(1, F.col("JobName"), F.col("StepName"), F.col("LastRunDateTime"), F.col("InstanceID"),
                                row_html).alias("_l")).select("_l.*")
    frame = failures.select(F.lit(1).alias("_one")).limit(1).select(F.explode(F.array(
        line(0, none, none, none, none, F.lit(head_text)), line(2, none, none, none, none, F.lit(REPORT_TABLE_CLOSE)),
    )).alias("_l")).select("_l.*")
    return body.unionByName(frame)


def write_report(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the report lines in document order as text part files."""
    lines.orderBy(*LINE_ORDER).select("html").write.mode(mode).text(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, html): the written lines, numbered in document order.

    Lines are numbered within their part file and shifted by the lines of the
    files before it, so no task holds the document.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("html"), F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    files = lines.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = files.select("_file", (F.sum("_n").over(Window.orderBy("_file")) - F.col("_n")).alias("_before"))
    nth = F.row_number().over(Window.partitionBy("_file").orderBy("_block", "_at"))
    return (lines.withColumn("_nth", nth).join(before, "_file")
            .select((F.col("_before") + F.col("_nth")).alias("line_no"), "html"))
