"""DuckDB SQL for every registered query, over the same stand-in tables.

Formulated independently of the Spark operators: window functions with
QUALIFY for "latest" and "first error", EXISTS for the semi-joins, a left
join from the new rows for the state merge, arithmetic ``make_timestamp`` for
coded dates. XML values are read with regular expressions, which is exact for
the fixed shapes of the stand-in documents (no XML functions in DuckDB).
"""

from __future__ import annotations

import re

from opslog.operators.jobs import GUID_NAME_MASK
from opslog.plans import params as P
from opslog.plans.params import PREVIOUS_EXTRA_ROWS_SQL
from opslog.sources.standins import standin_sql_for_duckdb


def _ts(x: str) -> str:
    return f"TIMESTAMP '{x}'"


def _with(names: list[str], body: str, extra: list[tuple[str, str]] | None = None, **sources: str) -> str:
    ctes = [f"{n} AS ({standin_sql_for_duckdb(n, **sources)})" for n in names]
    ctes += [f"{n} AS ({sql})" for n, sql in (extra or [])]
    head = "WITH " + ",\n".join(ctes)
    b = body.lstrip()
    if b[:5].upper() == "WITH ":  # the body's own CTEs continue the list
        return head + ",\n" + b[5:]
    return head + "\n" + body


def folder(p: str) -> str:
    """Everything up to the last slash; a path without a slash stays whole."""
    return f"CASE WHEN strpos({p}, '/') = 0 THEN {p} ELSE regexp_extract({p}, '^(.*/)', 1) END"


def clock(seconds: str) -> str:
    """Seconds added to midnight, as HH:MM:SS of the wrapped time of day."""
    return (f"strftime(TIMESTAMP '2000-01-01 00:00:00' + to_seconds(((({seconds}) % 86400) + 86400) % 86400), "
            f"'%H:%M:%S')")


def coded_time_text(n: str) -> str:
    return f"regexp_replace(lpad(CAST({n} AS VARCHAR), 6, '0'), '^(..)(..)(..)$', '\\1:\\2:\\3')"


def coded_timestamp(d: str, t: str) -> str:
    return (f"CASE WHEN {d} <> 0 THEN make_timestamp({d} // 10000, ({d} // 100) % 100, {d} % 100, "
            f"{t} // 10000, ({t} // 100) % 100, {t} % 100) END")


def first_setting(x: str) -> str:
    inner = f"regexp_extract({x}, '<ParameterValue><Name>[^<]*</Name><Value>(.*?)</Value>', 1)"
    return f"NULLIF(regexp_replace({inner}, '<[^>]*>', '', 'g'), '')"  # the text without inner tags and instructions


def latest_runs(history: str, steps: str, jobs: str) -> str:
    """Newest history row of each step of enabled jobs whose names are not GUID-shaped."""
    return f"""
SELECT newest.instance_id, job.name, step.job_id, step.step_name, step.step_id, newest.message,
  step.last_run_outcome,
  {coded_timestamp('step.last_run_date', 'step.last_run_time')} AS LastRunDateTime,
  {coded_time_text('step.last_run_duration')} AS LastRunDuration,
  step.subsystem
FROM {steps} step
JOIN (SELECT job_id, step_id, instance_id, message FROM {history}
      QUALIFY row_number() OVER (PARTITION BY job_id, step_id ORDER BY instance_id DESC) = 1) newest
  USING (job_id, step_id)
JOIN {jobs} job USING (job_id)
WHERE job.enabled = 1
  AND job.name NOT LIKE '{GUID_NAME_MASK}'"""


BS = "chr(92)"
PACKAGE_ERRORS = f"""
SELECT pkg.job_id, pkg.step_id, pkg.PackageName, first_err.ErrorMessage, first_err.RankNum
FROM (SELECT job_id, step_id,
        regexp_extract(regexp_extract(command, '^(.*?)[.]dtsx', 1), '[' || {BS} || {BS} || ']([^' || {BS} || {BS} || ']*)$', 1)
          || '.dtsx' AS PackageName
      FROM job_steps
      WHERE subsystem = 'SSIS' AND contains(command, 'ssis') AND contains(command, '.dtsx')
        AND contains(regexp_extract(command, '^(.*?)[.]dtsx', 1), {BS})) pkg
JOIN (SELECT msg.package_name, left(msg.message, 4000) AS ErrorMessage,
             CAST(rank() OVER (PARTITION BY msg.operation_id ORDER BY msg.message_time, msg.event_message_id) AS INTEGER) AS RankNum
      FROM event_messages msg
      WHERE msg.event_name = 'OnError'
        AND msg.operation_id = (SELECT max(o.operation_id) FROM event_messages o WHERE o.package_name = msg.package_name)
     ) first_err
  ON first_err.package_name = pkg.PackageName
WHERE first_err.RankNum = 1"""

STATE_COLS = ("InstanceID, JobName, JobID, StepName, StepID, StepMessage, LastRunOutcome, "
              "LastRunDateTime, LastRunDuration, UpdateFlag, SubSystem")


def _as_state(runs: str, flag: int) -> str:
    return f"""
SELECT CAST(instance_id AS BIGINT) AS InstanceID, name AS JobName, job_id AS JobID, step_name AS StepName,
  CAST(step_id AS INTEGER) AS StepID, message AS StepMessage, CAST(last_run_outcome AS INTEGER) AS LastRunOutcome,
  LastRunDateTime, LastRunDuration, {flag} AS UpdateFlag, subsystem AS SubSystem FROM {runs}"""


def _state_steps() -> tuple[list[str], list[tuple[str, str]]]:
    """CTEs: earlier state -> new rows -> merged -> ignore list applied -> errors added."""
    extra_rows = re.sub(r"TS\('([^']*)'\)", r"TIMESTAMP '\1'", PREVIOUS_EXTRA_ROWS_SQL)
    fresh = "(o.InstanceID IS NULL OR o.InstanceID <> n.InstanceID)"
    ctes = [
        ("events_early", f"SELECT * FROM events WHERE ts < {_ts(P.SNAPSHOT_CUTOFF)}"),
        ("history_early", standin_sql_for_duckdb("job_history", events="events_early")),
        ("steps_early", standin_sql_for_duckdb("job_steps", events="events_early")),
        ("earlier", _as_state(f"({latest_runs('history_early', 'steps_early', 'jobs')})", 0)
         + "\nUNION ALL\n" + extra_rows),
        ("incoming", _as_state(f"({latest_runs('job_history', 'job_steps', 'jobs')})", 1)),
        ("merged", f"""
SELECT
  n.InstanceID,
  CASE WHEN {fresh} THEN n.JobName ELSE o.JobName END AS JobName,
  n.JobID,
  CASE WHEN {fresh} THEN n.StepName ELSE o.StepName END AS StepName,
  n.StepID,
  CASE WHEN {fresh} THEN n.StepMessage ELSE o.StepMessage END AS StepMessage,
  CASE WHEN {fresh} THEN n.LastRunOutcome ELSE o.LastRunOutcome END AS LastRunOutcome,
  CASE WHEN {fresh} THEN n.LastRunDateTime ELSE o.LastRunDateTime END AS LastRunDateTime,
  CASE WHEN o.InstanceID IS NULL THEN n.LastRunDuration ELSE o.LastRunDuration END AS LastRunDuration,
  CASE WHEN {fresh} THEN 1 ELSE o.UpdateFlag END AS UpdateFlag,
  CASE WHEN {fresh} THEN n.SubSystem ELSE o.SubSystem END AS SubSystem
FROM incoming n LEFT JOIN earlier o ON o.JobID = n.JobID AND o.StepID = n.StepID"""),
        ("quieted", """
SELECT m.* REPLACE (CASE WHEN EXISTS (SELECT 1 FROM ignore_jobs ig WHERE ig.JobID = m.JobID) THEN 0
                         ELSE m.UpdateFlag END AS UpdateFlag)
FROM merged m"""),
        ("package_errors", PACKAGE_ERRORS),
        ("with_errors", """
SELECT q.* REPLACE (CASE WHEN q.LastRunOutcome = 0 AND q.SubSystem = 'SSIS'
                         THEN (SELECT min(pe.ErrorMessage) FROM package_errors pe
                               WHERE pe.job_id = q.JobID AND pe.step_id = q.StepID)
                         ELSE q.StepMessage END AS StepMessage)
FROM quieted q"""),
        ("to_report", """
SELECT * FROM with_errors WHERE UpdateFlag = 1 AND LastRunOutcome = 0 AND LastRunDateTime IS NOT NULL"""),
    ]
    return ["job_history", "job_steps", "jobs", "event_messages", "ignore_jobs"], ctes


def _state_query(body: str) -> str:
    names, ctes = _state_steps()
    return _with(names, body, ctes)


def _cell(x: str) -> str:
    """A table cell with &, <, > escaped; NULL gives no cell."""
    esc = f"replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(13), '&#x0D;')"
    return f"coalesce('<td>' || {esc} || '</td>', '')"


REPORT_TOP = (
    '<H1 align="center" style="font-family:Cambria;">' + P.SERVER + ' Job Failure Report</H1>'
    '<table border="1" style="border: solid black 1px;font-family:Calibri;font-size:13">'
    "<tr><th>Job Name</th><th>Step Name</th><th>Step Message</th><th>Last Run DateTime</th><th>Last Run Duration</th></tr>"
)

REPORT_LINES = f"""
SELECT 1 AS part, JobName, StepName, LastRunDateTime, InstanceID,
  '<tr>' || {_cell('JobName')} || {_cell('StepName')} || {_cell('StepMessage')} ||
  {_cell("strftime(LastRunDateTime, '%Y-%m-%d %H:%M:%S')")} || {_cell('LastRunDuration')} || '</tr>' AS html
FROM to_report
UNION ALL
SELECT frame.part, NULL::VARCHAR, NULL::VARCHAR, NULL::TIMESTAMP, NULL::BIGINT, frame.html
FROM (VALUES (0, '{REPORT_TOP}'), (2, '</table>')) frame(part, html)
WHERE (SELECT count(*) FROM to_report) > 0"""


def oracle_sql() -> dict[str, str]:
    since, lo, hi, now = _ts(P.SINCE), _ts(P.RANGE_START), _ts(P.RANGE_END), _ts(P.NOW)
    log_cat = ["execution_log", "catalog"]
    span = "date_diff('second', run.TimeStart, run.TimeEnd)"
    q: dict[str, str] = {}

    q["last_job_run"] = _with(["job_history", "job_steps", "jobs"], latest_runs("job_history", "job_steps", "jobs"))
    q["last_package_error"] = _with(["job_steps", "event_messages"], PACKAGE_ERRORS)
    q["execution_history"] = _with(log_cat, f"""
SELECT item.Name AS ReportName, {folder('item.Path')} AS ReportPath, run.TimeStart, run.TimeEnd,
  {clock(span)} AS Duration, run.Parameters, replace(run.UserName, '{P.DOMAIN}', '') AS UserName,
  run.Format AS ReportFormat, run.Status, run.TimeDataRetrieval, run.TimeProcessing, run.TimeRendering,
  round(run.ByteCount / 1024, 2)::DECIMAL(10,2) AS RenderedKB, run.RowCount
FROM execution_log run JOIN catalog item ON item.ItemID = run.ReportID""")
    q["report_queries"] = _with(["catalog"], f"""
WITH plain AS (SELECT Path, Name, regexp_replace(Content, '(</?)r:', '\\1', 'g') AS doc FROM catalog),
sets AS (
  SELECT Path, Name, unnest(regexp_extract_all(doc, '<DataSet Name="[^"]*">.*?</DataSet>')) AS dataset
  FROM plain WHERE regexp_matches(doc, '^(<[?!][^>]*>)*<Report[ >]')),
queries AS (
  SELECT Path, Name, regexp_extract(dataset, 'Name="([^"]*)"', 1) AS DataSetName,
         unnest(regexp_extract_all(dataset, '<Query>.*?</Query>')) AS query
  FROM sets)
SELECT {folder('Path')} AS ReportPath, Name AS ReportName, DataSetName,
  NULLIF(regexp_extract(query, '<DataSourceName>([^<]*)<', 1), '') AS DataSourceName,
  coalesce(NULLIF(regexp_extract(query, '<CommandType>([^<]*)<', 1), ''), 'T-SQL') AS CommandType,
  NULLIF(regexp_extract(query, '<CommandText>([^<]*)<', 1), '') AS CommandText
FROM queries""")
    q["running_now"] = _with(["running_jobs", "users"], f"""
SELECT req.RequestName, req.RequestPath, req.ComputerName, who.UserName, req.Timeout AS TimeoutSec, req.StartDate,
  CASE WHEN req.JobStatus IN (0, 4, 5) THEN 'Success' WHEN req.JobStatus IN (1, 2, 3, 7) THEN 'InProgress'
       ELSE 'Undefined' END AS JobStatus,
  ((age_s // 3600) % 24)::VARCHAR || strftime(TIMESTAMP '2000-01-01 00:00:00' + to_seconds(age_s % 3600), ':%M:%S')
    AS TimeElapsed
FROM (SELECT *, (epoch_us({now}) - epoch_us(StartDate)) // 1000000 AS age_s FROM running_jobs) req
LEFT JOIN users who ON who.UserID = req.UserId
WHERE req.StartDate + INTERVAL 1 MINUTE < {now}""")
    q["merge_state"] = _state_query(f"SELECT {STATE_COLS} FROM merged")
    q["suppress_ignored"] = _state_query(f"SELECT {STATE_COLS} FROM quieted")
    q["enrich_failures"] = _state_query(f"SELECT {STATE_COLS} FROM with_errors")
    q["new_failures"] = _state_query(f"SELECT {STATE_COLS} FROM to_report ORDER BY JobName, StepName, LastRunDateTime")
    q["failure_report"] = _state_query(REPORT_LINES)
    q["written_report"] = _state_query(f"""
SELECT row_number() OVER (ORDER BY part, JobName NULLS FIRST, StepName NULLS FIRST, LastRunDateTime NULLS FIRST,
  InstanceID NULLS FIRST) AS line_no, html FROM ({REPORT_LINES})""")
    q["merge_state_by_bucket"] = q["merge_state"]
    q["last_job_run_incremental"] = q["last_job_run"]
    q["acknowledge"] = _state_query(f"SELECT * REPLACE (0 AS UpdateFlag) FROM with_errors")
    q["failure_notification"] = q["acknowledge"]
    q["lateral_table_function"] = q["enrich_failures"]

    q["q1_reports_with_sources"] = _with(["catalog", "data_source", "users"], """
SELECT r.Name AS ReportName, r.Path AS ReportManagerPath, src.Name AS DataSourceName, creator.UserName AS CreatedByUser,
  r.CreationDate, r.ModifiedDate
FROM (SELECT * FROM catalog WHERE Type = 2) r
LEFT JOIN data_source src ON src.ItemID = r.ItemID
LEFT JOIN users creator ON creator.UserID = r.CreatedByID
ORDER BY ReportName""")
    q["q2_catalog_types"] = _with(["catalog"], """
SELECT Name, Type,
  CASE Type WHEN 1 THEN 'Folder' WHEN 2 THEN 'Report' WHEN 5 THEN 'Data Source' ELSE 'Other' END AS TypeDescription
FROM catalog ORDER BY Name""")
    q["q3_subscription_jobs"] = _with(["report_schedule", "jobs", "job_steps", "subscriptions", "catalog"], f"""
SELECT rep.Name AS ReportName, rep.Path AS ReportPath, job.name AS JobName, job.date_created AS Date_Created,
  job.date_modified AS Date_Modified, {first_setting('sub.ExtensionSettings')} AS ExtSettingsXML,
  {coded_timestamp('step.last_run_date', 'step.last_run_time')} AS LastRunDateTime
FROM report_schedule sched
JOIN jobs job ON upper(job.name) = upper(sched.ScheduleID::VARCHAR)
JOIN job_steps step ON step.job_id = job.job_id
JOIN subscriptions sub ON sub.SubscriptionID = sched.SubscriptionID
JOIN catalog rep ON rep.ItemID = sub.Report_OID
ORDER BY ReportName, LastRunDateTime""")
    grants = """
WITH grants AS (
  SELECT link.PolicyID, who.UserName, who.AuthType, role.RoleName, role.Description
  FROM policy_user_role link
  JOIN users who ON who.UserID = link.UserID
  JOIN roles role ON role.RoleID = link.RoleID
  WHERE EXISTS (SELECT 1 FROM policies pol WHERE pol.PolicyID = link.PolicyID))
SELECT CASE WHEN item.Name = '' THEN 'Root Folder' ELSE item.Name END AS ObjectName, item.Path AS ObjectPath,
  g.UserName, g.RoleName, g.Description, g.AuthType
FROM catalog item JOIN grants g ON g.PolicyID = item.PolicyID"""
    perm_tables = ["users", "policy_user_role", "policies", "roles", "catalog"]
    q["q4_user_permissions"] = _with(perm_tables, grants + f"""
WHERE g.UserName = '{P.PRINCIPAL}' ORDER BY item.Name, g.UserName, g.RoleName""")
    q["q5_path_permissions"] = _with(perm_tables, grants + f"""
WHERE starts_with(item.Path, '{P.PATH_PREFIX}') ORDER BY item.Name, item.Path, g.UserName, g.RoleName""")
    sources = f"""
WITH defs AS (
  SELECT it.ItemID, it.Name, it.Path, it.Content, it.CreationDate, it.ModifiedDate, src.Extension,
    CASE src.CredentialRetrieval WHEN 1 THEN 'User Supplied' WHEN 2 THEN 'Stored' WHEN 3 THEN 'Windows Integrated'
      WHEN 4 THEN 'Not Required' END AS CredentialType,
    creator.UserName AS CreatedBy, editor.UserName AS ModifiedBy
  FROM catalog it
  JOIN users creator ON creator.UserID = it.CreatedByID
  JOIN users editor ON editor.UserID = it.ModifiedByID
  JOIN data_source src ON src.ItemID = it.ItemID
  WHERE it.Type = 5 AND starts_with(it.Content, '<DataSourceDefinition xmlns="{P.DATA_SOURCE_NS}">')),
users_of AS (
  SELECT src.Link AS DSLink, it.Name AS ObjectName
  FROM catalog it
  JOIN data_source src ON src.ItemID = it.ItemID
  JOIN users creator ON creator.UserID = it.CreatedByID
  JOIN users editor ON editor.UserID = it.ModifiedByID
  LEFT JOIN (SELECT PolicyID FROM sec_data WHERE AuthType = 1) sec ON sec.PolicyID = it.PolicyID)"""
    def_fields = """NULLIF(regexp_extract(d.Content, '<ConnectString>([^<]*)<', 1), '') AS ConnectionString,
  NULLIF(regexp_extract(d.Content, '<Enabled>([^<]*)<', 1), '') AS DataSourceEnabled,
  d.Extension, d.CredentialType, d.CreationDate, d.CreatedBy, d.ModifiedDate, d.ModifiedBy, d.Content AS DataSourceXML"""
    ds_tables = ["catalog", "users", "data_source", "sec_data"]
    q["q6_shared_data_sources"] = _with(ds_tables, sources + f"""
SELECT d.Path AS DataSourcePath, d.Name AS SharedDataSourceName,
  (SELECT count(*) FROM users_of u WHERE u.DSLink = d.ItemID) AS Dependents,
  {def_fields}
FROM defs d ORDER BY DataSourcePath, SharedDataSourceName""")
    q["q7_data_source_dependents"] = _with(ds_tables, sources + f"""
SELECT d.Path AS DataSourcePath, d.Name AS SharedDataSourceName, u.DSLink, u.ObjectName,
  {def_fields}
FROM defs d LEFT JOIN users_of u ON u.DSLink = d.ItemID ORDER BY DataSourcePath, SharedDataSourceName""")
    q["q7_one_data_source"] = _with(ds_tables, sources + f"""
SELECT d.Path AS DataSourcePath, d.Name AS SharedDataSourceName, u.DSLink, u.ObjectName,
  {def_fields}
FROM defs d LEFT JOIN users_of u ON u.DSLink = d.ItemID WHERE d.Path = '{P.DATA_SOURCE_PATH}'""")
    q["q8_report_runs"] = _with(log_cat, f"""
SELECT item.Name AS ReportName, item.Path AS ReportPath, run.TimeStart, run.TimeEnd, run.Parameters, run.UserName,
  run.Status, run.TimeDataRetrieval, run.TimeProcessing, run.TimeRendering, {clock(span)} AS CommandDuration
FROM execution_log run JOIN catalog item ON item.ItemID = run.ReportID AND item.Name = '{P.REPORT_NAME}'
WHERE run.TimeStart > {since} ORDER BY run.TimeStart DESC""")
    q["q9_runs_since"] = _with(log_cat, f"""
SELECT item.Name AS ReportName, item.Path AS ReportPath, run.TimeStart, run.TimeEnd, run.Parameters, run.UserName,
  run.Status
FROM execution_log run JOIN catalog item ON item.ItemID = run.ReportID
WHERE run.TimeStart > {since} ORDER BY run.TimeStart DESC""")
    q["q10_running_requests"] = _with(["running_jobs"], "FROM running_jobs ORDER BY StartDate")
    q["q11_large_renders"] = _with(["execution_log"], f"""
FROM execution_log WHERE ByteCount >= 0 AND floor(ByteCount / 1024) > {P.MIN_KB} ORDER BY ByteCount DESC""")
    q["q12_runs_in_range"] = _with(log_cat, f"""
SELECT run.UserName, run.TimeStart, run.TimeEnd, run.TimeDataRetrieval, run.TimeProcessing, run.TimeRendering, item.Name
FROM execution_log run JOIN catalog item ON item.ItemID = run.ReportID
WHERE run.TimeStart BETWEEN {lo} AND {hi} ORDER BY run.TimeStart""")
    q["q13_report_stats"] = _with(log_cat, f"""
SELECT item.Name, count(*) AS TimesRun, trunc(avg(run.TimeProcessing))::BIGINT AS AvgProcTimeMS,
  max(run.TimeStart) AS LastRunDate
FROM execution_log run JOIN catalog item ON item.ItemID = run.ReportID
WHERE run.TimeStart >= {since} GROUP BY item.Name ORDER BY AvgProcTimeMS DESC""")
    q["q14_run_detail"] = _with(log_cat, f"""
SELECT run.UserName, run.TimeStart, run.TimeEnd, run.TimeDataRetrieval, run.TimeProcessing, run.TimeRendering, item.Name
FROM execution_log run JOIN catalog item ON item.ItemID = run.ReportID WHERE run.TimeStart >= {since}""")
    q["q15_runs_per_user"] = _with(["execution_log"], f"""
SELECT UserName, count(*) AS NumReports FROM execution_log
WHERE TimeStart BETWEEN {lo} AND {hi} GROUP BY ALL ORDER BY UserName""")
    q["q16_configuration"] = _with(["configuration"], "FROM configuration")
    q["q17_subscriptions_matching"] = _with(["catalog", "subscriptions"], f"""
SELECT * FROM (
  SELECT item.ItemID, item.Path AS ReportPath, item.Name AS ReportName, sub.SubscriptionID,
    {first_setting('sub.ExtensionSettings')} AS ExtSettingsXML, sub.ExtensionSettings AS ActualXML
  FROM subscriptions sub JOIN catalog item ON item.ItemID = sub.Report_OID)
WHERE contains(ExtSettingsXML, '{P.SETTING_TEXT}') ORDER BY ReportPath, ReportName""")
    q["q13_report_stats_from_rollup"] = q["q13_report_stats"].replace(since, _ts(P.SINCE_MIDDAY))
    q["q15_runs_per_user_from_rollup"] = q["q15_runs_per_user"].replace(
        f"BETWEEN {lo} AND {hi}", f"BETWEEN {_ts(P.SINCE_MIDDAY)} AND {_ts(P.UNTIL_MIDDAY)}")

    def mixed(name: str, *columns: tuple[str, str]) -> tuple[str, str]:
        """A CTE over stand-in ``name``: texts in upper case with blanks, in lower case, or as they are, by a number."""
        sql = standin_sql_for_duckdb(name)
        for c, n in columns:
            sql = (f"SELECT * REPLACE (CASE {n} % 3 WHEN 0 THEN upper({c}) || '  ' WHEN 1 THEN lower({c}) ELSE {c} END AS {c}) "
                   f"FROM ({sql})")
        return name, sql

    def collated(query: str, tables: list[str], change: tuple[str, str], *replaced: tuple[str, str]) -> str:
        """The query over a changed stand-in, with its comparisons written out without case and trailing blanks."""
        body = query[len(_with(tables, "").rstrip("\n")):]
        body = "WITH " + body[2:] if body.startswith(",") else body  # the body's own CTEs
        for a, b in replaced:
            assert a in body, (a, body)
            body = body.replace(a, b)
        return _with([t for t in tables if t != change[0]], body, [change])

    def key(x: str) -> str:
        return f"rtrim(lower({x}), ' ')"

    q["collated_q3_subscription_jobs"] = collated(
        q["q3_subscription_jobs"], ["report_schedule", "jobs", "job_steps", "subscriptions", "catalog"],
        ("jobs", f"SELECT * REPLACE (lower(name) || ' ' AS name) FROM ({standin_sql_for_duckdb('jobs')})"),
        ("upper(job.name) = upper(sched.ScheduleID::VARCHAR)", f"{key('job.name')} = {key('sched.ScheduleID::VARCHAR')}"))
    q["collated_q4_user_permissions"] = collated(
        q["q4_user_permissions"], perm_tables, mixed("users", ("UserName", "UserID")),
        (f"g.UserName = '{P.PRINCIPAL}'", f"{key('g.UserName')} = {key(repr(P.PRINCIPAL))}"))
    q["collated_q5_path_permissions"] = collated(
        q["q5_path_permissions"], perm_tables, mixed("catalog", ("Path", "ItemID")),
        (f"starts_with(item.Path, '{P.PATH_PREFIX}')", f"starts_with(lower(item.Path), lower('{P.PATH_PREFIX}'))"))
    q["collated_q7_one_data_source"] = collated(
        q["q7_one_data_source"], ds_tables, mixed("catalog", ("Path", "ItemID")),
        (f"d.Path = '{P.DATA_SOURCE_PATH}'", f"{key('d.Path')} = {key(repr(P.DATA_SOURCE_PATH))}"))
    q["collated_q8_report_runs"] = collated(
        q["q8_report_runs"], log_cat, mixed("catalog", ("Name", "ItemID")),
        (f"item.Name = '{P.REPORT_NAME}'", f"{key('item.Name')} = {key(repr(P.REPORT_NAME))}"))
    q["collated_q13_report_stats"] = collated(
        q["q13_report_stats"], log_cat, mixed("catalog", ("Name", "ItemID")),
        ("SELECT item.Name,", "SELECT min(item.Name) AS Name,"), ("GROUP BY item.Name", f"GROUP BY {key('item.Name')}"))
    q["collated_q15_runs_per_user"] = collated(
        q["q15_runs_per_user"], ["execution_log"], mixed("execution_log", ("UserName", "ReportID")),
        ("SELECT UserName,", "SELECT min(UserName) AS UserName,"), ("GROUP BY ALL", f"GROUP BY {key('UserName')}"))
    q["collated_q17_subscriptions_matching"] = q["q17_subscriptions_matching"].replace(
        f"contains(ExtSettingsXML, '{P.SETTING_TEXT}')", f"contains(lower(ExtSettingsXML), lower('{P.SETTING_TEXT}'))")
    q["collated_last_package_error"] = collated(
        q["last_package_error"], ["job_steps", "event_messages"],
        mixed("event_messages", ("package_name", "event_message_id"), ("event_name", "event_message_id")),
        ("msg.event_name = 'OnError'", f"{key('msg.event_name')} = 'onerror'"),
        ("o.package_name = msg.package_name", f"{key('o.package_name')} = {key('msg.package_name')}"),
        ("first_err.package_name = pkg.PackageName", f"{key('first_err.package_name')} = {key('pkg.PackageName')}"))

    def numbered(query: str, order: str) -> str:
        return f"SELECT *, row_number() OVER (ORDER BY {order}) AS line_no FROM ({query})"

    q["numbered_report_runs"] = numbered(
        q["q8_report_runs"], "TimeStart DESC, Parameters, ReportPath, UserName, TimeEnd, Status, TimeDataRetrieval, "
                             "TimeProcessing, TimeRendering")
    q["numbered_large_renders"] = numbered(
        q["q11_large_renders"], "ByteCount DESC, ReportID, Parameters, TimeStart, TimeRendering, UserName, TimeEnd, Status, "
                                "Format, TimeDataRetrieval")
    q["numbered_report_stats"] = numbered(q["q13_report_stats"], "AvgProcTimeMS DESC NULLS LAST, Name NULLS FIRST")
    q["numbered_new_failures"] = _state_query(
        f"SELECT {STATE_COLS}, row_number() OVER (ORDER BY JobName NULLS FIRST, StepName NULLS FIRST, LastRunDateTime, "
        "InstanceID) AS line_no FROM to_report")
    q["report_queries_binary"] = q["report_queries"]
    q["view_last_job_run"] = q["last_job_run"]
    q["view_execution_history"] = q["execution_history"]
    q["view_report_queries"] = q["report_queries"]
    q["view_running_now"] = q["running_now"]
    q["runs_in_range_by_period"] = q["q12_runs_in_range"]
    q["parent_folder"] = _with(["catalog"], f"SELECT ItemID, Path, {folder('Path')} AS Folder FROM catalog")
    q["second_boundaries"] = _with(["execution_log"], f"""
SELECT ReportID, Parameters, date_diff('second', run.TimeStart, run.TimeEnd) AS Seconds, {clock(span)} AS Clock
FROM execution_log run""")
    q["int_avg"] = _with(["execution_log"], """
SELECT Format, trunc(avg(TimeRendering))::BIGINT AS AvgRendering, count(*) AS Runs FROM execution_log GROUP BY Format""")
    q["latest_per_key"] = _with(["execution_log"], """
SELECT ReportID, TimeStart, UserName, Status, Parameters FROM execution_log
QUALIFY row_number() OVER (PARTITION BY ReportID ORDER BY TimeStart DESC, Parameters DESC, UserName DESC,
  RowCount DESC, TimeRendering DESC, ByteCount DESC, Status DESC) = 1""")
    return q
