"""Stand-in tables with the source system's shapes, derived from the driver's tables.

Each stand-in is ONE SQL text for both engines. Placeholders ``{lineitem}``
name base tables; ``TS('…')`` is a timestamp-without-zone literal. For Spark the
placeholders are bound to DataFrames through ``spark.sql(text, **frames)`` (no
global views); for DuckDB they become the pre-registered view names. ``chr(92)``
is the backslash in both engines.

Each is a narrow projection of one table (plus one grouping for job_steps),
so it scales with the table it reads.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from opslog.sources.testdata import read_table

STANDIN_SQL: dict[str, str] = {
    "execution_log": """
SELECT l_partkey AS ReportID, concat('DOM', chr(92), 'user', CAST(l_suppkey AS STRING)) AS UserName,
  CASE l_linestatus WHEN 'O' THEN 'PDF' ELSE 'EXCEL' END AS Format, concat('k=', CAST(l_orderkey AS STRING)) AS Parameters,
  CASE l_returnflag WHEN 'A' THEN 'rsSuccess' ELSE 'rsProcessingAborted' END AS Status,
  l_shipdate + CAST(l_orderkey AS INT) * INTERVAL '1' SECOND AS TimeStart,
  l_shipdate + (CAST(l_orderkey AS INT) + CAST(l_quantity AS INT) * 3601) * INTERVAL '1' SECOND AS TimeEnd,
  CAST(floor(l_extendedprice) AS INT) AS TimeDataRetrieval, CAST(floor(l_extendedprice / 10) AS INT) AS TimeProcessing,
  l_linenumber * 10 AS TimeRendering, CAST(floor(l_extendedprice * 3) AS BIGINT) AS ByteCount, l_orderkey AS RowCount
FROM {lineitem}""",
    "catalog": """
SELECT p_partkey AS ItemID, CASE WHEN p_partkey % 53 = 0 THEN '' ELSE p_name END AS Name,
  CASE WHEN p_partkey % 4 = 0 THEN concat('/Data Sources/ds ', CAST(p_partkey AS STRING)) ELSE concat('/', p_brand, '/', p_type, '/', p_name) END AS Path,
  CASE WHEN p_partkey % 97 = 5 THEN 3 WHEN p_partkey % 4 = 0 THEN 5 WHEN p_partkey % 4 = 1 THEN 1 ELSE 2 END AS Type,
  CASE p_partkey % 4 WHEN 0 THEN concat('<DataSourceDefinition xmlns="urn:ds"><Extension>SQL</Extension><ConnectString>Data Source=', p_brand, '</ConnectString><Enabled>true</Enabled></DataSourceDefinition>')
    WHEN 1 THEN NULL
    WHEN 3 THEN concat('<?xml version="1.0"?><!-- a --><?xml-stylesheet href="a"?><r:Report xmlns:r="urn:report"><r:DataSets><r:DataSet Name="C"><r:Query><r:DataSourceName>', p_brand, '</r:DataSourceName><r:CommandText>exec ', p_name, '</r:CommandText></r:Query></r:DataSet></r:DataSets></r:Report>')
    ELSE concat('<Report xmlns="urn:report" xmlns:rd="urn:rd"><DataSets><DataSet Name="A"><Query><DataSourceName>', p_brand, '</DataSourceName><CommandText>select ', p_name, '</CommandText></Query></DataSet>',
      CASE WHEN p_size % 2 = 0 THEN concat('<DataSet Name="B"><Query><DataSourceName>', p_type, '</DataSourceName><CommandType>StoredProcedure</CommandType><CommandText>p', CAST(p_size AS STRING), '</CommandText></Query></DataSet>') ELSE '' END,
      '</DataSets></Report>') END AS Content,
  CAST(floor(p_partkey / 8) AS BIGINT) AS PolicyID, CAST(floor(p_partkey * 3 / 4) AS BIGINT) AS CreatedByID,
  CAST(floor(p_partkey / 2) AS BIGINT) + 1 AS ModifiedByID,
  TS('2010-01-01 00:00:00') + p_size * INTERVAL '1' DAY AS CreationDate, TS('2012-01-01 00:00:00') + p_size * INTERVAL '1' HOUR AS ModifiedDate
FROM {part}""",
    "data_source": """
SELECT CASE WHEN p_partkey % 10 = 7 THEN -p_partkey ELSE p_partkey END AS ItemID, p_brand AS Name,
  CASE WHEN p_partkey % 4 < 2 THEN NULL ELSE 4 * CAST(floor(p_partkey / 32) AS BIGINT) END AS Link,
  'SQL' AS Extension, p_size % 5 AS CredentialRetrieval
FROM {part}""",
    "users": """
SELECT c_custkey AS UserID, c_name AS UserName, c_nationkey % 2 + 1 AS AuthType FROM {customer}""",
    "policies": """
SELECT c_custkey - 1 AS PolicyID FROM {customer}""",
    "policy_user_role": """
SELECT CAST(floor(c_custkey / 6) AS BIGINT) AS PolicyID, c_custkey AS UserID, c_custkey % 5 AS RoleID FROM {customer}""",
    "roles": """
SELECT r_regionkey AS RoleID, r_name AS RoleName, concat('role ', r_name) AS Description FROM {region}""",
    "sec_data": """
SELECT CAST(floor(c_custkey / 8) AS BIGINT) AS PolicyID, c_nationkey % 2 + 1 AS AuthType FROM {customer}""",
    "jobs": """
SELECT concat('job-', CAST(c_custkey AS STRING)) AS job_id,
  CASE WHEN c_custkey % 7 = 0 THEN concat('00000000-0000-0000-0000-', lpad(CAST(c_custkey AS STRING), 12, 'a')) ELSE c_name END AS name,
  CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 1 END AS enabled,
  TS('2011-01-01 00:00:00') AS date_created, TS('2011-01-01 00:00:00') + c_nationkey * INTERVAL '1' DAY AS date_modified
FROM {customer}""",
    "job_history": """
SELECT event_id AS instance_id, concat('job-', CAST(user_id AS STRING)) AS job_id,
  CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 ELSE 5 END AS step_id, props AS message
FROM {events}""",
    "job_steps": """
SELECT concat('job-', CAST(user_id AS STRING)) AS job_id,
  CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 ELSE 5 END AS step_id,
  event_type AS step_name, CASE event_type WHEN 'error' THEN 'SSIS' ELSE 'TSQL' END AS subsystem,
  concat('/FILE "C:', chr(92), 'ssis', chr(92), 'Pkg', CAST(user_id AS STRING), '.dtsx" /X') AS command,
  CASE WHEN max(event_id) % 3 = 0 THEN 0 ELSE 1 END AS last_run_outcome,
  CASE WHEN max(event_id) % 11 = 0 THEN 0 ELSE year(max(ts)) * 10000 + month(max(ts)) * 100 + day(max(ts)) END AS last_run_date,
  hour(max(ts)) * 10000 + minute(max(ts)) * 100 + second(max(ts)) AS last_run_time,
  CAST(floor(max(value) / 60) AS INT) * 100 + CAST(floor(max(value)) AS INT) % 60 AS last_run_duration
FROM {events} GROUP BY user_id, event_type""",
    "event_messages": """
SELECT CAST(floor(event_id / 4) AS BIGINT) AS operation_id, event_id AS event_message_id, ts AS message_time,
  concat('Pkg', CAST(user_id AS STRING), '.dtsx') AS package_name,
  CASE event_type WHEN 'error' THEN 'OnError' ELSE 'OnInformation' END AS event_name, props AS message
FROM {events}""",
    "ignore_jobs": """
SELECT c_name AS JobName, concat('job-', CAST(c_custkey AS STRING)) AS JobID FROM {customer} WHERE c_custkey % 11 = 0""",
    "running_jobs": """
SELECT concat('report ', CAST(o_orderkey AS STRING)) AS RequestName, concat('/', o_orderpriority) AS RequestPath, o_orderstatus AS ComputerName,
  CASE WHEN o_custkey % 13 = 0 THEN NULL ELSE o_custkey END AS UserId, CAST(o_orderkey % 1800 AS INT) AS Timeout,
  o_orderdate + CAST(o_orderkey % 86400 AS INT) * INTERVAL '1' SECOND AS StartDate, CAST(o_custkey % 9 AS INT) AS JobStatus
FROM {orders}""",
    "subscriptions": """
SELECT o_orderkey AS SubscriptionID, o_custkey AS Report_OID,
  concat('<ParameterValues><ParameterValue><Name>TO</Name><Value>', CASE WHEN o_orderkey % 3 = 0 THEN 'us<b>er</b>' WHEN o_orderkey % 3 = 1 THEN 'us<?p?>er' ELSE 'user' END, CAST(o_custkey AS STRING), '@example.com</Value></ParameterValue><ParameterValue><Name>CC</Name><Value>x</Value></ParameterValue></ParameterValues>') AS ExtensionSettings
FROM {orders}""",
    "report_schedule": """
SELECT upper(concat('00000000-0000-0000-0000-', lpad(CAST(o_custkey AS STRING), 12, 'a'))) AS ScheduleID, o_orderkey AS SubscriptionID
FROM {orders}""",
    "configuration": """
SELECT r_name AS Name, CAST(r_regionkey AS STRING) AS Value FROM {region}""",
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")
_TS = re.compile(r"TS\('([^']*)'\)")


def base_tables(name: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(STANDIN_SQL[name])))


def standin(spark: SparkSession, sf_dir: str, name: str, **frames: DataFrame) -> DataFrame:
    """Build stand-in ``name`` lazily; ``frames`` may replace base tables."""
    text = _TS.sub(r"TIMESTAMP_NTZ '\1'", STANDIN_SQL[name])
    args = {t: frames[t] if t in frames else read_table(spark, sf_dir, t) for t in base_tables(name)}
    return spark.sql(text, **args)


def standin_sql_for_duckdb(name: str, **sources: str) -> str:
    """The same text for DuckDB; ``sources`` may replace a base view by another name."""
    text = _TS.sub(r"TIMESTAMP '\1'", STANDIN_SQL[name])
    return _PLACEHOLDER.sub(lambda m: sources.get(m.group(1), m.group(1)), text)
