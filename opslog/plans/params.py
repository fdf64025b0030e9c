"""Parameters used when the operators run over the stand-in tables.

They pick values that exist in the stand-ins at every scale factor; the
operators themselves take them as ordinary arguments.
"""

# Fixed values for the stand-in runs.
SINCE = "1998-01-01 00:00:00"
RANGE_START = "1998-01-01 00:00:00"
RANGE_END = "1998-03-31 00:00:00"
SINCE_MIDDAY = "1998-01-05 01:30:00"
UNTIL_MIDDAY = "1998-08-17 02:15:00"
NOW = "2001-01-01 00:00:00"
DOMAIN = "DOM\\"
REPORT_NAME = "red widget"
PRINCIPAL = "Customer#000000001"
PATH_PREFIX = "/Brand#1"
SETTING_TEXT = "user7"
SERVER = "SRV01"
MIN_KB = 100
DATA_SOURCE_NS = "urn:ds"
DATA_SOURCE_PATH = "/Data Sources/ds 8"
SNAPSHOT_CUTOFF = "2024-01-15 00:00:00"
# Days at which the second and third load of the job history begin.
HISTORY_LOADS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")

# Rows of the previous failure state that the current run no longer has:
# two vanished jobs and one row with a NULL key.
PREVIOUS_EXTRA_ROWS_SQL = """
SELECT CAST(InstanceID AS BIGINT) AS InstanceID, JobName, JobID, StepName, CAST(StepID AS INT) AS StepID,
  StepMessage, CAST(LastRunOutcome AS INT) AS LastRunOutcome, LastRunDateTime, LastRunDuration,
  CAST(UpdateFlag AS INT) AS UpdateFlag, SubSystem
FROM (VALUES
  (-1, 'vanished one', 'job-x1', 'signup', 1, 'old message', 0, TS('2024-01-02 03:04:05'), '00:01:00', 0, 'TSQL'),
  (-2, 'vanished two', 'job-x2', 'view', 2, 'old message', 1, TS('2024-01-03 03:04:05'), '00:02:00', 0, 'TSQL'),
  (-3, 'no key', NULL, 'click', 3, 'old message', 0, TS('2024-01-04 03:04:05'), '00:03:00', 0, 'SSIS')
) AS t(InstanceID, JobName, JobID, StepName, StepID, StepMessage, LastRunOutcome, LastRunDateTime, LastRunDuration, UpdateFlag, SubSystem)"""
