"""Inputs: base tables, stand-in tables shaped like the source system's, and
the versioned state store."""

from opslog.sources.testdata import read_table  # noqa: F401
from opslog.sources.standins import STANDIN_SQL, standin, standin_sql_for_duckdb  # noqa: F401
from opslog.sources.snapshots import SnapshotStore  # noqa: F401
from opslog.sources.logstore import period_bounds, write_by_period  # noqa: F401
from opslog.sources.bucketed import save_bucketed  # noqa: F401
