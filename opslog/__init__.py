"""opslog: operational analytics over job-run logs, report-execution logs and a
content catalog, written as lazy Spark DataFrame operators.

Layout
------
functions/  column helpers (Column -> Column), built-in Spark functions only
sources/    readers for the input tables, stand-in tables, versioned state store
operators/  DataFrame -> DataFrame operators (jobs, reports, catalog, XML, state)
plans/      multi-step plans (failure notification run) and the query registry
streaming/  micro-batch caller for the failure notification run
"""

__version__ = "0.1.0"
