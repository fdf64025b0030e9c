"""DataFrame -> DataFrame operators. All are lazy; none collects."""

from opslog.operators.jobs import last_job_run, last_package_error, package_error_for  # noqa: F401
from opslog.operators.reports import (  # noqa: F401
    execution_history,
    large_renders,
    report_runs,
    report_stats,
    report_stats_from_rollup,
    run_detail,
    running_now,
    running_requests,
    runs_in_range,
    runs_per_user,
    runs_per_user_from_rollup,
    runs_since,
)
from opslog.operators.catalog import (  # noqa: F401
    catalog_types,
    configuration,
    data_source_dependents,
    path_permissions,
    reports_with_sources,
    shared_data_sources,
    user_permissions,
)
from opslog.operators.xmlshred import invalid_documents, report_queries, subscriptions_matching  # noqa: F401
from opslog.operators.subscriptions import subscription_jobs  # noqa: F401
from opslog.operators.state import (  # noqa: F401
    acknowledge,
    enrich_failures,
    failure_rows,
    merge_state,
    new_failures,
    suppress_ignored,
    to_state_rows,
)
from opslog.operators.notify import failure_report, write_report  # noqa: F401
from opslog.operators.latest import latest_per_key  # noqa: F401
from opslog.operators.ordering import numbered, sort_balanced  # noqa: F401
