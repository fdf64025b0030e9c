"""Column helpers. Every helper maps Columns to a Column built only from
``pyspark.sql.functions``, so it stays inside whole-stage codegen."""

from opslog.functions.temporal import (  # noqa: F401
    coded_datetime,
    coded_duration_text,
    elapsed_clock_text,
    epoch_seconds,
    second_boundaries,
    seconds_as_time_text,
    sql_datetime_text,
)
from opslog.functions.text import (  # noqa: F401
    html_escape,
    package_file_name,
    parent_folder,
    strip_domain,
    text_contains,
    text_equals,
    text_like,
    text_replace,
    text_startswith,
    trimmed_length,
)
from opslog.functions.numeric import bytes_to_kb, int_avg, int_div  # noqa: F401
from opslog.functions.xmlvalue import (  # noqa: F401
    xml_fail_if_malformed,
    xml_first_text,
    xml_is_wellformed,
    xml_root_is,
    xml_root_namespace,
    xml_text,
)
