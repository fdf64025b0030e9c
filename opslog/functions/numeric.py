"""Integer arithmetic with truncating division, as the source dialect does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def int_div(a, b) -> Column:
    """Integer division truncated toward zero (``a div b``); NULL when b is 0."""
    a, b = _c(a).cast("long"), _c(b).cast("long")
    return F.when(b != 0, F.call_function("div", a, b))


def int_avg(x) -> Column:
    """Average of an integer column, truncated toward zero (integer AVG).

    Built from sum and count so it keeps partial aggregation.
    """
    return int_div(F.sum(_c(x).cast("long")), F.count(_c(x)))


def bytes_to_kb(n, precision: int = 10, scale: int = 2) -> Column:
    """Bytes -> kilobytes as DECIMAL(10,2), rounded half up."""
    return (_c(n).cast("decimal(20,0)") / F.lit(1024)).cast(f"decimal({precision},{scale})")
