"""Embedding rows as byte strings: validity, one form for equal vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def packed(rows: DataFrame, id_col: str, vector_col: str, label_col: str | None = None) -> DataFrame:
    """(vec_id, label, vec): ``vec`` holds little-endian doubles, null for vectors that take no part.

    Those are null and empty vectors, vectors with a null or non-finite
    component, and zero vectors. Minus zero becomes zero.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col, out = b.column(2), []
            flat = col.flatten()
            values = flat.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # nulls become NaN
            at = 0
            for n in col.value_lengths().to_pylist():
                if n is None:
                    out.append(None)
                    continue
                v, at = values[at:at + n], at + n
                with np.errstate(over="ignore"):
                    ok = n > 0 and np.isfinite(v).all() and v.any()
                out.append(v.tobytes() if ok else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())],
                                             ["vec_id", "label", "vec"])

    label = F.col(label_col).cast("string") if label_col else F.lit(None).cast("string")
    src = rows.select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"),
                      F.col(vector_col).cast("array<double>").alias("v"))
    return src.mapInArrow(run, "vec_id long, label string, vec binary")


def matrix(column, dims: int) -> np.ndarray:
    """Rows of equal length as an array of doubles."""
    return np.frombuffer(b"".join(column), "<f8").reshape(-1, dims)
