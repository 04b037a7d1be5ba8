"""Reading vector columns in workers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dimension(df: DataFrame, vector: str) -> int:
    """The length of the longest vector."""
    return df.agg(F.coalesce(F.max(F.size(vector)), F.lit(0))).first()[0]


def matrix(column: pa.ListArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as rows of doubles, shorter ones filled with zeros, and which of them are whole.

    Null vectors and those with null or non-finite components are not.
    """
    out = np.zeros((len(column), width))
    whole = np.zeros(len(column), bool)
    if not column.null_count and not (flat := column.flatten()).null_count and len(flat) == width * len(column) and (np.diff(column.offsets.to_numpy()) == width).all():
        out[:] = flat.to_numpy(zero_copy_only=False).reshape(-1, width)
        whole[:] = True
    else:
        for at, row in enumerate(column.to_pylist()):
            if row is not None and None not in row:
                out[at, : len(row)] = row
                whole[at] = True
    whole &= np.isfinite(out).all(1)
    out[~whole] = 0
    return out, whole
