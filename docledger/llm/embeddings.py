"""Embedding columns as matrices: which vectors count, and batches of them as arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Scaled components are kept within this, where a double still holds every integer.
MOST = 1 << 52


def usable(rows: DataFrame, vector: str, *columns) -> DataFrame:
    """The given columns and ``vector`` of the rows whose vector is there and holds no null, NaN or infinity."""
    v = F.col(f"`{vector}`")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return rows.where(v.isNotNull() & ~bad).select(*columns, v.alias("vector"))


def width_of(vectors: DataFrame) -> int:
    """The length of the longest vector, 0 without any; shorter ones count as if zeros followed."""
    return vectors.agg(F.max(F.size("vector")).alias("d")).head()["d"] or 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as doubles, one row for each vector."""
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def floored(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * value) as integers, kept within ``MOST``."""
    return np.clip(np.floor(values * scale), -MOST, MOST).astype(np.int64)


def largest(values: np.ndarray) -> int:
    return int(np.abs(values).max(initial=0))
