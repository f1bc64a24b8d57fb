"""Reading embeddings: what counts as a usable vector."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(v: str) -> Column:
    """Not null, no null or non-finite component, not all zero (nor empty)."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(v).isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


def usable_rows(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """``(vec_id, embedding)`` of the rows with an id and a usable vector, as doubles' arrays."""
    src = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).alias("embedding"))
    return src.where(F.col("vec_id").isNotNull()).where(usable("embedding"))


def matrix(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of equally long lists as a float64 matrix."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 0)


def tame(x: np.ndarray) -> np.ndarray:
    """Rows whose squares would over- or underflow, scaled by a power of two (which keeps their directions); others as they are."""
    top = np.abs(x).max(axis=1) if x.size else np.ones(len(x))
    far = (top > 1e100) | (top < 1e-100)
    if far.any():
        x = x.copy()
        x[far] = np.ldexp(x[far], -np.frexp(top[far])[1][:, None])
    return x
