"""Incremental assignment: distance bounds tell which points can't have changed their cluster.

A row keeps its cluster, an upper bound of the distance to that centre and a lower bound of the
distance to all others. When centres move, the upper bound grows by its centre's shift and the lower one
shrinks by the largest shift of the others; while the upper bound stays below the lower one, the
cluster is certainly the same, and the vector needn't be looked at.

"The same" means what :func:`ratingstream.operators.kmeans.assign_clusters` computes, rounding and ties
included: the bounds carry the rounding errors of sums of ``dim`` squares, so a point near a tie is always
scored again. Bounds that are no number never tell anything.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kmeans import nearest_of, squared_distances, vectors_of

# Python workers get these functions by value, so they need not find the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Half the distance between 1 and the next double, and what covers the underflow of squares.
UNIT, TINY = 2.0**-53, 1e-140
BOUNDS = "cluster int, upper double, lower double"


def slack(dim: int) -> float:
    """A bound of the relative error of a computed distance (a root of a sum of ``dim`` rounded squares)."""
    n = (dim + 8) * UNIT
    return n / (1 - n)


def _bounds_of(centers: np.ndarray):
    c = np.ascontiguousarray(centers, dtype=np.float64)
    k, dim = c.shape
    g = slack(dim)

    def bounds(features: pa.Array) -> pa.Array:
        x = vectors_of(features)
        names = ["cluster", "upper", "lower"]
        if x is None:
            return pa.StructArray.from_arrays([pa.array([], t) for t in (pa.int32(), pa.float64(), pa.float64())], names)
        d = squared_distances(x, c)
        own = nearest_of(d)
        rows = np.arange(len(d))
        upper = np.sqrt(d[rows, own]) * (1 + g) + TINY
        d[rows, own] = np.inf
        lower = np.sqrt(d.min(axis=1)) * (1 - g) - TINY if k > 1 else np.full(len(d), np.inf)
        return pa.StructArray.from_arrays([pa.array(own.astype(np.int32)), pa.array(upper), pa.array(lower)], names)

    return F.arrow_udf(bounds, BOUNDS)


def scored_bounds(vectors: DataFrame, centers, features: str = "features", key: str = "movie_id") -> DataFrame:
    """``key, cluster, upper, lower``: every vector scored against all centres."""
    b = _bounds_of(np.asarray(centers, dtype=np.float64))(F.col(features))
    return vectors.select(key, b.alias("b")).select(key, "b.cluster", "b.upper", "b.lower")


def shifts(before, after) -> tuple[np.ndarray, np.ndarray]:
    """Per centre: (how far it moved, at most; the largest such shift of the other centres)."""
    a, b = np.asarray(before, dtype=np.float64), np.asarray(after, dtype=np.float64)
    own = np.sqrt(((b - a) ** 2).sum(axis=1)) * (1 + slack(a.shape[1])) + TINY
    others = np.array([np.delete(own, j).max(initial=0.0) for j in range(len(own))])
    return own, others


def _of_cluster(values: np.ndarray) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("cluster") + 1)


def moved_bounds(bounds: DataFrame, before, after) -> DataFrame:
    """The bounds after centres moved, and ``stays``: whether the cluster is certainly the same."""
    own, others = shifts(before, after)
    g = slack(np.shape(before)[1])
    grown = (F.col("upper") + _of_cluster(own)) * F.lit(1 + 4 * UNIT)
    shrunk = F.col("lower") - _of_cluster(others) - (F.abs("lower") + _of_cluster(others)) * F.lit(4 * UNIT)
    if len(own) == 1:
        shrunk = F.lit(float("inf"))
    out = bounds.withColumn("upper_", grown).withColumn("lower_", shrunk)
    apart = F.col("upper_") * F.lit(1 + g) + F.lit(TINY) < F.col("lower_") * F.lit(1 - g) - F.lit(TINY)
    # An infinite bound may come from squares beyond the doubles, so it bounds nothing.
    known = ~F.isnan("upper_") & ~F.isnan("lower_") & (F.col("upper_") < float("inf"))
    if len(own) > 1:
        known = known & (F.col("lower_") < float("inf"))
    return out.select(*[c for c in bounds.columns if c not in ("upper", "lower")], F.col("upper_").alias("upper"), F.col("lower_").alias("lower"), (known & apart).alias("stays"))


def advance(bounds: DataFrame, vectors: DataFrame, before, after, features: str = "features", key: str = "movie_id") -> DataFrame:
    """``key, cluster, upper, lower, rescored`` under the moved centres; only vectors whose bounds cross are read.

    The rows to score again are joined to the vectors, which stay where they are: Spark broadcasts
    the few rows by its own size check, or shuffles them to the vectors' partitioning.
    """
    moved = moved_bounds(bounds, before, after)
    same = moved.where("stays").select(key, "cluster", "upper", "lower", F.lit(False).alias("rescored"))
    crossed = moved.where("NOT stays").select(key)
    again = scored_bounds(crossed.join(vectors.select(key, features), key), after, features, key)
    return same.unionByName(again.withColumn("rescored", F.lit(True)))
