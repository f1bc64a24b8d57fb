"""Streaming k-means as DataFrame operators.

The model is a K-row table ``(cluster INT, center ARRAY<DOUBLE>, weight DOUBLE)``.
One training step is :func:`cluster_stats` (partial + final aggregate over the
batch) → :func:`update_centers` (forgetting factor and the mini-batch rule) →
:func:`split_dying_cluster`. The rule follows the public MLlib streaming
k-means update; nothing here is specific to a data size: every operator works
on K rows or is a distributed aggregate.
"""

from __future__ import annotations

import math
import secrets
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.vectors import nearest_center
from .exact_sum import sums_on_driver, weighted_sums
from ..schemas import MODEL_STATE

# Python workers get the scoring functions by value, so they need not find the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the update rule (public MLlib streaming k-means):
# weights are floored at 1e-16 in the step size, a cluster is dying when its
# weight is below 1e-8 times the largest weight, and a split moves the two
# centres apart by 1e-14 * max(|x|, 1) per element.
WEIGHT_FLOOR = 1e-16
DYING_RATIO = 1e-8
SPLIT_EPS = 1e-14

# --------------------------------------------------------------------------- init


def state_frame(spark: SparkSession, centers, weights) -> DataFrame:
    """A model table from K centres held on the driver (K x D is the model size)."""
    table = pa.table(
        {
            "cluster": pa.array(range(len(weights)), pa.int32()),
            "center": pa.array([np.asarray(c, dtype=np.float64) for c in centers], pa.list_(pa.float64())),
            "weight": pa.array(np.asarray(weights, dtype=np.float64)),
        }
    )
    # as Arrow it is a local table: writing it starts no Python worker
    return spark.createDataFrame(table, MODEL_STATE)


def init_centers(
    spark: SparkSession, k: int = 5, dim: int = 1128, weight: float = 0.0, seed: int | None = None
) -> DataFrame:
    """K random centres with standard normal elements, all with the same weight.

    An element is the Box-Muller transform of two uniform numbers, which are 48
    bits of the md5 of ``seed:cluster:element:1`` and ``...:2``; so a seed gives the
    same centres on any cluster, and an SQL engine can check them.
    """
    seed = secrets.randbits(48) if seed is None else seed

    def uniform(cluster: Column, i: Column, which: int) -> Column:
        text = F.concat_ws(":", F.lit(str(seed)), cluster.cast("string"), i.cast("string"), F.lit(str(which)))
        bits = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double")
        return (bits + F.lit(1.0)) / F.lit(float(2**48 + 1))

    def normal(cluster: Column, i: Column) -> Column:
        radius = F.sqrt(F.lit(-2.0) * F.log(uniform(cluster, i, 1)))
        return radius * F.cos(F.lit(2 * math.pi) * uniform(cluster, i, 2))

    c = F.col("id").cast("int")
    return spark.range(0, k, 1, 1).select(
        c.alias("cluster"),
        F.transform(F.sequence(F.lit(1), F.lit(dim)), lambda i: normal(c, i)).alias("center"),
        F.lit(float(weight)).alias("weight"),
    )


def centers_from_vectors(
    vectors: DataFrame, k: int, weight: float = 0.0, features: str = "features", order_by: str = "movie_id"
) -> DataFrame:
    """The first K vectors by ``order_by`` as starting centres (a distributed top-K)."""
    top = vectors.orderBy(order_by).limit(k).select(order_by, features)
    w = Window.orderBy(order_by)  # K rows only
    return top.select(
        (F.row_number().over(w) - 1).cast("int").alias("cluster"),
        F.col(features).cast("array<double>").alias("center"),
        F.lit(float(weight)).alias("weight"),
    )


def model_arrays(state: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Centres and weights of a K-row model table, ordered by cluster."""
    rows = state.orderBy("cluster").collect()
    centers = np.array([r["center"] for r in rows], dtype=np.float64)
    weights = np.array([r["weight"] for r in rows], dtype=np.float64)
    return centers, weights


def check_dim(centers: np.ndarray, dim: int) -> None:
    if centers.ndim != 2 or centers.shape[1] != dim:
        raise ValueError(
            f"centre dimension {centers.shape[-1] if centers.ndim == 2 else '?'} "
            f"does not match the vector length {dim}"
        )


# --------------------------------------------------------------------------- assign


def vectors_of(features: pa.Array) -> np.ndarray | None:
    """An Arrow column of equally long arrays as a matrix with a row per element of the arrays; None if it is empty."""
    if isinstance(features, pa.ChunkedArray):
        features = features.combine_chunks()
    n = len(features)
    if n == 0:
        return None
    x = features.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return np.ascontiguousarray(x.reshape(n, -1).T)


def squared_distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Point x centre. The matrix ``x`` has a row per dimension: rows are added one after the other, so each
    distance is summed from the first element to the last, as the JVM form does. What is no number is infinite."""
    d = np.empty((x.shape[1], len(centers)))
    for j, c in enumerate(centers):
        diff = x - c[:, None]
        d[:, j] = np.add.reduce(diff * diff, axis=0)
    d[np.isnan(d)] = np.inf
    return d


def nearest_of(d: np.ndarray) -> np.ndarray:
    """Ties go to the lowest index."""
    return np.argmin(d, axis=1)


def _arrow_nearest(centers: np.ndarray):
    c = np.ascontiguousarray(centers, dtype=np.float64)

    def nearest(feats: pa.Array) -> pa.Array:
        x = vectors_of(feats)
        return pa.array([], pa.int32()) if x is None else pa.array(nearest_of(squared_distances(x, c)).astype(np.int32))

    return F.arrow_udf(nearest, "int")


def assign_clusters(
    df: DataFrame,
    centers,
    features: str = "features",
    out: str = "cluster",
    method: str = "arrow",
) -> DataFrame:
    """Nearest centre (squared Euclidean distance, ties to the lowest index).

    ``centers`` is the K x D model (K rows collected from the model table). Arrow
    batches are scored with numpy at every width. ``method="sql"`` is the same
    in built-in higher-order functions (no Python workers, several times slower).
    Both sum from the first element to the last, so exact ties agree; a distance
    that is no number counts as infinite, so a centre or point holding NaN never wins over a
    finite distance.
    """
    c = np.asarray(centers, dtype=np.float64)
    if method == "arrow":
        col: Column = _arrow_nearest(c)(F.col(features))
    elif method == "sql":
        col = nearest_center(features, c.tolist())
    else:
        raise ValueError("method must be 'arrow' or 'sql'")
    return df.withColumn(out, col.cast("int"))


# --------------------------------------------------------------------------- train


def _own_cluster(batch: pa.RecordBatch, x: np.ndarray) -> np.ndarray:
    return batch.column(batch.schema.get_field_index("cluster")).to_numpy(zero_copy_only=False)


def _nearest_cluster(centers):
    c = np.ascontiguousarray(centers, dtype=np.float64)
    return lambda batch, x: nearest_of(squared_distances(np.ascontiguousarray(x), c))


def cluster_stats(assigned: DataFrame, features: str = "features", weight_col: str | None = None) -> DataFrame:
    """Per-cluster point count ``n`` and element-wise vector sum ``total``.

    ``weight_col`` counts a row that many times (rows pre-aggregated per movie; whole numbers). Sums are exact and
    rounded once (:mod:`ratingstream.operators.exact_sum`), so they don't depend on the partitioning;
    each task sends a few numbers per cluster and element to the shuffle however hot a cluster is.
    """
    cols = [F.col("cluster").cast("int").alias("cluster"), F.col(features)] + ([F.col(weight_col)] if weight_col else [])
    return weighted_sums(assigned.select(*cols), _own_cluster, features, weight_col)


def nearest_stats(points: DataFrame, centers, features: str = "features", weight_col: str | None = None) -> DataFrame:
    """:func:`cluster_stats` of :func:`assign_clusters` in one pass: the vectors go to the workers once, and stay there."""
    return weighted_sums(points.select(F.col(features), *([F.col(weight_col)] if weight_col else [])), _nearest_cluster(centers), features, weight_col)


def model_sums(points: DataFrame, centers, weight_col: str, features: str = "features") -> tuple[np.ndarray, np.ndarray]:
    """The K counts and sums on the driver, where the model's update runs; of the rows' ``cluster`` if they have one."""
    k, dim = np.shape(centers)
    known = "cluster" in points.columns
    cols = [F.col(features), F.col(weight_col)] + ([F.col("cluster").cast("int").alias("cluster")] if known else [])
    return sums_on_driver(points.select(*cols), _own_cluster if known else _nearest_cluster(centers), features, weight_col, k, dim)


def update_centers(
    state: DataFrame, stats: DataFrame, decay: float = 1.0, time_unit: str = "batches"
) -> DataFrame:
    """Fold one batch's cluster sums into the model (no split; see :func:`train_step`).

    With discount ``a`` (``decay``, or ``decay ** points`` for unit "points"),
    weight ``w``, batch count ``m`` and sum ``s``:
    ``w' = a*w + m``; ``l = m / max(w', 1e-16)``; ``c' = (1-l)*c + (l/m)*s``.
    A cluster without points keeps its centre and only its weight decays.
    Both tables have K rows at most; the rule runs on the driver
    (:func:`update_arrays`), where a stream or fold needs the model anyway.
    """
    c, w = model_arrays(state)
    n, total = stats_arrays(stats.select("cluster", "n", "total").collect(), *c.shape)
    return state_frame(state.sparkSession, *update_arrays(c, w, n, total, decay, time_unit))


def decay_weights(state: DataFrame, decay: float) -> DataFrame:
    """Apply the forgetting factor alone (an empty batch)."""
    return state.withColumn("weight", F.col("weight") * F.lit(float(decay)))


def split_dying_cluster(state: DataFrame) -> DataFrame:
    """If the lightest cluster weighs under 1e-8 of the heaviest, split the heaviest.

    Both get weight ``(max+min)/2``; the heaviest centre ``x`` becomes ``x+p``
    and the lightest ``x-p`` with ``p = 1e-14*max(|x|,1)`` per element. Ties
    pick the lowest cluster index. At most one split per batch.
    """
    return state_frame(state.sparkSession, *split_arrays(*model_arrays(state)))


def train_step(state: DataFrame, stats: DataFrame, decay: float = 1.0, time_unit: str = "batches") -> DataFrame:
    """One model update: decay, mini-batch rule, dying-cluster split."""
    return split_dying_cluster(update_centers(state, stats, decay, time_unit))


def stats_arrays(stats_rows, k: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Per-cluster counts and sums from the K collected rows of :func:`cluster_stats`."""
    n = np.zeros(k)
    total = np.zeros((k, dim))
    for r in stats_rows:
        n[r["cluster"]] = r["n"]
        total[r["cluster"]] = r["total"]
    return n, total


def update_arrays(
    centers: np.ndarray,
    weights: np.ndarray,
    n: np.ndarray,
    total: np.ndarray,
    decay: float = 1.0,
    time_unit: str = "batches",
) -> tuple[np.ndarray, np.ndarray]:
    """The rule of :func:`update_centers` on the K x D model."""
    if time_unit not in ("batches", "points"):
        raise ValueError("time_unit must be 'batches' or 'points'")
    c = np.array(centers, dtype=np.float64, copy=True)
    disc = float(decay) ** float(n.sum()) if time_unit == "points" else float(decay)
    w = np.asarray(weights, dtype=np.float64) * disc
    for j in np.flatnonzero(n > 0):
        nw = w[j] + n[j]
        lam = n[j] / max(nw, WEIGHT_FLOOR)
        c[j] = (1.0 - lam) * c[j] + (lam / n[j]) * total[j]
        w[j] = nw
    return c, w


def split_arrays(centers: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rule of :func:`split_dying_cluster` on the K x D model."""
    c, w = np.array(centers, dtype=np.float64, copy=True), np.array(weights, dtype=np.float64, copy=True)
    big, small = int(np.argmax(w)), int(np.argmin(w))
    if w[small] < DYING_RATIO * w[big]:
        half = (w[big] + w[small]) / 2.0
        x = c[big].copy()
        p = SPLIT_EPS * np.maximum(np.abs(x), 1.0)
        c[big], c[small] = x + p, x + (-1.0) * p
        w[big] = w[small] = half
    return c, w


def train_step_arrays(
    centers: np.ndarray,
    weights: np.ndarray,
    n: np.ndarray,
    total: np.ndarray,
    decay: float = 1.0,
    time_unit: str = "batches",
) -> tuple[np.ndarray, np.ndarray]:
    """:func:`train_step` on the driver's copy of the K x D model; streams and folds use this form."""
    return split_arrays(*update_arrays(centers, weights, n, total, decay, time_unit))


def train_idle(
    centers: np.ndarray, weights: np.ndarray, intervals: int, decay: float = 1.0, time_unit: str = "batches"
) -> tuple[np.ndarray, np.ndarray]:
    """``intervals`` empty updates: each decays the weights (unit "batches") and may split."""
    k, d = np.shape(centers)
    for _ in range(int(intervals)):
        centers, weights = train_step_arrays(centers, weights, np.zeros(k), np.zeros((k, d)), decay, time_unit)
    return centers, weights


def latest_model(states: DataFrame) -> DataFrame:
    """Rows of the newest ``batch_id`` of a model table that keeps every batch."""
    last = states.agg(F.max("batch_id").alias("batch_id"))
    return states.join(F.broadcast(last), "batch_id", "left_semi")
