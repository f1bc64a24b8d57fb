"""Composed plans: static movie vectors, one scored batch, and a fold over batches.

The one real rewrite of the reference's flow lives here: **aggregate below the
join**. Unscaled features depend on the movie only, so a batch of ratings is
first counted per movie (partial + final aggregate, which also absorbs a hot
movie), the counts are joined to the vectors, each movie is assigned once, and
the cluster sums are weighted by the counts. The 1128-wide work is then per
distinct movie instead of per rating, and the join never sees duplicates.
With ``scale_by_rating`` the features depend on the rating too, so the key is
``(movie_id, rating)``.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.bounds import BOUNDS, advance, scored_bounds
from ..operators.features import (
    array_to_features,
    assemble_tag_vectors,
    join_ratings_features,
    salted_join,
    scale_features,
)
from ..operators.kmeans import (
    assign_clusters,
    check_dim,
    cluster_stats,
    model_arrays,
    model_sums,
    nearest_stats,
    state_frame,
    train_step_arrays,
)
from ..options import KMeansOptions, StreamOptions
from ..session import fresh_path, is_complete, remove_folder
from . import model_table as mt
from .model_log import ModelLog

# Writers that a batch's counts are dealt to in a fold.
_FOLD_WRITERS = 16

# Bytes per row of a (movie_id, cluster) table, for the broadcast size check.
_ASSIGN_ROW_BYTES = 32


@dataclass
class VectorTable:
    """Movie vectors plus the facts the join needs to pick its strategy."""

    df: DataFrame  # movie_id, scores (array<float>), features (array<double>)
    n: int
    dim: int
    partitions: int = 8
    held: dict = field(default_factory=dict)
    bucketed: bool = False  # on disk already partitioned on ``movie_id``
    version: str | None = None

    def side(self, column: str) -> DataFrame:
        """``movie_id`` and one array column, hash-partitioned on ``movie_id`` and cached on first use."""
        if column not in self.held:
            narrow = self.df.select("movie_id", column)
            if not self.bucketed:
                self.held[column] = narrow.repartition(self.partitions, "movie_id").persist()
                return self.held[column]
            # the cache keeps the buckets' partitioning, where a scan on its own would drop it
            conf = narrow.sparkSession.conf
            names = ("spark.sql.sources.bucketing.autoBucketedScan.enabled", "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning")
            before = {n: conf.get(n) for n in names}
            try:
                for n in names:
                    conf.set(n, "false")
                self.held[column] = narrow.persist()
            finally:
                for n in names:
                    conf.set(n, before[n])
        return self.held[column]

    def unpersist(self) -> None:
        for df in self.held.values():
            df.unpersist()
        self.held.clear()


def movie_vectors(scores: DataFrame, dim: int, on_error: str = "quarantine") -> DataFrame:
    """``movie_id, scores ARRAY<FLOAT>, features ARRAY<DOUBLE>`` (features through text)."""
    return array_to_features(assemble_tag_vectors(scores, dim, on_error))


def materialize_vectors(
    spark: SparkSession, vectors: DataFrame, dim: int, path: str | None = None, partitions: int | None = None
) -> VectorTable:
    """Write the static side once to the shared folder and read it back.

    The written table cuts the lineage (a lost executor re-reads it instead of
    re-running the pivot) and its row count sizes the join strategy. It is bucketed and sorted by
    ``movie_id`` (:mod:`ratingstream.plans.vector_store`), in buckets by its size unless ``partitions`` are
    given: joins find it partitioned, also in a later session. Given the ``path`` of an earlier run, the table found there is used as it is; a
    table from before bucketing is dealt out when it is cached. The array
    column that a mode uses is cached on first use (``VectorTable.side``), so a join moves only
    the (small) batch side.
    """
    from .vector_store import bucket_count, open_bucketed, write_bucketed

    path = path or fresh_path(spark, "vectors")
    found = open_bucketed(spark, path)
    if found is None and not is_complete(spark, path):  # a restarted job keeps the vectors its model was built on
        write_bucketed(spark, vectors, path, dim, partitions)
        found = open_bucketed(spark, path)
    df, n_parts = found or (spark.read.parquet(path), partitions)
    facts = df.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.size("features")).alias("lo"), F.max(F.size("features")).alias("hi")
    ).first()
    if facts["n"] and (facts["lo"] != dim or facts["hi"] != dim):
        raise ValueError(f"vector length {facts['lo']}..{facts['hi']} differs from dim {dim}")
    n_parts = n_parts or bucket_count(spark, int(facts["n"]), dim)
    return VectorTable(df=df, n=int(facts["n"]), dim=dim, partitions=n_parts, bucketed=found is not None)


def movie_counts(ratings: DataFrame, scale_by_rating: bool = False) -> DataFrame:
    keys = ["movie_id", "rating"] if scale_by_rating else ["movie_id"]
    return ratings.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def batch_points(
    counts: DataFrame,
    vt: VectorTable,
    scale_by_rating: bool = False,
) -> DataFrame:
    """Per-movie (or per movie and rating) counts joined to their feature vectors.

    The vectors stay where they are cached (hash-partitioned on ``movie_id``):
    the per-batch counts are the small side, so Spark either broadcasts them
    (its size check, or AQE at run time) or shuffles only them to the
    vectors' partitioning. The static side is never re-broadcast per batch.
    """
    joined = counts.join(vt.side("scores" if scale_by_rating else "features"), "movie_id", "inner")
    if scale_by_rating:
        joined = scale_features(joined, by="rating", src="scores", dst="features").drop("scores")
    return joined


class IncrementalAssignment:
    """The cluster of every movie under the current centres, kept with distance bounds.

    Moving the centres rewrites the bounds (a few numbers per movie, under the shared folder) and reads only
    those vectors whose bounds cross. ``n`` and ``rescored`` count the movies of the last move and those scored.
    The table of the version before stays for readers; older ones are removed.
    """

    def __init__(self, spark: SparkSession, vt: VectorTable, centers, root: str | None = None):
        self.spark, self.vt, self.root = spark, vt, root or fresh_path(spark, "bounds")
        self.version = 0
        self._keep(scored_bounds(vt.side("features"), centers).withColumn("rescored", F.lit(True)), centers)

    def _path(self, version: int) -> str:
        return f"{self.root}/version={version}"

    def _keep(self, bounds: DataFrame, centers) -> None:
        seen = Observation()
        bounds = bounds.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if("rescored").alias("rescored"))
        bounds.drop("rescored").write.mode("overwrite").parquet(self._path(self.version))
        self.n, self.rescored = int(seen.get["n"]), int(seen.get["rescored"])
        self.centers = np.array(centers, dtype=np.float64, copy=True)

    def _bounds(self) -> DataFrame:
        return self.spark.read.schema("movie_id int, " + BOUNDS).parquet(self._path(self.version))

    def at(self, centers) -> DataFrame:
        """``movie_id, cluster`` under these centres."""
        if not np.array_equal(self.centers, centers):
            bounds = self._bounds()
            self.version += 1
            self._keep(advance(bounds, self.vt.side("features"), self.centers, centers), centers)
            remove_folder(self.spark, self._path(self.version - 2))
        return self._bounds().select("movie_id", "cluster")


def batch_stats(
    counts: DataFrame,
    vt: VectorTable,
    centers,
    scale_by_rating: bool = False,
    method: str = "arrow",
    clusters: DataFrame | None = None,
) -> DataFrame:
    """K rows of ``cluster, n, total`` for one batch of rating counts; ``clusters`` are the movies' if they are known."""
    if clusters is not None:
        return cluster_stats(batch_points(counts.join(clusters, "movie_id"), vt), weight_col="n")
    pts = batch_points(counts, vt, scale_by_rating)
    if method == "arrow":
        return nearest_stats(pts, centers, weight_col="n")
    return cluster_stats(assign_clusters(pts, centers, method=method), weight_col="n")


def batch_sums(
    counts: DataFrame, vt: VectorTable, centers, scale_by_rating: bool = False, method: str = "arrow", clusters: DataFrame | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """:func:`batch_stats` as arrays on the driver, for the model's update there (K x D numbers)."""
    if clusters is not None:
        return model_sums(batch_points(counts.join(clusters, "movie_id"), vt), centers, "n")
    pts = batch_points(counts, vt, scale_by_rating)
    return model_sums(pts if method == "arrow" else assign_clusters(pts, centers, method=method), centers, "n")


def assign_ratings(
    ratings: DataFrame,
    vt: VectorTable,
    centers,
    method: str = "arrow",
    broadcast_limit_bytes: int = StreamOptions.broadcast_limit_bytes,
    per_movie: bool = True,
    scale_by_rating: bool = False,
    hot_rows: int = StreamOptions.hot_movie_rows,
    clusters: DataFrame | None = None,
) -> DataFrame:
    """Every rating with the cluster of its movie (ratings without a vector drop out); ``clusters`` are the movies' if known.

    With ``per_movie`` each vector is scored once; the ``movie_id → cluster``
    table has one row per vector, so its size is known before the join and
    decides the broadcast. Beyond the limit hot movies are split. Without
    it each row is scored where it is (no shuffle). With ``scale_by_rating``
    the features are the scores times the rating, so each distinct
    ``(movie_id, rating)`` is scored once and Spark sizes the join back.
    """
    if scale_by_rating:
        keys = ratings.select("movie_id", "rating").distinct()
        pts = batch_points(keys.withColumn("n", F.lit(1)), vt, True)
        clusters = assign_clusters(pts, centers, method=method).select("movie_id", "rating", "cluster")
        return salted_join(ratings, clusters, ["movie_id", "rating"], hot_rows)
    if not per_movie:
        pts = join_ratings_features(ratings, vt.side("features"), vt.n, vt.dim, broadcast_limit_bytes, hot_rows)
        return assign_clusters(pts, centers, method=method).drop("features")
    # every vector is scored where it is cached: the ratings are read once, for the join
    if clusters is None:
        clusters = assign_clusters(vt.side("features"), centers, method=method).select("movie_id", "cluster")
    if vt.n * _ASSIGN_ROW_BYTES <= broadcast_limit_bytes:
        return ratings.join(F.broadcast(clusters), "movie_id", "inner")
    return salted_join(ratings, clusters, ["movie_id"], hot_rows)


def incremental_assignment(spark: SparkSession, vt: VectorTable, centers, opts: StreamOptions) -> IncrementalAssignment | None:
    """The movies' kept clusters if the options ask for them. Features that depend on the rating have no cluster per movie."""
    if opts.assign_method != "incremental":
        return None
    if opts.scale_by_rating:
        raise ValueError("incremental assignment needs features that don't depend on the rating")
    return IncrementalAssignment(spark, vt, centers)


def finite_ratings(ratings: DataFrame) -> DataFrame:
    """Ratings that are finite numbers: the others can't scale a vector."""
    return ratings.where(~F.isnan("rating") & (F.abs("rating") < float("inf")))


def fold_batches(
    spark: SparkSession,
    ratings: DataFrame,
    batch_col: str,
    vt: VectorTable,
    state0: DataFrame,
    kmeans: KMeansOptions = KMeansOptions(),
    stream: StreamOptions = StreamOptions(),
    out_dir: str | None = None,
) -> DataFrame:
    """Train batch after batch, in ``batch_col`` order; returns every state with ``batch_id`` (see :func:`run_fold`)."""
    return run_fold(spark, ratings, batch_col, vt, state0, kmeans, stream, out_dir).log.read("state")


@dataclass
class FoldRun:
    """A finished fold: the log of its states and, with incremental assignment, the movies' clusters and what each batch scored again."""

    log: ModelLog
    assignment: IncrementalAssignment | None = None
    rescored: list[tuple[int, int, int]] = field(default_factory=list)  # batch, movies, movies scored again


def run_fold(
    spark: SparkSession,
    ratings: DataFrame,
    batch_col: str,
    vt: VectorTable,
    state0: DataFrame,
    kmeans: KMeansOptions = KMeansOptions(),
    stream: StreamOptions = StreamOptions(),
    out_dir: str | None = None,
) -> FoldRun:
    """Train batch after batch, in ``batch_col`` order; the states are in the returned run's log.

    Batch ids are integers of any sign. With ``scale_by_rating`` ratings that are NaN or
    infinite are left out.

    All batches are counted per movie in one pass first (a single shuffle of
    the ratings), written to the shared folder partitioned by batch; each
    step then reads only its own small partition. Each state is written as a
    K-row table under ``out_dir/state/batch_id=N`` and committed to the log, which merges
    old states as it grows. Given the ``out_dir`` of an
    interrupted run, the fold goes on after the last complete state instead
    of starting again.
    """
    out_dir = out_dir or fresh_path(spark, "fold")
    keys = [batch_col, "movie_id"] + (["rating"] if stream.scale_by_rating else [])
    counts_path = f"{out_dir}/counts"
    if not is_complete(spark, counts_path):
        if stream.scale_by_rating:
            ratings = finite_ratings(ratings)
        (
            ratings.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumnRenamed(batch_col, "batch_id")
            # several writers per batch: with the rating in the key a batch's counts have
            # no bound by the catalogue
            .repartition(vt.partitions, "batch_id", F.pmod(F.hash("movie_id"), F.lit(_FOLD_WRITERS)))
            .write.mode("overwrite")
            .partitionBy("batch_id")
            .parquet(counts_path)
        )
    counts_all = spark.read.parquet(counts_path)
    batch_ids = sorted((r[0] for r in counts_all.select("batch_id").distinct().collect()), key=lambda b: (b is None, b))
    if None in batch_ids:
        raise ValueError(f"some ratings have no {batch_col}: a fold needs the batch of every rating")

    state_path = f"{out_dir}/state"
    log = ModelLog(spark, out_dir, legacy=state_path, fanout=stream.compact_every)
    if not log.begins(batch_ids):
        raise ValueError("the states under out_dir aren't those of the first batches: an earlier batch is new")
    if not mt.has_batch(spark, state_path, mt.SEED):
        centers, weights = model_arrays(state0)
        mt.write_batch(state_frame(spark, centers, weights), state_path, mt.SEED)
    centers, weights = model_arrays(log.latest_model())
    check_dim(centers, vt.dim)

    run = FoldRun(log, incremental_assignment(spark, vt, centers, stream))

    def keep(state: DataFrame, b: int) -> None:
        mt.write_batch(state, state_path, b)
        log.commit(b)
        log.compact()

    # a state is written by one background thread, in batch order, while the
    # next step's cluster sums are computed
    writes = []
    with ThreadPoolExecutor(max_workers=1) as writer:
        for b in batch_ids[log.manifest.n :]:
            counts = counts_all.where(F.col("batch_id") == F.lit(b)).drop("batch_id")
            clusters = None
            if run.assignment:
                clusters = run.assignment.at(centers)
                run.rescored.append((b, run.assignment.n, run.assignment.rescored))
            # the K cluster sums come back to the driver: the update of the K x D
            # model runs there, and the new model seeds the next step's scoring
            n, total = batch_sums(counts, vt, centers, stream.scale_by_rating, stream.assign_method, clusters)
            centers, weights = train_step_arrays(centers, weights, n, total, kmeans.decay, kmeans.time_unit)
            if writes:
                writes[-1].result()  # the previous state is in place before this one is queued
            writes.append(writer.submit(keep, state_frame(spark, centers, weights), b))
    for w in writes:
        w.result()
    if run.assignment:
        run.assignment.at(centers)
    return run
