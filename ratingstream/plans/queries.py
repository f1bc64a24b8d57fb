"""Registered queries: one per operator of the inventory, over the given tables.

Every query reads the test tables (or data Spark derives from them, see
:mod:`ratingstream.sources.fixtures`) in full. Vector outputs are given in
long form ``(…, tag_id, value)`` and sums are rounded to 6 decimals, so an SQL
engine can check them value by value (:mod:`ratingstream.plans.oracle`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import drop_last_field, encode_int_key
from ..functions.vectors import format_vector, vector_sum
from ..operators import kmeans as km
from ..operators.features import label_points, project_features, sample_rows, scale_features
from ..operators.parse import (
    accepted,
    parse_rating,
    project_value,
    quarantined,
    reject_bad_lines,
    rekey_by_movie,
    stamp_time,
    user_parity_key,
)
from ..operators.publish import publish_ratings, publish_summary
from ..operators.reports import model_report, offset_ranges, prediction_report
from ..jobs import publish_stream, publisher_job, stream_progress
from ..options import KMeansOptions, PublishOptions, StreamOptions
from ..session import fresh_path
from ..sources import fixtures as fx
from ..sources.files import count_lines, scan_rating_lines, scan_tag_scores
from ..sources.topic_log import read_topic
from . import pipeline as pl

# Fixed query parameters: K centres, the starting centres are the first K
# movie vectors, prediction sample fraction, rounding of computed doubles,
# the decay case (factor 0.5 from weight 100) and the starved-centre case
# (last starting centre pushed 1000x away from the data).
K = 5
SAMPLE_FRACTION = 0.01
ROUND = 6
DECAY_CASE = (0.5, 100.0)
FAR_FACTOR = 1000.0
# Offsets per line of the prediction reports, the seed of random centres, and the width of the wide case.
REPORT_SPAN = 10_000
INIT_SEED = 42
WIDE = 1128
# Batches that the long partition of the capped topic is read in.
CAPPED_BATCHES = 4
# Files (and so steps) of the wave whose progress is followed.
PUBLISH_STEPS = 4

_CACHE: dict = {}


def _key(spark: SparkSession, sf_dir: str, name: str):
    # the application id changes with every SparkContext, so nothing cached for
    # a stopped session is ever handed to a new one
    sc = spark.sparkContext
    return (sc.applicationId, sc.startTime, sf_dir.rstrip("/"), name)


def events(spark, sf_dir) -> DataFrame:
    return fx.table(spark, sf_dir, "events")


def messages(spark, sf_dir) -> DataFrame:
    return fx.message_text(events(spark, sf_dir))


def parsed_messages(spark, sf_dir) -> DataFrame:
    """Rating messages as the consumer sees them: Kafka-shaped records → parsed."""
    recs = fx.kafka_records(events(spark, sf_dir))
    return parse_rating(
        recs.select(F.col("offset").alias("msg_id"), F.col("value").cast("string").alias("value"), "timestamp"),
        keep=["msg_id", "value", "timestamp"],
    )


def good_ratings(spark, sf_dir) -> DataFrame:
    return accepted(parsed_messages(spark, sf_dir))


def vector_table(spark: SparkSession, sf_dir: str) -> pl.VectorTable:
    """Static side: tag-score CSV → dense vectors → features; written once per session."""
    k = _key(spark, sf_dir, "vectors")
    if k not in _CACHE:
        dim = fx.embedding_dim(fx.table(spark, sf_dir, "embeddings"))
        scores = scan_tag_scores(spark, fx.tag_scores_csv(spark, sf_dir))
        _CACHE[k] = pl.materialize_vectors(spark, pl.movie_vectors(scores, dim), dim)
    return _CACHE[k]


def start_state(spark, sf_dir, weight: float = 0.0) -> DataFrame:
    return km.centers_from_vectors(vector_table(spark, sf_dir).df, K, weight)


def start_centers(spark, sf_dir):
    k = _key(spark, sf_dir, "centers")
    if k not in _CACHE:
        _CACHE[k] = km.model_arrays(start_state(spark, sf_dir))[0]
    return _CACHE[k]


def long_vectors(df: DataFrame, keys: list[str], arr: str, name: str, rnd: int | None = None) -> DataFrame:
    """``keys…, tag_id (1-based), name`` for every element of ``arr``."""
    ex = df.select(*keys, F.posexplode(arr).alias("_p", "_v"))
    v = F.round(F.col("_v"), rnd) if rnd is not None else F.col("_v")
    return ex.select(*keys, (F.col("_p") + 1).cast("int").alias("tag_id"), v.alias(name))


def state_long(state: DataFrame) -> DataFrame:
    s = state.select(
        F.col("cluster").cast("int").alias("cluster"), F.round("weight", ROUND).alias("weight"), "center"
    )
    return long_vectors(s, ["cluster", "weight"], "center", "center", ROUND)


def joined(spark, sf_dir) -> DataFrame:
    vt = vector_table(spark, sf_dir)
    r = good_ratings(spark, sf_dir).select("msg_id", "user_id", "movie_id", "rating")
    return pl.join_ratings_features(r, vt.df.select("movie_id", "scores", "features"), vt.n, vt.dim)


def _summary(df: DataFrame, arr: str = "features") -> list:
    return [
        F.size(arr).cast("int").alias("dim"),
        F.round(vector_sum(arr), ROUND).alias("f_sum"),
        F.array_min(arr).alias("f_min"),
        F.array_max(arr).alias("f_max"),
    ]


# --------------------------------------------------------------------------- sources


def q_scan_tag_scores(spark, sf_dir):
    return scan_tag_scores(spark, fx.tag_scores_csv(spark, sf_dir))


def q_scan_rating_lines(spark, sf_dir):
    return scan_rating_lines(spark, fx.rating_lines_text(spark, sf_dir))


def q_count_lines(spark, sf_dir):
    return count_lines(scan_rating_lines(spark, fx.rating_lines_text(spark, sf_dir)))


def q_project_value(spark, sf_dir):
    return project_value(fx.kafka_records(events(spark, sf_dir)))


def q_stream_offset_report(spark, sf_dir):
    return offset_ranges(fx.kafka_records(events(spark, sf_dir)))


# --------------------------------------------------------------------------- text ops


def q_parse_rating(spark, sf_dir):
    return good_ratings(spark, sf_dir).select("msg_id", "user_id", "movie_id", "rating")


def q_parse_rating_quarantine(spark, sf_dir):
    return quarantined(parsed_messages(spark, sf_dir)).select("msg_id", "value", "reject_reason")


def q_reject_bad_lines(spark, sf_dir):
    lines = fx.rating_file_lines(events(spark, sf_dir))
    return reject_bad_lines(lines).select("msg_id", "user_id", "rejected")


def q_drop_last_field(spark, sf_dir):
    lines = fx.rating_file_lines(events(spark, sf_dir))
    return lines.select("msg_id", drop_last_field("value").alias("value"))


def q_user_parity_key(spark, sf_dir):
    r = good_ratings(spark, sf_dir)
    return r.select("msg_id", "user_id", user_parity_key("user_id", fx.PARTITIONS).alias("key"))


def q_encode_key(spark, sf_dir):
    e = events(spark, sf_dir).select("event_id", F.col("user_id").cast("int").alias("user_id"))
    return e.select(
        F.col("event_id").alias("msg_id"),
        "user_id",
        F.hex(encode_int_key("user_id")).alias("user_hex"),
        F.hex(encode_int_key(user_parity_key("user_id", fx.PARTITIONS))).alias("key_hex"),
    )


def q_publish_ratings(spark, sf_dir):
    lines = scan_rating_lines(spark, fx.rating_lines_text(spark, sf_dir))
    out = publish_ratings(lines, topic=fx.TOPIC, partitions=fx.PARTITIONS)
    return out.select(F.hex("key").alias("key_hex"), "value", "topic", "partition")


def q_publish_waves(spark, sf_dir):
    """The rating file published twice as waves of its own and once more under the first wave's name, which adds nothing.

    Per partition: records, offsets (without gaps), and the least and largest digest of the values.
    """
    path, root = fx.rating_lines_text(spark, sf_dir), fresh_path(spark, "waves")
    opts = PublishOptions(topic=fx.TOPIC, partitions=fx.PARTITIONS)
    for wave in ("first", "second", "first"):
        publisher_job(spark, path, opts, sink="log", sink_path=root, wave=wave)
    digest = F.md5("value")
    return read_topic(spark, root).groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("offset").alias("n_offsets"), F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"), F.min(digest).alias("least"), F.max(digest).alias("largest"),
    )


def q_publish_progress(spark, sf_dir):
    """The rating file as several files, published step by step: whether progress only grew, and how it ended."""
    root = fresh_path(spark, "progress")
    lines = fx.rating_file_lines(events(spark, sf_dir))
    lines.select("value", F.pmod("msg_id", F.lit(PUBLISH_STEPS)).alias("part")).repartition(PUBLISH_STEPS, "part").write.partitionBy("part").text(f"{root}/in")
    publish_stream(
        spark, f"{root}/in/*", f"{root}/out", PublishOptions(topic=fx.TOPIC, partitions=fx.PARTITIONS), "log", True, files_per_step=1
    ).awaitTermination()
    p = stream_progress(spark, f"{root}/in/*", f"{root}/out")
    step = p.where("kind = 'progress'").withColumn("before", F.lag("n_read").over(Window.orderBy("step")))
    grew = step.agg(F.count(F.lit(1)).alias("n_steps"), F.coalesce(F.min(F.col("n_read") > F.col("before")), F.lit(True)).alias("monotone"))
    end = p.where("kind <> 'progress'").select("kind", "n_read", "n_rejected", "n_published", F.round("pct_published", ROUND).alias("pct_published"), "n_missing")
    return end.join(grew)  # one row each


def q_publish_summary(spark, sf_dir):
    lines = scan_rating_lines(spark, fx.rating_lines_text(spark, sf_dir))
    s = publish_summary(lines)
    return s.withColumn("pct_published", F.round("pct_published", ROUND))


def q_stamp_time(spark, sf_dir):
    """Every rating with whether it is stamped, and how many different stamps the query gave (one)."""
    stamped = stamp_time(good_ratings(spark, sf_dir).select("msg_id", "user_id", "movie_id", "rating"), "stamp")
    stamps = stamped.agg(F.countDistinct("stamp")).scalar()
    return stamped.withColumn("stamped", F.col("stamp").isNotNull()).withColumn("n_stamps", stamps).drop("stamp")


def q_rekey_by_movie(spark, sf_dir):
    return rekey_by_movie(good_ratings(spark, sf_dir))


# --------------------------------------------------------------------------- vectors


def q_assemble_tag_vectors(spark, sf_dir):
    vt = vector_table(spark, sf_dir)
    return long_vectors(vt.df, ["movie_id"], "scores", "score")


def q_assemble_tag_vectors_sparse(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    dim = fx.sparse_dim(li)
    v = pl.movie_vectors(fx.tag_scores_from_lineitem(li), dim)
    return long_vectors(v, ["movie_id"], "scores", "score")


def q_array_to_features(spark, sf_dir):
    vt = vector_table(spark, sf_dir)
    return long_vectors(vt.df, ["movie_id"], "features", "feature")


def q_join_ratings_features(spark, sf_dir):
    j = joined(spark, sf_dir)
    return j.select("msg_id", "user_id", "movie_id", "rating", *_summary(j))


def q_scale_features(spark, sf_dir):
    """Scores times rating through text, each element cast back to a float.

    The JVM's text of a float has other (equally short) digits than DuckDB's for a few
    products; both read back as the same float, so the comparison is exact.
    """
    j = scale_features(joined(spark, sf_dir).drop("features"), dst="scaled")
    j = j.withColumn("scaled", F.col("scaled").cast("array<float>").cast("array<double>"))
    return j.select("msg_id", "movie_id", "rating", *_summary(j, "scaled"))


def q_label_points(spark, sf_dir):
    lp = label_points(joined(spark, sf_dir))
    return lp.select("label", "msg_id", "movie_id", *_summary(lp))


def q_project_features(spark, sf_dir):
    f = project_features(joined(spark, sf_dir))
    return f.select(*_summary(f))


def q_sample_rows(spark, sf_dir):
    j = joined(spark, sf_dir).select("msg_id", "user_id", "movie_id")
    return sample_rows(j, SAMPLE_FRACTION, key_cols=["msg_id"])


# --------------------------------------------------------------------------- k-means


def q_init_centers(spark, sf_dir):
    vt = vector_table(spark, sf_dir)
    return state_long(km.init_centers(spark, K, vt.dim, 0.0, seed=INIT_SEED))


def q_assign_clusters(spark, sf_dir):
    vt = vector_table(spark, sf_dir)
    return pl.assign_ratings(good_ratings(spark, sf_dir), vt, start_centers(spark, sf_dir)).select(
        "msg_id", "user_id", "movie_id", "cluster"
    )


def q_cluster_sizes(spark, sf_dir):
    vt = vector_table(spark, sf_dir)
    counts = pl.movie_counts(good_ratings(spark, sf_dir))
    st = pl.batch_stats(counts, vt, start_centers(spark, sf_dir))
    return st.select("cluster", F.col("n").cast("long").alias("n"))


def q_cluster_stats(spark, sf_dir):
    vt = vector_table(spark, sf_dir)
    counts = pl.movie_counts(good_ratings(spark, sf_dir))
    st = pl.batch_stats(counts, vt, start_centers(spark, sf_dir))
    return long_vectors(st.withColumn("n", F.col("n").cast("long")), ["cluster", "n"], "total", "total", ROUND)


def q_cluster_stats_exact(spark, sf_dir):
    """The cluster sums to the last bit."""
    vt = vector_table(spark, sf_dir)
    st = pl.batch_stats(pl.movie_counts(good_ratings(spark, sf_dir)), vt, start_centers(spark, sf_dir))
    return long_vectors(st.withColumn("n", F.col("n").cast("long")), ["cluster", "n"], "total", "total")


def q_assign_clusters_wide(spark, sf_dir):
    """The assignment at the full vector width: each movie's features repeated up to it."""
    vt = vector_table(spark, sf_dir)
    wide = tile_vectors(vt.df.select("movie_id", "features"), WIDE)
    centers = km.model_arrays(km.centers_from_vectors(wide, K))[0]
    movies = good_ratings(spark, sf_dir).select("movie_id").distinct()
    return km.assign_clusters(wide.join(movies, "movie_id"), centers).select("movie_id", "cluster")


def tile_vectors(vectors: DataFrame, width: int) -> DataFrame:
    """``features`` repeated end to end and cut at ``width``."""
    times = F.ceil(F.lit(width) / F.size("features")).cast("int")
    return vectors.withColumn("features", F.slice(F.flatten(F.array_repeat("features", times)), 1, width))


def _batch_sums(spark, sf_dir, state0: DataFrame) -> DataFrame:
    vt = vector_table(spark, sf_dir)
    counts = pl.movie_counts(good_ratings(spark, sf_dir))
    return pl.batch_stats(counts, vt, km.model_arrays(state0)[0])


def _one_step(spark, sf_dir, state0: DataFrame, decay: float = 1.0) -> DataFrame:
    return km.train_step(state0, _batch_sums(spark, sf_dir, state0), decay)


def q_update_centers(spark, sf_dir):
    s0 = start_state(spark, sf_dir)
    return state_long(km.update_centers(s0, _batch_sums(spark, sf_dir, s0)))


def q_update_centers_decay(spark, sf_dir):
    decay, w0 = DECAY_CASE
    s0 = start_state(spark, sf_dir, w0)
    return state_long(km.update_centers(s0, _batch_sums(spark, sf_dir, s0), decay))


def q_decay_weights(spark, sf_dir):
    decay, w0 = DECAY_CASE
    return state_long(km.decay_weights(start_state(spark, sf_dir, w0), decay))


def q_assemble_tag_vectors_nonfinite(spark, sf_dir):
    """Scores that are NaN or infinite are left out; the same movies' other scores stay."""
    li = fx.table(spark, sf_dir, "lineitem")
    s = fx.tag_scores_from_lineitem(li)
    r = F.col("relevance")
    odd = F.when(r == F.lit(0.05).cast("float"), F.lit(float("nan"))).when(r == F.lit(0.06).cast("float"), F.lit(float("inf")))
    s = s.withColumn("relevance", F.coalesce(odd.cast("float"), r))
    return long_vectors(pl.movie_vectors(s, fx.sparse_dim(li)), ["movie_id"], "scores", "score")


def q_fold_signed_batches(spark, sf_dir):
    """The daily fold with batch ids on both sides of zero; every batch is trained on."""
    vt = vector_table(spark, sf_dir)
    daily = _daily_ratings(spark, sf_dir)
    middle = daily.agg(F.min("day") + F.floor((F.max("day") - F.min("day")) / 2)).first()[0]
    states = pl.fold_batches(
        spark, daily.withColumn("day", F.col("day") - middle), "day", vt, start_state(spark, sf_dir), KMeansOptions(k=K, dim=vt.dim)
    )
    return state_long(km.latest_model(states).drop("batch_id"))


def q_split_dying_cluster(spark, sf_dir):
    s0 = start_state(spark, sf_dir).withColumn(
        "center",
        F.when(F.col("cluster") == K - 1, F.transform("center", lambda x: x * F.lit(FAR_FACTOR))).otherwise(
            F.col("center")
        ),
    )
    return state_long(km.split_dying_cluster(km.update_centers(s0, _batch_sums(spark, sf_dir, s0))))


def _daily_ratings(spark, sf_dir) -> DataFrame:
    return good_ratings(spark, sf_dir).withColumn("day", fx.epoch_day("timestamp"))


def q_latest_model(spark, sf_dir):
    vt = vector_table(spark, sf_dir)
    run = pl.run_fold(
        spark, _daily_ratings(spark, sf_dir), "day", vt, start_state(spark, sf_dir), KMeansOptions(k=K, dim=vt.dim)
    )
    return state_long(run.log.latest_model())


def q_assign_clusters_incremental(spark, sf_dir):
    """Every movie's cluster after the daily fold, kept up to date by distance bounds over all of its batches."""
    vt = vector_table(spark, sf_dir)
    run = pl.run_fold(
        spark, _daily_ratings(spark, sf_dir), "day", vt, start_state(spark, sf_dir), KMeansOptions(k=K, dim=vt.dim),
        StreamOptions(assign_method="incremental"),
    )
    return run.assignment.at(km.model_arrays(run.log.latest_model())[0])


def q_model_report(spark, sf_dir):
    """The report of the model after one step, centres rounded so an SQL engine can match the text."""
    st = _one_step(spark, sf_dir, start_state(spark, sf_dir))
    st = st.withColumn("center", F.transform("center", lambda x: F.round(x, ROUND)))
    return model_report(st).drop("reported_at")


def q_format_center(spark, sf_dir):
    return start_state(spark, sf_dir).select("cluster", format_vector("center").alias("center_text"))


def q_prediction_report(spark, sf_dir):
    vt = vector_table(spark, sf_dir)
    sampled = sample_rows(good_ratings(spark, sf_dir), SAMPLE_FRACTION, key_cols=["msg_id"])
    preds = pl.assign_ratings(sampled, vt, start_centers(spark, sf_dir))
    return prediction_report(preds, order_col="msg_id", span=REPORT_SPAN).drop("reported_at")


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from ..streaming import queries as sq

    q = {
        "scan_tag_scores": q_scan_tag_scores,
        "scan_rating_lines": q_scan_rating_lines,
        "count_lines": q_count_lines,
        "project_value": q_project_value,
        "stream_offset_report": q_stream_offset_report,
        "parse_rating": q_parse_rating,
        "parse_rating_quarantine": q_parse_rating_quarantine,
        "reject_bad_lines": q_reject_bad_lines,
        "drop_last_field": q_drop_last_field,
        "user_parity_key": q_user_parity_key,
        "encode_key": q_encode_key,
        "publish_ratings": q_publish_ratings,
        "publish_summary": q_publish_summary,
        "publish_waves": q_publish_waves,
        "publish_progress": q_publish_progress,
        "cluster_stats_exact": q_cluster_stats_exact,
        "stamp_time": q_stamp_time,
        "rekey_by_movie": q_rekey_by_movie,
        "assemble_tag_vectors": q_assemble_tag_vectors,
        "assemble_tag_vectors_sparse": q_assemble_tag_vectors_sparse,
        "array_to_features": q_array_to_features,
        "join_ratings_features": q_join_ratings_features,
        "scale_features": q_scale_features,
        "label_points": q_label_points,
        "project_features": q_project_features,
        "sample_rows": q_sample_rows,
        "init_centers": q_init_centers,
        "assign_clusters": q_assign_clusters,
        "cluster_sizes": q_cluster_sizes,
        "cluster_stats": q_cluster_stats,
        "assign_clusters_wide": q_assign_clusters_wide,
        "assemble_tag_vectors_nonfinite": q_assemble_tag_vectors_nonfinite,
        "fold_signed_batches": q_fold_signed_batches,
        "update_centers": q_update_centers,
        "update_centers_decay": q_update_centers_decay,
        "decay_weights": q_decay_weights,
        "split_dying_cluster": q_split_dying_cluster,
        "latest_model": q_latest_model,
        "assign_clusters_incremental": q_assign_clusters_incremental,
        "model_report": q_model_report,
        "format_center": q_format_center,
        "prediction_report": q_prediction_report,
    }
    q.update(sq.registry())
    return q


__all__ = ["registry"]
