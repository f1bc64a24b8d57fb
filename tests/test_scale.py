"""Hot keys, signed batch ids, lost checkpoints and the options of the source."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingstream import jobs
from ratingstream.operators import kmeans as km
from ratingstream.operators.features import assemble_tag_vectors, join_ratings_features, tag_score_rejects, vector_bytes
from ratingstream.options import KafkaOptions, KMeansOptions, StreamOptions
from ratingstream.plans import model_table as mt
from ratingstream.streaming.job import run_log
from ratingstream.plans import pipeline as pl
from ratingstream.session import fresh_path
from ratingstream.sources.kafka import kafka_reader_options, stream_ratings
from ratingstream.streaming.job import run_stream

DIM = 4


@pytest.fixture
def vt(spark):
    rows = [(m, t, float(m + t)) for m in range(12) for t in range(1, DIM + 1)]
    scores = spark.createDataFrame(rows, "movie_id int, tag_id int, relevance float")
    return pl.materialize_vectors(spark, pl.movie_vectors(scores, DIM), DIM)


def ratings(spark, n=2000, hot=0.5):
    rows = [(i, 3 if i % 100 < 100 * hot else i % 14, float(i % 5)) for i in range(n)]
    return spark.createDataFrame(rows, "user_id int, movie_id int, rating float")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_movie_is_split_beyond_the_broadcast_limit(spark, vt):
    r = ratings(spark)
    side = vt.df.select("movie_id", "scores", "features")
    want = join_ratings_features(r, side).count()
    split = join_ratings_features(r, side, vt.n, DIM, broadcast_limit_bytes=0, hot_rows=100)
    assert split.columns == r.join(side, "movie_id").columns and split.count() == want
    assert "_salt" in plan(split) and "hashpartitioning(movie_id" in plan(split)
    # the rows of the hot movie lie in several partitions
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        split = join_ratings_features(r, side, vt.n, DIM, broadcast_limit_bytes=0, hot_rows=100)
        parts = split.where("movie_id = 3").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(parts) > 2


@pytest.mark.parametrize("scale", [False, True])
def test_hot_movie_assignment_is_the_same_split_or_broadcast(spark, vt, scale):
    centers = km.model_arrays(km.centers_from_vectors(vt.df, 3))[0]
    r = ratings(spark)
    a = pl.assign_ratings(r, vt, centers, scale_by_rating=scale)
    b = pl.assign_ratings(r, vt, centers, broadcast_limit_bytes=0, scale_by_rating=scale, hot_rows=50)
    assert sorted(map(tuple, a.select("user_id", "cluster").collect())) == sorted(map(tuple, b.select("user_id", "cluster").collect()))


def test_size_check_counts_every_array_column(vt):
    both = vector_bytes(DIM, vt.df.dtypes)
    assert both - vector_bytes(DIM, [("features", "array<double>")]) == 4 * DIM
    assert vector_bytes(DIM) == vector_bytes(DIM, [("features", "array<double>")])


def test_only_the_column_in_use_is_cached_and_stays_in_place(spark, vt):
    centers = km.model_arrays(km.centers_from_vectors(vt.df, 3))[0]
    pl.batch_stats(pl.movie_counts(ratings(spark)), vt, centers).collect()
    assert list(vt.held) == ["features"]
    joined = pl.batch_points(pl.movie_counts(ratings(spark)), vt)
    text = plan(joined)
    assert "InMemoryTableScan" in text and "scores" not in text


def test_fold_trains_on_negative_batch_ids(spark, vt):
    r = ratings(spark, 1000).withColumn("b", F.col("user_id") % 5 - 3)
    state0 = km.centers_from_vectors(vt.df, 3)
    out = fresh_path(spark, "signed")
    states = pl.fold_batches(spark, r, "b", vt, state0, KMeansOptions(k=3, dim=DIM), out_dir=out)
    assert sorted(x.batch_id for x in states.select("batch_id").distinct().collect()) == [-3, -2, -1, 0, 1]
    weight = km.model_arrays(km.latest_model(states).drop("batch_id"))[1].sum()
    assert weight == r.join(vt.df.select("movie_id"), "movie_id").count()
    # the same ratings with later ids give the same model
    later = pl.fold_batches(spark, r.withColumn("b", F.col("b") + 100), "b", vt, state0, KMeansOptions(k=3, dim=DIM))
    for x, y in zip(*(km.model_arrays(km.latest_model(s).drop("batch_id")) for s in (states, later))):
        np.testing.assert_allclose(x, y, rtol=1e-12)  # up to the order of the sums
    files = spark.read.parquet(f"{out}/counts").where("batch_id = 0").inputFiles()
    assert len(files) > 1


def test_fold_refuses_ratings_without_a_batch_and_new_early_batches(spark, vt):
    state0 = km.centers_from_vectors(vt.df, 3)
    opts = KMeansOptions(k=3, dim=DIM)
    with pytest.raises(ValueError, match="have no b"):
        pl.fold_batches(spark, ratings(spark, 50).withColumn("b", F.when(F.col("user_id") > 9, 1)), "b", vt, state0, opts)
    out = fresh_path(spark, "early")
    mt.write_batch(state0, f"{out}/state", 7)
    with pytest.raises(ValueError, match="earlier batch"):
        pl.fold_batches(spark, ratings(spark, 50).withColumn("b", F.lit(3)), "b", vt, state0, opts, out_dir=out)


def test_a_lost_checkpoint_trains_on_every_new_rating(spark, vt):
    root = fresh_path(spark, "lost")
    state0 = km.centers_from_vectors(vt.df, 3)

    def run(inbox, checkpoint):
        source = stream_ratings(spark, "parquet", inbox)
        q, paths = run_stream(
            spark, source, vt, state0, out_dir=f"{root}/out", kmeans=KMeansOptions(k=3, dim=DIM), available_now=True, checkpoint=checkpoint
        )
        q.awaitTermination()
        assert q.exception() is None
        last = run_log(spark, paths).last
        return last, km.model_arrays(mt.read_batch(spark, paths.state, last))[1].sum()

    def publish(name, n):
        value = F.concat_ws(",", F.col("id"), F.col("id") % 12, F.lit("1.0")).cast("binary")
        df = spark.range(n).select(
            F.lit(None).cast("binary").alias("key"), value.alias("value"), F.lit("t").alias("topic"), F.lit(0).alias("partition"),
            F.col("id").alias("offset"), F.current_timestamp().alias("timestamp"),
        )
        df.write.parquet(f"{root}/{name}")
        return f"{root}/{name}"

    first = publish("a", 1000)
    assert run(first, f"{root}/c1") == (0, 1000)
    assert run(first, f"{root}/c1") == (0, 1000)  # nothing new: nothing is trained twice
    assert run(publish("b", 500), f"{root}/c2") == (1, 1500)  # a new checkpoint counts on from the last commit
    assert run(f"{root}/b", f"{root}/c2") == (1, 1500)


def test_non_finite_scores_are_set_aside(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, 0.5), (1, 2, nan), (1, 3, -inf), (2, 1, inf), (2, 2, 0.25), (3, 1, None)]
    df = spark.createDataFrame(rows, "movie_id int, tag_id int, relevance float")
    got = {r.movie_id: list(r.scores) for r in assemble_tag_vectors(df, 3).collect()}
    assert got == {1: [0.5, 0.0, 0.0], 2: [0.0, 0.25, 0.0]}
    assert tag_score_rejects(df, 3).count() == 4
    with pytest.raises(Exception, match="not finite"):
        assemble_tag_vectors(df, 3, on_error="fail").collect()


def test_non_finite_ratings_do_not_reach_a_scaled_model(spark, vt):
    r = ratings(spark, 300).withColumn("rating", F.when(F.col("user_id") == 7, F.lit(float("nan"))).otherwise(F.col("rating")))
    r = r.withColumn("b", F.col("user_id") % 2)
    states = pl.fold_batches(
        spark, r, "b", vt, km.centers_from_vectors(vt.df, 3), KMeansOptions(k=3, dim=DIM), StreamOptions(scale_by_rating=True)
    )
    c, _ = km.model_arrays(km.latest_model(states).drop("batch_id"))
    assert np.isfinite(c).all()


def test_source_options():
    assert kafka_reader_options(KafkaOptions())["failOnDataLoss"] == "true"
    assert kafka_reader_options(KafkaOptions(fail_on_data_loss=False))["failOnDataLoss"] == "false"


def test_capped_kafka_source_needs_the_partition_count(spark):
    with pytest.raises(ValueError, match="source_partitions"):
        jobs.clusterer_job(spark, "nowhere", "nowhere")


def test_command_line(monkeypatch):
    seen = {}

    class Session:
        class builder:
            appName = staticmethod(lambda name: Session.builder)
            getOrCreate = staticmethod(lambda: None)

    monkeypatch.setattr(jobs, "SparkSession", Session)
    monkeypatch.setattr(jobs, "clusterer_job", lambda *a, **k: seen.update(args=a, **k))
    jobs.main(
        ["clusterer", "--tag-scores", "t", "--out", "o", "--rate", "0", "--seed", "9", "--on-tag-error", "fail", "--source-partitions", "200", "--allow-data-loss"]
    )
    _, _, _, kmeans, stream, kafka = seen["args"]
    assert (kmeans.seed, stream.max_records_per_s_per_partition, kafka.fail_on_data_loss) == (9, 0, False)
    assert (seen["source_partitions"], seen["on_tag_error"]) == (200, "fail")


def test_offsets_of_published_waves_go_on(spark, tmp_path):
    lines = tmp_path / "ratings.csv"
    lines.write_text("1,2,3.0,4\n5,6,1.0,8\n")
    sink = fresh_path(spark, "waves")
    for _ in range(2):
        jobs.publisher_job(spark, str(lines), sink="parquet", sink_path=sink)
    offsets = [r.offset for r in spark.read.parquet(sink).select("offset").collect()]
    assert len(offsets) == len(set(offsets)) == 4
