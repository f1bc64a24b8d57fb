import os
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from ratingstream.operators import kmeans as km
from ratingstream.options import KMeansOptions, StreamOptions
from ratingstream.plans import pipeline as pl
from ratingstream.plans import vector_store as vs
from ratingstream.session import fresh_path, list_names
from ratingstream.streaming import job

DIM = 4


def vectors(spark, n=200, add=0.0):
    return spark.range(n).select(
        F.col("id").cast("int").alias("movie_id"),
        F.array(*[(F.col("id") % (i + 2) + add).cast("float") for i in range(DIM)]).alias("scores"),
        F.array(*[(F.col("id") % (i + 2) + add).cast("double") for i in range(DIM)]).alias("features"),
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges_over_vectors(text):
    """Whether any exchange lies above the scan of the vectors (deeper lines belong to the operators above them)."""
    lines = text.splitlines()
    depth = lambda s: len(re.match(r"[ :]*(?:\+- )?", s.replace(":- ", "+- ", 1)).group())
    bad = False
    for i, line in enumerate(lines):
        if ("InMemoryTableScan" in line or "FileScan" in line) and "features" in line:
            d = depth(line)
            for above in reversed(lines[:i]):
                if depth(above) < d:
                    d = depth(above)
                    bad |= "Exchange" in above
    return bad


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("cached", [True, False])
def test_joins_do_not_move_the_vectors(spark, no_broadcast, cached):
    path = fresh_path(spark, "t_vec")
    pl.materialize_vectors(spark, vectors(spark), DIM, path)
    vt = pl.materialize_vectors(spark, None, DIM, path)  # as a restarted job finds it
    counts = spark.range(0, 200, 3).select(F.col("id").cast("int").alias("movie_id"), F.lit(2).alias("n"))
    side = vt.side("features") if cached else vt.df.select("movie_id", "features")
    joined = counts.join(side, "movie_id")
    assert "SortMergeJoin" in plan(joined) and not exchanges_over_vectors(plan(joined))
    assert joined.count() == 67
    vt.unpersist()


def test_buckets_follow_the_size_of_the_vectors(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        vt = pl.materialize_vectors(spark, vectors(spark), DIM)
        least = spark.sparkContext.defaultParallelism
        assert vt.bucketed and vt.partitions == least
        side = vt.side("features")
        assert side.rdd.getNumPartitions() == least and side.count() == 200  # tasks of every batch
        vt.unpersist()
        assert vs.bucket_count(spark, 60_000, 1128) > 60
        assert vs.bucket_count(spark, 6_000_000, 1128) > 90 * vs.bucket_count(spark, 60_000, 1128)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_fresh_session_joins_in_place(spark):
    path = fresh_path(spark, "t_vec")
    pl.materialize_vectors(spark, vectors(spark), DIM, path)
    code = f"""
import sys
sys.path[:0] = [{os.path.dirname(__file__)!r}, {os.path.dirname(os.path.dirname(__file__))!r}]
from test_vector_store import DIM, exchanges_over_vectors, plan
from ratingstream.plans import pipeline as pl
from ratingstream.session import local_session
from pyspark.sql import functions as F
spark = local_session(2, **{{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}})
vt = pl.materialize_vectors(spark, None, DIM, {path!r})
counts = spark.range(0, 200, 3).select(F.col("id").cast("int").alias("movie_id"), F.lit(2).alias("n"))
joined = pl.batch_points(counts, vt)
print("MOVED" if exchanges_over_vectors(plan(joined)) or not vt.bucketed else "IN PLACE", joined.count())
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=200)
    assert "IN PLACE 67" in out.stdout, out.stdout + out.stderr[-2000:]


def test_tables_from_before_bucketing_are_read(spark):
    path = fresh_path(spark, "t_vec")
    vectors(spark).write.parquet(path)
    vt = pl.materialize_vectors(spark, None, DIM, path)
    assert vt.n == 200 and not vt.bucketed and vt.side("features").count() == 200


def write_scores(spark, path, add=0.0, n=30, files=1):
    rows = spark.range(n).select(F.col("id").cast("int").alias("movie_id"), F.explode(F.sequence(F.lit(1), F.lit(DIM))).alias("tag_id"))
    rows = rows.withColumn("relevance", ((F.col("movie_id") * 7 + F.col("tag_id")) % 5 + add).cast("float"))
    rows.repartition(files).write.mode("overwrite").option("header", True).csv(path)


def test_fingerprints_follow_the_content_only(spark):
    a = spark.createDataFrame([(1, 1, 0.5), (1, 2, None), (2, 1, 0.25)], "movie_id int, tag_id int, relevance float")
    f = vs.content_fingerprint(a)
    assert f == vs.content_fingerprint(a.orderBy(F.desc("movie_id")).repartition(3))
    others = [a.union(a.limit(1)), a.where("movie_id = 1"), a.withColumn("relevance", F.coalesce("relevance", F.lit(0).cast("float"))), a.limit(0)]
    assert len({f, *map(vs.content_fingerprint, others)}) == 5


def test_versions_are_built_once_per_content(spark):
    src, root = fresh_path(spark, "t_scores"), fresh_path(spark, "t_store")
    write_scores(spark, src)
    store = vs.VectorStore(spark, root, src, DIM)
    one = store.refresh()
    assert store.refresh() == one
    write_scores(spark, src, files=3)  # the same content in other files
    assert store.refresh() == one and vs.VectorStore(spark, root, src, DIM).refresh() == one
    write_scores(spark, src, add=1.0)
    two = store.refresh()
    assert two != one and sorted(list_names(spark, root)) == sorted(["rejects", "stamps", f"version={one}", f"version={two}"])
    first = lambda v: store.open(v).df.where("movie_id = 0").first().scores[0]
    assert first(two) == first(one) + 1.0
    with pytest.raises(RuntimeError):
        store.open("nothing")


def test_a_changed_file_is_used_from_the_next_batch_and_a_replay_uses_the_old_one(spark):
    src, root = fresh_path(spark, "t_scores"), fresh_path(spark, "t_store")
    write_scores(spark, src)
    store = vs.VectorStore(spark, f"{root}/versions", src, DIM)
    paths = job.StreamPaths(f"{root}/out")
    start = store.current()
    state0 = km.centers_from_vectors(start.df, 2)
    from ratingstream.plans import model_table as mt

    mt.write_seed(spark, paths.state, state0)
    batch = spark.range(200).select(F.concat_ws(",", F.col("id"), F.col("id") % 30, F.lit("1.0")).alias("value"))
    kopts, opts = KMeansOptions(k=2, dim=DIM), StreamOptions(sample_fraction=0.0, compact_every=2)
    one = store.version

    def run(b, st):
        return job.process_batch(spark, batch, b, st.for_batch(b, paths.root), paths, kopts, opts)

    run(0, store)
    store.for_batch(1, paths.root)  # batch 1 is begun, and dies
    write_scores(spark, src, add=3.0)
    restarted = vs.VectorStore(spark, f"{root}/versions", src, DIM)
    assert run(1, restarted)  # run again: with the vectors it was begun with
    assert run(2, restarted)
    two = restarted.version
    used = {r.batch_id: r.version for r in job.read_table(spark, paths, "vectors").collect()}
    assert used == {0: one, 1: one, 2: two} and one != two
    # batch 1's sums are those of the old vectors
    centers, weights = km.model_arrays(job.run_log(spark, paths).model(0))
    old = pl.materialize_vectors(spark, None, DIM, restarted.path(one))
    counts = pl.movie_counts(batch.select((F.split("value", ",")[1]).cast("int").alias("movie_id")))
    n, total = km.stats_arrays(pl.batch_stats(counts, old, centers).collect(), 2, DIM)
    want = km.train_step_arrays(centers, weights, n, total)
    got = km.model_arrays(job.run_log(spark, paths).model(1))
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    assert len(list_names(spark, f"{paths.root}/vectors_chosen")) <= 2


def test_a_stream_follows_the_store(spark):
    from ratingstream.jobs import clusterer_job

    src, root = fresh_path(spark, "t_scores"), fresh_path(spark, "t_follow")
    write_scores(spark, src)
    lines = spark.range(120).select(F.concat_ws(",", F.col("id"), F.col("id") % 30, F.lit("2.0")).alias("value"))

    def run():
        q, paths = clusterer_job(
            spark, src, f"{root}/out", KMeansOptions(k=2, dim=DIM, seed=1), StreamOptions(), source_format="text", source_path=f"{root}/in/*",
            available_now=True, refresh_vectors=True,
        )
        assert q.exception() is None
        return paths

    lines.write.text(f"{root}/in/a")
    run()
    write_scores(spark, src, add=2.0)
    lines.write.text(f"{root}/in/b")
    paths = run()
    used = {r.batch_id: r.version for r in job.read_table(spark, paths, "vectors").collect()}
    assert len(used) == 2 and used[0] != used[1]
