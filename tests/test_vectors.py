from pyspark.sql import functions as F

from ratingstream.operators.features import (
    array_to_features,
    assemble_tag_vectors,
    join_ratings_features,
    sample_rows,
    sample_threshold,
    tag_score_rejects,
)


def _scores(spark, rows):
    return spark.createDataFrame(rows, "movie_id int, tag_id int, relevance float")


def test_assemble_dense_with_gaps_duplicates_and_rejects(spark):
    rows = [
        (1, 1, 0.5), (1, 3, 0.25), (1, 3, 0.75),  # gap at 2, duplicate tag 3 -> max
        (2, 1, 0.1), (2, 2, 0.2), (2, 3, 0.3),    # complete
        (3, 4, 9.0), (3, 0, 9.0), (None, 1, 1.0), (3, 2, None),  # rejected rows
    ]
    df = _scores(spark, rows)
    v = {r["movie_id"]: list(r["scores"]) for r in assemble_tag_vectors(df, 3).collect()}
    assert v[1] == [0.5, 0.0, 0.75]
    assert [round(x, 6) for x in v[2]] == [0.1, 0.2, 0.3]
    assert 3 not in v
    assert tag_score_rejects(df, 3).count() == 4


def test_text_path_gives_decimal_doubles(spark):
    df = spark.createDataFrame([(1, [0.1, 0.2])], "movie_id int, scores array<float>")
    direct = df.select(F.col("scores").cast("array<double>").alias("f")).first()["f"]
    text = array_to_features(df).first()["features"]
    assert text == [0.1, 0.2]
    assert direct[0] != 0.1


def test_assemble_plan_is_builtin_with_partial_max(spark):
    v = assemble_tag_vectors(_scores(spark, [(1, 1, 0.5)]), 3)
    plan = v._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert "partial_max" in plan


def test_join_broadcast_only_under_limit(spark):
    r = spark.createDataFrame([(1, 7), (1, 8), (5, 9)], "movie_id int, user_id int")
    v = spark.createDataFrame([(1, [1.0, 2.0])], "movie_id int, features array<double>")
    small = join_ratings_features(r, v, n_vectors=1, dim=2, broadcast_limit_bytes=10**6)
    assert small.count() == 2  # movie 5 has no vector; both ratings of movie 1 kept
    assert "broadcast" in small._jdf.queryExecution().analyzed().toString()
    big = join_ratings_features(r, v, n_vectors=10**9, dim=1128, broadcast_limit_bytes=10**6)
    # beyond it only the (few) hot movies are broadcast, to both sides; the vectors are shuffled
    plan = big._jdf.queryExecution().analyzed().toString()
    assert plan.count("strategy=broadcast") == 2 and "_salt" in plan
    assert big.count() == 2


def test_hash_sample_is_deterministic_and_close_to_fraction(spark):
    df = spark.range(200000).withColumnRenamed("id", "k")
    a = sample_rows(df, 0.01, key_cols=["k"]).count()
    b = sample_rows(df, 0.01, key_cols=["k"]).count()
    assert a == b
    assert 1700 < a < 2300
    assert sample_threshold(0.01) == "028f5c29"


def test_aggregate_below_join_equals_per_rating_plan(spark):
    """Counting per movie (or per movie and rating) before the join gives the per-rating stats."""
    import numpy as np

    from ratingstream.operators import kmeans as km
    from ratingstream.plans import pipeline as pl
    from ratingstream.sources import fixtures as fx

    from conftest import SF_SMOKE

    emb = fx.table(spark, SF_SMOKE, "embeddings")
    dim = fx.embedding_dim(emb)
    vt = pl.materialize_vectors(spark, pl.movie_vectors(fx.tag_scores_from_embeddings(emb), dim), dim)
    centers = km.model_arrays(km.centers_from_vectors(vt.df, 4))[0]
    ratings = fx.ratings_from_events(fx.table(spark, SF_SMOKE, "events"))
    for scale in (False, True):
        for method in ("arrow", "sql"):
            fast = pl.batch_stats(pl.movie_counts(ratings, scale), vt, centers, scale, method)
            side = vt.df.select("movie_id", "scores", "features")
            per_row = ratings.join(side, "movie_id")
            if scale:
                per_row = per_row.drop("features").transform(
                    lambda d: d.withColumn("features", F.transform("scores", lambda x: x * F.col("rating")))
                ).withColumn("features", F.transform("features", lambda x: x.cast("string").cast("double")))
            slow = km.cluster_stats(km.assign_clusters(per_row, centers, method="sql"))
            a = {r["cluster"]: r for r in fast.collect()}
            b = {r["cluster"]: r for r in slow.collect()}
            assert a.keys() == b.keys()
            for c in a:
                assert a[c]["n"] == b[c]["n"]
                np.testing.assert_allclose(a[c]["total"], b[c]["total"], rtol=1e-9, atol=1e-9)


def test_hot_movie_and_hot_duplicates(spark):
    """A third of the ratings on one movie, and one movie's tag scores repeated 300 times."""
    import numpy as np

    from ratingstream.operators import kmeans as km
    from ratingstream.plans import pipeline as pl
    from ratingstream.sources import fixtures as fx

    from conftest import SF_SMOKE

    emb = fx.table(spark, SF_SMOKE, "embeddings")
    dim = fx.embedding_dim(emb)
    scores = fx.tag_scores_from_embeddings(emb)
    dup = scores.where(F.col("movie_id") == 7).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(300))))
    hot_scores = scores.unionByName(dup.drop("copy"))
    plain = {r["movie_id"]: r["scores"] for r in assemble_tag_vectors(scores, dim).collect()}
    hot = {r["movie_id"]: r["scores"] for r in assemble_tag_vectors(hot_scores, dim).collect()}
    assert plain == hot

    vt = pl.materialize_vectors(spark, pl.movie_vectors(scores, dim), dim)
    centers = km.model_arrays(km.centers_from_vectors(vt.df, 3))[0]
    ratings = fx.ratings_from_events(fx.table(spark, SF_SMOKE, "events")).withColumn(
        "movie_id", F.when(F.col("msg_id") % 3 == 0, F.lit(7)).otherwise(F.col("movie_id"))
    )
    counts = pl.movie_counts(ratings)
    fast = pl.batch_stats(counts, vt, centers, method="sql")
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning(movie_id")  # map side first
    per_row = ratings.join(vt.df.select("movie_id", "features"), "movie_id")
    slow = km.cluster_stats(km.assign_clusters(per_row, centers, method="sql"))
    a = {r["cluster"]: r for r in fast.collect()}
    b = {r["cluster"]: r for r in slow.collect()}
    for c in b:
        assert a[c]["n"] == b[c]["n"]
        np.testing.assert_allclose(a[c]["total"], b[c]["total"], rtol=1e-9, atol=1e-9)
