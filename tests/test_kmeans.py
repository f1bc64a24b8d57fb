import numpy as np
import pytest

from ratingstream.operators import kmeans as km


def _points(spark, pts):
    return spark.createDataFrame([([float(x) for x in p],) for p in pts], "features array<double>")


def _step(spark, centers, weights, pts, decay=1.0, unit="batches", method="sql"):
    state = km.state_frame(spark, centers, weights)
    if pts:
        assigned = km.assign_clusters(_points(spark, pts), np.array(centers, float), method=method)
        stats = km.cluster_stats(assigned)
    else:
        stats = spark.createDataFrame([], "cluster int, n double, total array<double>")
    return km.model_arrays(km.train_step(state, stats, decay, unit))


PTS = [(1, 1), (3, 3), (9, 9)]
C2 = [(0, 0), (10, 10)]

GOLDEN = [
    ("weights 0, decay 1", C2, [0, 0], PTS, 1.0, "batches", [[2, 2], [9, 9]], [2, 1]),
    ("weights 2, decay 0.5, batches", C2, [2, 2], PTS, 0.5, "batches", [[4 / 3] * 2, [9.5] * 2], [3, 2]),
    ("weights 2, decay 0.5, points", C2, [2, 2], PTS, 0.5, "points", [[16 / 9] * 2, [9.2] * 2], [2.25, 1.25]),
    ("empty batch", C2, [2, 2], [], 0.5, "batches", [[0, 0], [10, 10]], [1, 1]),
]


@pytest.mark.parametrize("name,centers,weights,pts,decay,unit,exp_c,exp_w", GOLDEN, ids=[g[0] for g in GOLDEN])
def test_golden_update(spark, name, centers, weights, pts, decay, unit, exp_c, exp_w):
    c, w = _step(spark, centers, weights, pts, decay, unit)
    np.testing.assert_allclose(c, exp_c, rtol=1e-12)
    np.testing.assert_allclose(w, exp_w, rtol=1e-12)


def test_split_of_dying_cluster(spark):
    c, w = _step(spark, [(0, 0), (1000, 1000)], [0, 0], [(1, 1), (3, 3)])
    assert list(w) == [1.0, 1.0]
    assert c[0][0] == 2.0 + 2e-14 and c[1][0] == 2.0 - 2e-14


def test_only_one_split_per_batch(spark):
    c, w = _step(spark, [(0, 0), (1000, 1000), (2000, 2000)], [0, 0, 0], [(1, 1), (3, 3)])
    assert list(w) == [1.0, 1.0, 0.0]
    assert list(c[2]) == [2000.0, 2000.0]


def test_matches_mllib_update(spark):
    from pyspark.mllib.clustering import StreamingKMeansModel
    from pyspark.mllib.linalg import Vectors

    rng = np.random.default_rng(3)
    pts = rng.normal(size=(300, 4)).tolist()
    centers = rng.normal(size=(3, 4)).tolist()
    for decay, unit, w0 in [(1.0, "batches", 0.0), (0.7, "batches", 5.0), (0.9, "points", 50.0)]:
        model = StreamingKMeansModel([Vectors.dense(x) for x in centers], [w0] * 3)
        rdd = spark.sparkContext.parallelize([Vectors.dense(p) for p in pts], 4)
        model = model.update(rdd, decay, unit)
        c, w = _step(spark, centers, [w0] * 3, pts, decay, unit)
        np.testing.assert_allclose(c, np.array([np.asarray(x) for x in model.centers]), rtol=1e-10, atol=1e-12)
        np.testing.assert_allclose(w, model.clusterWeights, rtol=1e-12)


def test_assign_tie_goes_to_lowest_index_and_methods_agree(spark):
    centers = np.array([[1.0, 0.0], [-1.0, 0.0], [0.0, 5.0]])
    pts = [(0, 0), (0.9, 0), (-2, 0), (0, 4), (0, 2.5)]
    df = _points(spark, pts)
    a = km.assign_clusters(df, centers, method="arrow").select("cluster").collect()
    b = km.assign_clusters(df, centers, method="sql").select("cluster").collect()
    assert [r[0] for r in a] == [r[0] for r in b] == [0, 0, 1, 2, 2]


def test_weighted_stats_equal_repeated_points(spark):
    centers = np.array([[0.0, 0.0], [10.0, 10.0]])
    rep = _points(spark, [(1, 2), (1, 2), (1, 2), (8, 9)])
    w = spark.createDataFrame([([1.0, 2.0], 3), ([8.0, 9.0], 1)], "features array<double>, n long")
    s1 = km.cluster_stats(km.assign_clusters(rep, centers)).orderBy("cluster").collect()
    s2 = km.cluster_stats(km.assign_clusters(w, centers), weight_col="n").orderBy("cluster").collect()
    for a, b in zip(s1, s2):
        assert a["n"] == b["n"]
        np.testing.assert_allclose(a["total"], b["total"])


def test_stats_plan_is_partial_aggregate(spark):
    df = _points(spark, PTS)
    st = km.cluster_stats(km.assign_clusters(df, np.array(C2, float), method="sql"))
    plan = st._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ObjectHashAggregate") >= 2 or plan.count("SortAggregate") >= 2


def test_init_centers_and_dim_check(spark):
    st = km.init_centers(spark, k=5, dim=7, weight=0.0, seed=1)
    c, w = km.model_arrays(st)
    assert c.shape == (5, 7) and list(w) == [0.0] * 5
    with pytest.raises(ValueError):
        km.check_dim(c, 1128)
    same = km.model_arrays(km.init_centers(spark, k=5, dim=7, seed=1))[0]
    np.testing.assert_array_equal(c, same)


def test_centers_from_vectors_takes_first_k(spark):
    v = spark.createDataFrame([(i, [float(i), 0.0]) for i in [9, 3, 7, 1]], "movie_id int, features array<double>")
    st = km.centers_from_vectors(v, 2)
    rows = st.orderBy("cluster").collect()
    assert [r["center"][0] for r in rows] == [1.0, 3.0]
    assert [r["cluster"] for r in rows] == [0, 1]


@pytest.mark.parametrize("name,centers,weights,pts,decay,unit,exp_c,exp_w", GOLDEN, ids=[g[0] for g in GOLDEN])
def test_driver_update_equals_dataframe_update(spark, name, centers, weights, pts, decay, unit, exp_c, exp_w):
    c0 = np.array(centers, float)
    if pts:
        assigned = km.assign_clusters(_points(spark, pts), c0, method="sql")
        n, total = km.stats_arrays(km.cluster_stats(assigned).collect(), len(c0), c0.shape[1])
    else:
        n, total = np.zeros(len(c0)), np.zeros_like(c0)
    c, w = km.train_step_arrays(c0, np.array(weights, float), n, total, decay, unit)
    c2, w2 = _step(spark, centers, weights, pts, decay, unit)
    np.testing.assert_array_equal(c, c2)
    np.testing.assert_array_equal(w, w2)


def test_driver_update_split_cases():
    c, w = km.train_step_arrays(
        np.array([[0.0, 0.0], [1000.0, 1000.0], [2000.0, 2000.0]]), np.zeros(3),
        np.array([2.0, 0.0, 0.0]), np.array([[4.0, 4.0], [0.0, 0.0], [0.0, 0.0]]),
    )
    assert list(w) == [1.0, 1.0, 0.0]
    assert c[0][0] == 2.0 + 2e-14 and c[1][0] == 2.0 - 2e-14 and list(c[2]) == [2000.0, 2000.0]


def test_arrow_and_sql_assignment_agree_on_wide_vectors(spark):
    rng = np.random.default_rng(11)
    pts = rng.normal(size=(400, 300))
    centers = rng.normal(size=(5, 300))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(pts)], "i int, features array<double>")
    a = km.assign_clusters(df, centers, method="arrow").orderBy("i").select("cluster").collect()
    b = km.assign_clusters(df, centers, method="sql").orderBy("i").select("cluster").collect()
    want = ((pts[:, None, :] - centers[None, :, :]) ** 2).sum(-1).argmin(1)
    assert [r[0] for r in a] == [r[0] for r in b] == want.tolist()


@pytest.mark.parametrize("dim", [3, 64, 128, 129, 1128])
def test_exact_ties_agree_at_every_width(spark, dim):
    """Points half way between two centres: both forms sum alike, so both give the same (lowest) index."""
    rng = np.random.default_rng(dim)
    centers = rng.integers(-8, 8, (4, dim)).astype(float) / 8
    mirrored = np.vstack([centers, -centers])
    pts = np.vstack([np.zeros((1, dim)), rng.permuted(np.abs(rng.normal(size=(40, dim))), axis=1)])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(pts)], "i int, features array<double>")
    a = [r[0] for r in km.assign_clusters(df, mirrored).orderBy("i").select("cluster").collect()]
    b = [r[0] for r in km.assign_clusters(df, mirrored, method="sql").orderBy("i").select("cluster").collect()]
    assert a == b
    assert "ArrowEvalPython" in km.assign_clusters(df, mirrored)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("method", ["arrow", "sql"])
def test_nan_never_wins_over_a_finite_distance(spark, method):
    nan, inf = float("nan"), float("inf")
    centers = np.array([[nan, 0.0], [inf, 0.0], [5.0, 5.0], [-5.0, -5.0]])
    df = _points(spark, [(4, 4), (-4, -4), (nan, 1), (inf, 0)])
    got = [r[0] for r in km.assign_clusters(df, centers, method=method).select("cluster").collect()]
    assert got == [2, 3, 0, 0]


def test_init_centers_look_normal_and_follow_the_seed(spark):
    c = km.model_arrays(km.init_centers(spark, k=20, dim=500, seed=3))[0]
    assert abs(c.mean()) < 0.03 and abs(c.std() - 1) < 0.03
    other = km.model_arrays(km.init_centers(spark, k=20, dim=500, seed=4))[0]
    assert not np.allclose(c, other)
    assert not np.allclose(*(km.model_arrays(km.init_centers(spark, k=2, dim=9))[0] for _ in range(2)))
