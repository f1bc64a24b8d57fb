import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingstream.operators import bounds as B
from ratingstream.operators import kmeans as km
from ratingstream.options import KMeansOptions, StreamOptions
from ratingstream.plans import pipeline as pl

from test_stream import _setup


def frame(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "movie_id int, features array<double>").repartition(3)


def clusters(df):
    return {r.movie_id: r.cluster for r in df.collect()}


def follow(spark, vectors, path):
    """Clusters by bounds along a path of centres, each held against the full assignment; the numbers scored again."""
    bounds, scored = B.scored_bounds(vectors, path[0]), []
    for before, after in zip(path, path[1:]):
        bounds = B.advance(bounds, vectors, before, after).persist()
        assert clusters(bounds) == clusters(km.assign_clusters(vectors, after))
        scored.append(bounds.where("rescored").count())
        bounds = bounds.drop("rescored")
    return scored


@pytest.mark.parametrize("seed", range(3))
def test_random_drifts_give_the_full_assignment(spark, seed):
    r = np.random.default_rng(seed)
    x = r.normal(size=(400, 6)) * r.choice([1e-3, 1.0, 1e6])
    path = [r.normal(size=(4, 6)) * np.abs(x).max()]
    for step in (1e-9, 1e-3, 0.05, 0.0, 0.3, 2.0):
        path.append(path[-1] + r.normal(size=(4, 6)) * step * np.abs(x).max())
    scored = follow(spark, frame(spark, x), path)
    assert scored[0] < 40 and scored[3] < 40  # hardly any vector is read for a small shift


def test_ties_go_to_the_lowest_index(spark):
    """Points on a grid, centres that move along it: many exact ties, and near ties that rounding decides."""
    g = np.array([(a, b) for a in range(-4, 5) for b in range(-4, 5)], float)
    path = [np.array(c, float) for c in ([(2, 0), (-2, 0), (0, 2)], [(-2, 0), (2, 0), (0, 2)], [(1, 1), (1, 1), (-1, -1)], [(1, 1), (1 + 2**-52, 1), (-1, -1)], [(0.1, 0.3), (0.3, 0.1), (0.2, 0.2)])]
    follow(spark, frame(spark, g), path)
    follow(spark, frame(spark, g * 0.1), [c * 0.1 for c in path])


def test_what_is_no_number_is_scored_in_full(spark):
    x = np.array([[1.0, 2.0], [np.nan, 0.0], [np.inf, 1.0], [1e200, -1e200], [0.0, 0.0], [1e-170, 0.0]])
    path = [np.array([[0.0, 0.0], [3.0, 3.0]]), np.array([[0.0, 0.1], [np.nan, 3.0]]), np.array([[np.inf, 0.0], [3.0, 3.0]]), np.array([[1.0, 0.0], [3.0, 3.0]]), np.array([[1e-170, 0.0], [2e-170, 0.0]]), np.array([[2e-170, 0.0], [1e-170, 0.0]])]
    follow(spark, frame(spark, x), path)


def test_one_centre_is_never_scored_again(spark):
    x = np.arange(20.0).reshape(10, 2)
    assert follow(spark, frame(spark, x), [np.zeros((1, 2)), np.ones((1, 2)), np.full((1, 2), 50.0)]) == [0, 0]


def test_bounds_hold(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(200, 8))
    a = r.normal(size=(5, 8))
    b = a + 0.2 * r.normal(size=(5, 8))
    rows = B.moved_bounds(B.scored_bounds(frame(spark, x), a), a, b).collect()
    for row in rows:
        d = np.sqrt(((x[row.movie_id] - b) ** 2).sum(axis=1))
        assert row.upper >= d[row.cluster] and row.lower <= np.delete(d, row.cluster).min()


def test_moves_read_only_the_vectors_that_cross(spark):
    r = np.random.default_rng(6)
    vectors = frame(spark, r.normal(size=(50, 3)))
    a = r.normal(size=(3, 3))
    moved = B.advance(B.scored_bounds(vectors, a), vectors, a, a + 0.01)
    plan = moved._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("decay", [1.0, 0.5])
def test_fold_and_stream_equal_the_full_form(spark, decay):
    from ratingstream.operators.parse import accepted, parse_rating
    from ratingstream.plans import model_table as mt
    from ratingstream.session import fresh_path
    from ratingstream.streaming import job

    vt, state0, recs = _setup(spark)
    kopts = KMeansOptions(k=3, dim=vt.dim, decay=decay)
    good = accepted(parse_rating(recs.select(F.col("value").cast("string").alias("value"), "offset"), keep=["offset"]))
    good = good.withColumn("b", F.pmod("offset", F.lit(4)).cast("int"))
    full = km.model_arrays(pl.run_fold(spark, good, "b", vt, state0, kopts).log.latest_model())
    run = pl.run_fold(spark, good, "b", vt, state0, kopts, StreamOptions(assign_method="incremental"))
    kept = km.model_arrays(run.log.latest_model())
    np.testing.assert_allclose(kept[0], full[0], rtol=1e-12, atol=1e-15)
    np.testing.assert_array_equal(kept[1], full[1])
    assert [b for b, *_ in run.rescored] == [0, 1, 2, 3] and all(0 <= k <= n == vt.n for _, n, k in run.rescored)
    assert run.rescored[0][2] == vt.n  # the first batch scores all
    final = run.assignment.at(kept[0])
    assert clusters(final) == clusters(km.assign_clusters(vt.side("features"), kept[0]))

    found = []
    for method in ("arrow", "incremental"):
        paths = job.StreamPaths(fresh_path(spark, "t_inc"))
        mt.write_seed(spark, paths.state, state0)
        memo: dict = {}
        for b in range(3):
            job.process_batch(spark, recs.where(F.pmod("offset", F.lit(4)) == b), b, vt, paths, kopts, StreamOptions(assign_method=method, sample_fraction=0.3), memo)
        preds = job.read_table(spark, paths, "predictions").select("batch_id", "offset", "cluster")
        found.append((sorted(map(tuple, preds.collect())), km.model_arrays(job.run_log(spark, paths).latest_model())[1].tolist()))
    assert found[0] == found[1]


def test_scaled_features_are_refused(spark):
    vt, state0, recs = _setup(spark)
    with pytest.raises(ValueError):
        pl.incremental_assignment(spark, vt, km.model_arrays(state0)[0], StreamOptions(assign_method="incremental", scale_by_rating=True))
