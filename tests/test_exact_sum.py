import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingstream.operators import exact_sum as X
from ratingstream.operators import kmeans as km


def exact(values, counts):
    """math.fsum of every value as often as it counts; products are cut so that nothing is rounded."""
    parts = []
    for v, n in zip(values, counts):
        n = int(n)
        while n:  # v times a power of two is exact
            low = n & -n
            parts.append(v * low)
            n -= low
    return math.fsum(parts)


def by_group(x, groups, counts):
    return {g: [exact(x[groups == g, e], counts[groups == g]) for e in range(x.shape[1])] for g in sorted(set(groups.tolist()))}


def summed(x, groups, counts, pieces):
    """The same through any number of tasks."""
    totals: dict = {}
    for rows in pieces:
        s = X.Sums()
        s.add(groups[rows], np.ascontiguousarray(x[rows].T), counts[rows].astype(float))
        b = s.rows()
        for c, k, p, d in zip(*(b.column(i).to_pylist() for i in range(4))):
            if k < X.COUNT:
                totals.setdefault(c, {}).setdefault(p, {}).setdefault(k, 0)
                totals[c][p][k] += d
    return {g: [X.rounded(totals.get(g, {}).get(e, {})) for e in range(x.shape[1])] for g in sorted(set(groups.tolist()))}


@pytest.mark.parametrize("seed", range(6))
def test_equal_to_fsum_for_any_partitioning(seed):
    r = np.random.default_rng(seed)
    n = 300
    spread = [0, 5, 40, 300, 290, 30][seed]
    x = r.normal(size=(n, 5)) * 10.0 ** r.integers(-spread, spread + 1, (n, 5))
    if seed == 4:  # sums that cancel nearly
        x[n // 2 :] = -x[: n // 2] * (1 + 2.0**-50)
    if seed == 5:
        x[r.random((n, 5)) < 0.3] = 0.0
        x[0] = [5e-324, -5e-324, 1e-310, 2.0**-1022, -0.0]
    groups, counts = r.integers(0, 3, n), r.choice([1, 2, 3, 1000, 123_456_789], n)
    if spread > 200:
        counts = np.ones(n, np.int64)
    want = by_group(x, groups, counts)
    for k in (1, 2, 7):
        order = r.permutation(n)
        got = summed(x, groups, counts, np.array_split(order, k))
        assert got == want


def test_digits_stay_small():
    s = X.Sums()
    for _ in range(50):
        s.add(np.zeros(2, int), np.full((3, 2), 2.0**23 - 1), np.array([float(X.MOST), float(X.MOST)]))
    assert all(np.abs(d).max() <= 2**24 for d in s.digits[0].values())
    assert X.rounded({k: int(d[0]) for k, d in s.digits[0].items()}) == (2.0**23 - 1) * 100 * X.MOST


def test_rounding_to_nearest_even_and_overflow():
    assert X.rounded({0: 1 << 53, -3: 1}) == 2.0**53 and X.rounded({0: (1 << 53) + 1}) == 2.0**53
    assert X.rounded({0: (1 << 53) + 1, -40: 1}) == 2.0**53 + 2
    assert X.rounded({44: 1}) == math.inf and X.rounded({44: -1}) == -math.inf and X.rounded({}) == 0.0


def frame(spark, x, groups, counts):
    rows = [(int(g), [float(v) for v in row], int(n)) for row, g, n in zip(x, groups, counts)]
    return spark.createDataFrame(rows, "cluster int, features array<double>, n long")


def stats(df):
    return {r.cluster: (r.n, r.total) for r in df.collect()}


def test_cluster_stats_are_exact_and_the_same_bits_for_any_partitioning(spark):
    r = np.random.default_rng(9)
    x = r.normal(size=(500, 4)) * 10.0 ** r.integers(-12, 12, (500, 4))
    groups, counts = r.integers(0, 4, 500), r.integers(1, 10**6, 500)
    want = {g: (float(counts[groups == g].sum()), v) for g, v in by_group(x, groups, counts).items()}
    df = frame(spark, x, groups, counts)
    for shuffled in (df.coalesce(1), df.repartition(7), df.orderBy(F.rand(3))):
        assert stats(km.cluster_stats(shuffled, weight_col="n")) == want
    ones = {g: (float((groups == g).sum()), v) for g, v in by_group(x, groups, np.ones(500, int)).items()}
    assert stats(km.cluster_stats(df)) == ones


def test_numbers_that_are_not_finite(spark):
    inf, nan = math.inf, math.nan
    x = np.array([[1.0, inf, inf, nan, 1.5], [2.0, 1.0, -inf, 1.0, -inf], [0.0, 0.0, 0.0, 0.0, 0.0]])
    (n, total) = stats(km.cluster_stats(frame(spark, x, np.zeros(3, int), np.ones(3, int)), weight_col="n"))[0]
    assert n == 3.0 and total[:2] == [3.0, inf] and math.isnan(total[2]) and math.isnan(total[3]) and total[4] == -inf


def test_empty_input_zero_vectors_and_bad_weights(spark):
    none = spark.createDataFrame([], "cluster int, features array<double>, n long")
    assert km.cluster_stats(none, weight_col="n").collect() == []
    zeros = frame(spark, np.zeros((2, 3)), np.array([4, 4]), np.array([2, 5]))
    assert stats(km.cluster_stats(zeros, weight_col="n")) == {4: (7.0, [0.0, 0.0, 0.0])}
    with pytest.raises(Exception, match="counts"):
        km.cluster_stats(zeros.withColumn("n", F.lit(0.5)), weight_col="n").collect()


def test_large_counts_are_split(spark):
    big = (1 << 40) + 7
    df = frame(spark, np.array([[0.1, -0.3]]), np.array([0]), np.array([big]))
    assert stats(km.cluster_stats(df, weight_col="n"))[0] == (float(big), [exact([0.1], [big]), exact([-0.3], [big])])


def test_fused_stats_equal_assignment_and_sums(spark):
    r = random.Random(3)
    rows = [(i, [r.gauss(0, 1) for _ in range(6)], r.randint(1, 50)) for i in range(300)]
    df = spark.createDataFrame(rows, "movie_id int, features array<double>, n long").repartition(5)
    centers = np.array([[r.gauss(0, 1) for _ in range(6)] for _ in range(3)])
    two = stats(km.cluster_stats(km.assign_clusters(df, centers), weight_col="n"))
    assert stats(km.nearest_stats(df, centers, weight_col="n")) == two


def test_sums_are_aggregated_before_the_exchange(spark):
    df = frame(spark, np.ones((10, 2)), np.zeros(10, int), np.ones(10, int))
    plan = km.cluster_stats(df, weight_col="n")._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "MapInArrow" in plan
