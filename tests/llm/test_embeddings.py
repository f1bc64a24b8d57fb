import numpy as np
import pytest
from pyspark.sql import types as T

from ratingstream.llm import embedding_dedup as D
from ratingstream.llm import hilbert_ann as H

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        T.StructField("score", T.StringType()),
        T.StructField("n_links", T.StringType()),
    ]
)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)


def clustered(n, dim, seed, noise=0.12):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((max(2, n // 12), dim))
    x = centres[rng.integers(0, len(centres), n)] + noise * rng.standard_normal((n, dim))
    x[: n // 10] = x[n // 2]  # a hot group of equal vectors
    x[-n // 10 :] = rng.standard_normal((n // 10, dim))  # and some without neighbours
    return x.astype(np.float32).astype(float)


def brute_dedup(x, ids, threshold):
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = u @ u.T >= threshold
    np.fill_diagonal(link, False)
    label = np.arange(len(x))
    while True:
        new = np.array([min([label[i], *label[link[i]]]) for i in range(len(x))])
        if (new == label).all():
            return link.sum(axis=1), ids[label]
        label = new


@pytest.mark.parametrize("tile,pivots", [(1024, 256), (16, 256)])
def test_links_and_components_equal_brute_force(spark, monkeypatch, tile, pivots):
    x = clustered(600, 16, 3)
    ids = np.arange(600) * 3
    links, comp = brute_dedup(x, ids, 0.95)
    assert links.max() >= 59 and (links == 0).any()
    rows = D.near_duplicates(spark, frame(spark, list(zip(ids.tolist(), x.tolist()))), tile=tile, per_group=2).collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rows}
    assert got == {int(i): (int(n), int(c), int(i) == int(c)) for i, n, c in zip(ids, links, comp)}


def test_vectors_that_single_precision_does_not_hold(spark):
    x = clustered(200, 8, 4) + 1e-12 * np.random.default_rng(9).standard_normal((200, 8))
    ids = np.arange(200)
    links, comp = brute_dedup(x, ids, 0.95)
    df = spark.createDataFrame([(int(i), v) for i, v in zip(ids, x.tolist())] + [(500, [1e300, 0.0]), (501, [2e300, 0.0]), (502, [1e-300, 1e-300, 0.0]), (503, [3e-300, 3e-300, 1e-310])], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in D.near_duplicates(spark, df, tile=16, per_group=2).collect()}
    assert got == {int(i): (int(n), int(c)) for i, n, c in zip(ids, links, comp)} | {500: (1, 500), 501: (1, 500), 502: (1, 502), 503: (1, 502)}


def test_quantisation_bound_holds():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((200, 40))
    u = x / np.linalg.norm(x, axis=1)[:, None]
    q, s, e = D.quantise(u)
    est = (q @ q.T) * np.outer(s, s)
    assert (np.abs(u @ u.T - est) <= e[:, None] + (1 + e[:, None]) * e[None, :] + 1e-6).all()


ODD = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, []), (8, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (9, [2.0, 0.0]), (0, [1.0, 0.1]), (20, [1.0, 0.0])]


def test_dedup_odd_rows(spark):
    rows = D.near_duplicates(spark, frame(spark, ODD)).collect()
    assert len(rows) == len(ODD)
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in rows if r.vec_id is not None)
    alone = [(i, 0, i) for i in (2, 3, 4, 5, 6, 7, 8)]
    assert got == sorted([(0, 4, 0), (1, 4, 0), (1, 4, 0), (9, 4, 0), (20, 4, 0), *alone])
    assert [(r.n_links, r.component_id, r.kept) for r in rows if r.vec_id is None] == [(0, None, False)]
    assert D.near_duplicates(spark, frame(spark, [])).count() == 0


def test_hilbert_curve_visits_neighbours():
    side = np.arange(8)
    grid = np.stack(np.meshgrid(side, side, side, indexing="ij"), -1).reshape(-1, 3)
    place = H.hilbert_index(grid, 3)
    assert sorted(place) == list(range(512))
    step = np.abs(np.diff(grid[np.argsort(place)], axis=0)).sum(axis=1)
    assert (step == 1).all()


def brute_nearest(x, ids, queries, k):
    out = {}
    for i in queries:
        s = np.array([float((x[i] * y).sum()) for y in x])
        order = sorted((j for j in range(len(x)) if ids[j] != ids[i]), key=lambda j: (-s[j], ids[j]))
        out[int(ids[i])] = [(int(ids[j]), s[j]) for j in order[:k]]
    return out


def test_search_recall_order_and_scores(spark):
    x = clustered(900, 12, 5, noise=0.5)
    ids = np.arange(900)
    rows = H.nearest(spark, frame(spark, list(zip(ids.tolist(), x.tolist()))), slice_rows=100).collect()
    want = brute_nearest(x, ids, range(0, 900, 20), 20)
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        assert len(found) == 20 and found == sorted(found, key=lambda f: (-f[1], f[0]))
        hits += len({i for i, _ in found} & {i for i, _ in want[q]})
        for i, s in found:
            assert s == pytest.approx(float((x[q] * x[i]).sum()), rel=1e-12)
    assert hits / (20 * len(want)) >= 0.9


def test_rows_of_very_different_norms(spark, monkeypatch):
    """Clusters whose norms are log-normal: shells keep the windows a small share of the table."""
    rng = np.random.default_rng(21)
    centres = rng.standard_normal((150, 24))
    x = centres[rng.integers(0, 150, 6000)] + 0.3 * rng.standard_normal((6000, 24))
    x *= (rng.lognormal(0, 1, 6000) / np.linalg.norm(x, axis=1))[:, None]
    x = x.astype(np.float32).astype(float)
    asked = {}
    real = H.choose_windows

    def choose(gaps, shell, sizes, recall, least):
        asked["share"] = sum(min(2 * w + 2, n) for w, n in zip(real(gaps, shell, sizes, recall, least), sizes)) / sum(sizes)
        asked["shells"] = len(sizes)
        return real(gaps, shell, sizes, recall, least)

    monkeypatch.setattr(H, "choose_windows", choose)
    rows = H.nearest(spark, frame(spark, list(enumerate(x.tolist()))), slice_rows=500, batch_rows=40).collect()
    s = x[::20] @ x.T
    s[np.arange(300), np.arange(0, 6000, 20)] = -np.inf
    want = {20 * i: set(np.argsort(-row)[:20].tolist()) for i, row in enumerate(s)}
    hits = sum(r.vec_id in want[r.query_id] for r in rows)
    assert len(rows) == 6000 and hits / 6000 >= 0.9
    assert asked["shells"] > 5 and asked["share"] < 0.15  # of a curve; an order by place needed all of it


def test_windows_are_the_shortest_that_find_enough():
    gaps, shell = np.array([0, 1, 2, 3, 500, 900]), np.array([0, 0, 0, 0, 1, 1])
    assert H.choose_windows(gaps, shell, [10, 2000], 0.6, 1) == [3, 1]
    assert H.choose_windows(gaps, shell, [10, 2000], 1.0, 1) == [3, 900]
    assert H.choose_windows(gaps[:0], shell[:0], [10], 0.9, 20) == [20]


def test_directions_of_extreme_vectors():
    unit, shell = H.directions(np.array([[3e200, 4e200], [3e-200, 4e-200], [0.6, 0.8]]))
    assert np.allclose(unit, [[0.6, 0.8]] * 3) and shell[0] > 1000 and shell[1] < -1000 and shell[2] == 0


def test_search_odd_rows(spark):
    rows = H.nearest(spark, frame(spark, ODD)).collect()
    got = [(r.query_id, r.rank, r.vec_id) for r in sorted(rows, key=lambda r: (r.query_id, r.rank))]
    assert got == [(0, 1, 9), (0, 2, 1), (0, 3, 20), (20, 1, 9), (20, 2, 0), (20, 3, 1)]
    assert H.nearest(spark, frame(spark, [])).count() == 0
    assert H.nearest(spark, frame(spark, [(1, [1.0])])).count() == 0


def test_blocks_of_pairs_give_the_counts_and_roots_of_all_pairs():
    from ratingstream.llm import embedding_dedup as E

    r = np.random.default_rng(12)
    base = r.normal(size=(6, 16))
    x = np.concatenate([b + r.normal(size=(40, 16)) * s for b, s in zip(base, (0.01, 0.1, 0.2, 0.25, 0.3, 2.0))])
    ids, copies = r.permutation(1000)[: len(x)].astype(np.int64), r.integers(1, 4, len(x)).astype(np.int64)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = (u @ u.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    want = near @ copies
    for most in (1 << 20, 7):
        links, root = E.linked(ids, copies, E.pair_blocks(x, None, 0.95, most))
        assert (links == want).all()
        least = ids.copy()
        for _ in range(len(x)):
            least = np.minimum(least, np.where(near, least[None, :], 10**9).min(axis=1))
        assert (root == least).all()


def test_many_near_copies_are_counted_without_keeping_pairs():
    import tracemalloc

    from ratingstream.llm import embedding_dedup as E

    r = np.random.default_rng(13)
    x = r.normal(size=(1, 32)) + r.normal(size=(6000, 32)) * 1e-3
    tracemalloc.start()
    links, root = E.linked(np.arange(6000) + 5, np.ones(6000, np.int64), E.pair_blocks(x, None, 0.95))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (links == 5999).all() and (root == 5).all()
    assert peak < 400e6  # all 18 million pairs would be 288 MB twice, besides the products


def wide_rows(n=700, dim=48, seed=31):
    """Vectors without neighbours first, then groups near and just out of reach of each other: some blocks have many close pairs, others none."""
    r = np.random.default_rng(seed)
    groups = [b + r.normal(size=(60, dim)) * s for b, s in zip(r.normal(size=(5, dim)), (0.01, 0.15, 0.2, 0.23, 0.25))]
    return np.concatenate([r.normal(size=(n - 300, dim)), *groups]).astype(np.float32).astype(float)


def test_projections_lose_no_pair():
    x = wide_rows()
    u = x / np.linalg.norm(x, axis=1)[:, None]
    want = {(i, j) for i, j in zip(*np.nonzero(u @ u.T >= 0.95)) if i < j}
    assert len(want) > 1000
    for most in (1 << 20, 7):
        found = [(i, j) for a, b in D.pair_blocks(x, None, 0.95, most) for i, j in zip(a, b)]
        assert len(found) == len(want) and set(found) == want
    found = [(i, j + 500) for a, b in D.pair_blocks(x[:500], x[500:], 0.95) for i, j in zip(a, b)]
    assert len(found) == len(set(found)) and set(found) == {(i, j) for i, j in want if i < 500 <= j}
    a, b = D.projections(u, u)
    gap = np.linalg.norm(u[:, None] - u[None], axis=2) ** 2 / 2
    assert (a @ b.T >= -gap - 1e-5).all()


@pytest.mark.parametrize("tile", [1024, 16])
def test_tiles_meet_without_a_shuffle_of_vectors(spark, monkeypatch, tile):
    """Each vector is stored twice and shuffled twice, however many tiles meet; pairs of tiles are read from the stored table."""
    x = wide_rows()
    ids = np.sort(np.random.default_rng(1).permutation(5000)[: len(x)])
    links, comp = brute_dedup(x, ids, 0.95)
    plans = {}
    real = D.written

    def written(session, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(session, df, name)

    monkeypatch.setattr(D, "written", written)
    rows = D.near_duplicates(spark, frame(spark, list(zip(ids.tolist(), x.tolist()))), tile=tile, per_group=2).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in rows} == {int(i): (int(n), int(c)) for i, n, c in zip(ids, links, comp)}
    assert "CartesianProduct" in plans["vector_links"]
    assert not [x for x in plans["vector_links"].splitlines() if x.lstrip(" :+-*").startswith("Exchange")]
