import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from ratingstream.llm import simhash_dedup as S
from ratingstream.llm.components import components
from llm_fixtures import broadcast_steps, no_docs, odd_docs  # noqa: F401


def brute_fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(fps, bits):
    """Smallest index reachable, by comparing all pairs."""
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= bits:
            a, b = sorted((find(i), find(j)))
            label[b] = a
    return [find(i) for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_is_the_majority_of_shingle_hashes():
    for t in ["a", "A b", "a b c", "a B\tc d\ne f g a b c a b c", "", None, "  ", "é É x"]:
        assert S.fingerprint(t) == brute_fingerprint(t)


def test_spark_hash_is_the_same(spark):
    h = spark.sql("select xxhash64('the quick fox') h").first().h
    assert h & (2**64 - 1) == xxhash.xxh64(b"the quick fox", seed=42).intdigest()


def test_golay_code_is_perfect():
    unit, near, flips = S.golay_tables()
    assert len({int(n) for n in near}) == 2048  # every syndrome has its own flip of weight 3 at most
    assert max(int(n).bit_count() for n in near) == 3
    assert (flips >= 0).sum(axis=1).max() == 6


@pytest.mark.parametrize("wrong", [0, 1])
def test_probe_keys_hold_the_neighbours_index_key(wrong):
    rng = np.random.default_rng(1)
    w = rng.integers(0, 1 << 23, 500)
    for bit in range(23) if wrong else [0]:
        index, _ = S.golay_keys(w ^ (wrong << bit))
        _, probes = S.golay_keys(w)
        assert (probes == index[:, None]).any(axis=1).all()


@pytest.mark.parametrize("hot", [1, 64])
@pytest.mark.parametrize("bits", [0, 1, 2])
def test_links_connect_what_brute_force_connects(spark, hot, bits):
    rnd = random.Random(bits)
    fps = [rnd.getrandbits(64) for _ in range(30)]
    for f in list(fps[:12]):
        for _ in range(4):
            g = f
            for b in rnd.sample(range(64), rnd.randrange(4)):
                g ^= 1 << b
            fps.append(g)
    fps = sorted(set(fps) | {0, 1, 3, 7}, key=signed)
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    root = {r.a: r.b for r in components(spark, S.fingerprint_links(spark, df, bits, hot_cell=hot)).collect()}
    got = [root.get(signed(f), signed(f)) for f in fps]
    assert got == [signed(fps[i]) for i in brute_classes(fps, bits)]


@pytest.mark.parametrize("bits", [1, 2])
def test_looked_up_cells_are_not_broadcast(spark, bits):
    """Some 30 cells and 65 meeting points a fingerprint: small by Spark's reckoning, not in the driver's memory."""
    fps = S.written(spark, spark.createDataFrame([(i,) for i in range(200)], "fp long"), "fps")
    links = S.fingerprint_links(spark, fps, bits, hot_cell=8)
    assert "MapInArrow" in links._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in broadcast_steps(links) if x.startswith("MapInArrow")]


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5), (None, 3), (7, None)]
    got = {r.a: r.b for r in components(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 101)} | {i: 1000 for i in range(1001, 1200)}


def test_odd_rows(spark, odd_docs, no_docs):
    rows = S.near_duplicates(spark, odd_docs).collect()
    assert len(rows) == 10
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[1].component_id == 1 and sum(r.doc_id == 1 for r in rows) == 2
    assert by_id[2].fingerprint == "0" * 16
    assert {by_id[i].component_id for i in (2, 3, 4)} == {2}
    nulls = sorted((r.component_id for r in rows if r.doc_id is None), key=str)
    assert nulls == [2, None]
    assert S.near_duplicates(spark, no_docs).count() == 0


def test_query_against_brute_force(spark):
    from ratingstream.llm.queries import op8_simhash_dedup

    sf = "/root/testdata/sf0.001"
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    fps = [brute_fingerprint(d.text) for d in docs]
    want = {(d.doc_id, f"{f:016x}", docs[i].doc_id) for d, f, i in zip(docs, fps, brute_classes(fps, 2))}
    assert {tuple(r) for r in op8_simhash_dedup(spark, sf).collect()} == want
