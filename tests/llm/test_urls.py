import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingstream.llm import url_filter as U

SF = "/root/testdata/sf0.001"


def test_query_matches_oracle(spark):
    from ratingstream.llm.queries import registry, sql
    from tools.oracle_check import compare, duck

    same, n, _, detail = compare(spark, duck(SF), SF, registry()["op2_url_filter"], sql()["op2_url_filter"])
    assert same and n, detail


CASES = {
    "http://A.Example.NET/en/x?q#f": ("a.example.net", "/en/x", "example.net/en/", "allow"),
    "http://example.net": ("example.net", "", None, "allow"),
    "http://example.net/": ("example.net", "/", "net/", "block"),
    "x://org/fr/": ("org", "/fr/", "org/fr/", "allow"),
    "x://notexample.com/de/a": ("notexample.com", "/de/a", None, "allow"),
    "x://b.example.com/de/a": ("b.example.com", "/de/a", "example.com/de/", "block"),
    "x://www.spam-farm.example.org/a": ("www.spam-farm.example.org", "/a", None, "block"),
    "x://spam-farm2.example.org/a": ("spam-farm2.example.org", "/a", None, "allow"),
    "a?b://c/d": ("c", "/d", None, "allow"),
    "a://b://c/d": ("b:", "//c/d", None, "allow"),
    "no scheme/en": ("", "", None, "allow"),
    "://": ("", "", None, "allow"),
    "x://É.net/a\nb?c": ("É.net", "/a\nb", "net/", "block"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
}


def test_cases(spark):
    df = spark.createDataFrame([(u, "h", "r") for u in CASES], "url string, host string, rule string")
    rows = U.judge(spark, df).collect()
    assert {r.url: (r.host, r.path, r.rule, r.verdict) for r in rows} == CASES
    assert U.judge(spark, df.limit(0)).count() == 0


def test_a_list_that_no_expression_describes(spark):
    """Arbitrary hosts as a table: repeats, nulls, capitals and hosts that no page has; a hot host and repeated rows."""
    r = np.random.default_rng(8)
    hosts = [f"{r.integers(1 << 40):x}.example" for _ in range(1500)]
    chosen = set(r.choice(hosts, 400, replace=False).tolist())
    hot = sorted(chosen)[0]
    urls = [f"x://{h.upper() if i % 3 else h}/p" for i, h in enumerate(hosts)] + [f"x://{hot}/{i % 7}" for i in range(700)] + [None, f"x://sub.{hot}/"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    names = [(h.upper() if i % 2 else h,) for i, h in enumerate(sorted(chosen))] + [(hot,), (None,)] + [(f"unused{i}.example",) for i in range(50)]
    rows = U.judge(spark, pages, spark.createDataFrame(names, "domain string"), rules=(), host="domain").collect()
    assert len(rows) == len(urls)
    assert all((r.verdict == "block") == (r.host in chosen) and r.rule is None for r in rows)
    none = U.judge(spark, pages, spark.createDataFrame([], "host string"), rules=())
    assert none.where("verdict = 'block'").count() == 0


@pytest.mark.parametrize("max_bytes,bits", [(1 << 20, 10), (1 << 20, 2), (64, 8)])
def test_cascade_is_exact_for_its_universe(spark, max_bytes, bits):
    keys = spark.range(3000).select(F.concat(F.lit("host"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    cascades = U.build_cascades(spark, keys.union(keys), bits_per_key=bits, hashes=3, max_bytes=max_bytes)
    assert (len(cascades) > 1) == (max_bytes == 64)
    assert max(len(c.levels) for c in cascades) > 1
    got = U.listed(spark, keys, "key", cascades, "found")
    assert got.where("found <> listed").count() == 0 and got.count() == 3000


def test_empty_list(spark):
    keys = spark.createDataFrame([("a", False), (None, True)], "key string, listed boolean")
    got = U.listed(spark, keys, "key", U.build_cascades(spark, keys), "found").collect()
    assert [r.found for r in got] == [False, False]


def test_levels_hold_what_they_encode():
    h = np.arange(1, 500, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    words = np.zeros(80, np.uint64)
    p = U._positions(h, 0, 80 * 64, 5).ravel()
    np.bitwise_or.at(words, (p >> np.uint64(6)).astype(int), np.left_shift(np.uint64(1), p & np.uint64(63)))
    assert U.holds(words, h, 0, 5).all()
