"""Registered queries against their DuckDB oracles on the smallest tables."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMOKE
from tools.oracle_check import compare, duck

# The corpus queries' oracles are held in tests/llm.
NAMES = sorted(n for n in entry.oracle_sql() if not n.startswith("op") and n != "pipeline")


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMOKE)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    same, n_spark, n_duck, detail = compare(spark, con, SF_SMOKE, entry.queries()[name], entry.oracle_sql()[name])
    assert same, detail
    assert n_spark == n_duck


def test_every_query_has_a_result_schema(spark):
    qs = entry.queries()
    for name in ["stamp_time", "init_centers", "model_report", "format_center", "prediction_report"]:
        df = qs[name](spark, SF_SMOKE)
        assert df.count() > 0, name


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["cluster", "n"]
    assert df.count() > 0


def test_sql_twin_of_jvm_double_text(spark):
    """The oracle's text of a double equals Spark's cast to string across magnitudes."""
    import random

    import duckdb

    from ratingstream.plans.oracle import _java_text

    rnd = random.Random(7)
    vals = [0.0, 1.0, -0.0003, 1e7, 9999999.5, 0.001, 0.00099, 1.5e20, 12345678.9, 1e-05]
    vals += [rnd.uniform(-1, 1) * 10 ** rnd.randint(-12, 12) for _ in range(5000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    got = {r.i: r.s for r in df.selectExpr("i", "cast(x as string) s").collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(vals)))
    want = dict(con.execute(f"SELECT i, {_java_text('x')} FROM t").fetchall())
    assert got == want
