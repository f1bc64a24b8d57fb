"""Every registered query answers actions that prune its columns, not only full reads."""

import pytest
from pyspark.sql import functions as F

from ratingstream.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.registry()))
def test_pruning_actions(spark, name):
    df = queries.registry()[name](spark, SF)
    rows = df.collect()
    assert rows and df.count() == len(rows)
    for c in (df.columns[0], df.columns[-1]):
        assert len(df.select(c).collect()) == len(rows)
    key = df.columns[0]
    assert df.where(F.col(key).isNotNull()).count() == sum(r[key] is not None for r in rows)
    assert df.agg(F.count(F.lit(1)).alias("n")).first().n == len(rows)
    ids = df.select(key).distinct()
    assert df.select(key, df.columns[1]).join(ids, key).count() == sum(r[key] is not None for r in rows)
