"""The corpus pipeline: quality, toxicity, near-duplicates, packing.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and returns the
documents it keeps (all columns of ``documents``), the last one the packed pieces. ``run``
writes each stage's rows as Parquet under the shared checkpoint folder and reads them back
as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingstream.llm import packing, quality, simhash_dedup, toxicity
from ratingstream.llm.common import table, written


#: Names for a stage's own columns, which no column of the documents has.
SCORE, PREDICTED, KEY = "\x01score", "\x01predicted", "\x01key"


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose quality score is 0.3 or more; the classifier learns from the stage's own input."""
    model = quality.fit(spark, docs, table(spark, sf_dir, "labels"))
    scored = quality.score(spark, docs, model, out=SCORE, predicted=PREDICTED)
    return scored.where(F.col(PREDICTED) == 1).select(*_columns(docs))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose toxicity score is under 0.5; the classifier learns from the stage's own input."""
    model = toxicity.fit(spark, docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(spark, docs, model, out=SCORE, predicted=PREDICTED)
    return scored.where(F.col(PREDICTED) == 0).select(*_columns(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each near-duplicate class: the one with the smallest id, then the first as read.

    Rows are told apart by a key of their own, so rows that share an id, or have none, are
    deduplicated by their texts like all others (a row without an id stays only if none of its
    class has one).
    """
    keyed = written(spark, docs.withColumn(KEY, F.monotonically_increasing_id()), "keyed_documents")
    classes = simhash_dedup.near_duplicates(spark, keyed, id_col=KEY).select(F.col(f"`{KEY}`").alias("k"), "component_id")
    ids = keyed.select(F.col(KEY).alias("key"), F.col("doc_id").alias("id"))
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "key")
    first = classes.join(ids, F.col("k") == F.col("key")).groupBy("component_id").agg(F.min(rank).alias("first"))
    kept = first.select(F.col("first.key").alias(KEY))
    return keyed.join(kept, KEY, "left_semi").select(*_columns(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left; the token ids of each piece are in ``ids``."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

#: No SQL: the classifiers are trained, and SQL has no tokenizer; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{i + 1}-{name}")
    return docs
