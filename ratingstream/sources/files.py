"""File sources: the tag-score CSV and the rating text file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import TAG_SCORES


def scan_tag_scores(spark: SparkSession, path: str, schema: StructType = TAG_SCORES) -> DataFrame:
    """Tag-score CSV with a header line and a fixed schema (no inference pass).

    Fields that do not parse become null and are set aside by the vector
    assembly instead of failing the job.
    """
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def scan_rating_lines(spark: SparkSession, path: str) -> DataFrame:
    """The whole rating file as lines (one ``value`` column); each call is one pass over it."""
    return spark.read.text(path)


def count_lines(lines: DataFrame) -> DataFrame:
    return lines.agg(F.count(F.lit(1)).alias("n_lines"))
