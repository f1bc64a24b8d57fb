"""Schemas of the data model (tag scores, rating messages, vectors, model state)."""

from __future__ import annotations

from pyspark.sql import types as T

# Long table of item-tag scores, as the CSV source declares it.
TAG_SCORES = T.StructType(
    [
        T.StructField("movie_id", T.IntegerType(), True),
        T.StructField("tag_id", T.IntegerType(), True),
        T.StructField("relevance", T.FloatType(), True),
    ]
)

# Rating file line: userId,movieId,rating,timestamp (positional, no header).
RATING_LINE = T.StructType([T.StructField("value", T.StringType(), True)])

# Parsed rating.
RATING = T.StructType(
    [
        T.StructField("user_id", T.IntegerType(), True),
        T.StructField("movie_id", T.IntegerType(), True),
        T.StructField("rating", T.FloatType(), True),
    ]
)

# A record as the Kafka source delivers it (the columns we use).
KAFKA_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)

# One dense feature vector per movie.
MOVIE_VECTOR = T.StructType(
    [
        T.StructField("movie_id", T.IntegerType(), False),
        T.StructField("features", T.ArrayType(T.DoubleType(), False), False),
    ]
)

# K-means model state: one row per cluster.
MODEL_STATE = T.StructType(
    [
        T.StructField("cluster", T.IntegerType(), False),
        T.StructField("center", T.ArrayType(T.DoubleType(), False), False),
        T.StructField("weight", T.DoubleType(), False),
    ]
)

# Per-cluster sums of one batch.
CLUSTER_STATS = T.StructType(
    [
        T.StructField("cluster", T.IntegerType(), False),
        T.StructField("n", T.DoubleType(), False),
        T.StructField("total", T.ArrayType(T.DoubleType(), False), False),
    ]
)
