"""Reference-shaped inputs derived from the given tables.

The reference reads a tag-score CSV and a rating file / rating topic. The
test tables hold neither, so these plans derive them from ``embeddings``,
``lineitem`` and ``events``, in Spark, growing with the tables:

* ratings:     events → ``user_id``, ``event_id % 600`` as movie, ``value`` as rating
* messages:    ``user,movie,rating`` text; an ``error`` event carries its
               ``props`` text in the rating field, which the parse rejects
* file lines:  the message plus the event's epoch seconds
* records:     Kafka-shaped rows (key, value, topic, partition, offset, timestamp)
* tag scores:  ``embeddings`` exploded to ``(vec_id, position+1, element)``;
               ``lineitem`` as ``(l_partkey, l_linenumber, l_discount)`` gives
               gaps and duplicate keys
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import encode_int_key
from ..operators.parse import user_parity_key
from ..session import is_complete, scratch_path

# Fixed fixture values: movie ids are event ids modulo 600, the topic name,
# the number of topic partitions (user parity), and one user in SKEW in the short partition.
MOVIE_ID_MODULUS = 600
TOPIC = "ratings"
PARTITIONS = 2
SKEW = 11


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def epoch_micros(df: DataFrame, col: str = "ts"):
    """Microseconds since 1970-01-01 of a wall-clock timestamp, whatever the session time zone.

    The tables store time stamps without a zone; Spark may read them as
    TIMESTAMP_NTZ (the default) or as TIMESTAMP taken as UTC.
    """
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)")
    return F.unix_micros(F.col(col))


def event_time(df: DataFrame, col: str = "ts"):
    """The event time as an instant (TIMESTAMP), zone-independent."""
    return F.timestamp_micros(epoch_micros(df, col))


def epoch_day(ts_col) -> "F.Column":
    """Days since 1970-01-01 (UTC) of a TIMESTAMP column: the model batch of a record."""
    c = F.col(ts_col) if isinstance(ts_col, str) else ts_col
    return F.floor(F.unix_seconds(c) / F.lit(86400)).cast("int")


def ratings_from_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("msg_id"),
        F.col("user_id").cast("int").alias("user_id"),
        F.pmod(F.col("event_id"), F.lit(MOVIE_ID_MODULUS)).cast("int").alias("movie_id"),
        F.col("value").cast("float").alias("rating"),
        event_time(events).alias("ts"),
    )


def message_text(events: DataFrame) -> DataFrame:
    """``msg_id, ts, user_id, value`` with value = ``user,movie,rating`` text."""
    rating_text = F.when(F.col("event_type") == "error", F.col("props")).otherwise(
        F.col("value").cast("string")
    )
    value = F.concat_ws(
        ",",
        F.col("user_id").cast("string"),
        F.pmod(F.col("event_id"), F.lit(MOVIE_ID_MODULUS)).cast("string"),
        rating_text,
    )
    return events.select(
        F.col("event_id").alias("msg_id"), event_time(events).alias("ts"), F.col("user_id"), value.alias("value")
    )


def rating_file_lines(events: DataFrame) -> DataFrame:
    """``userId,movieId,rating,timestamp`` lines (timestamp in epoch seconds)."""
    m = message_text(events)
    return m.select(
        "msg_id",
        F.concat_ws(",", F.col("value"), F.unix_seconds(F.col("ts")).cast("string")).alias("value"),
    )


def kafka_records(events: DataFrame, topic: str = TOPIC, partitions: int = PARTITIONS) -> DataFrame:
    """What the rating topic would hold: keyed by user parity, offset = event id."""
    m = message_text(events)
    part = user_parity_key(F.col("user_id"), partitions)
    return m.select(
        encode_int_key(part).alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        part.alias("partition"),
        F.col("msg_id").cast("long").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def skewed_records(events: DataFrame, topic: str = TOPIC) -> DataFrame:
    """The records in two partitions of which one is about ten times as long: every eleventh user's are in partition 1."""
    r = kafka_records(events, topic).drop("partition", "offset", "key")
    part = F.when(F.pmod(F.regexp_extract(F.col("value").cast("string"), "^([0-9]+),", 1).cast("int"), F.lit(SKEW)) == 0, 1).otherwise(0)
    return r.withColumn("partition", part.cast("int")).withColumn("key", encode_int_key("partition"))


def tag_scores_from_embeddings(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(
        F.col("vec_id").cast("int").alias("movie_id"), F.posexplode("embedding").alias("pos", "relevance")
    ).select(
        "movie_id",
        (F.col("pos") + 1).cast("int").alias("tag_id"),
        F.col("relevance").cast("float").alias("relevance"),
    )


def tag_scores_from_lineitem(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_partkey").cast("int").alias("movie_id"),
        F.col("l_linenumber").cast("int").alias("tag_id"),
        F.col("l_discount").cast("float").alias("relevance"),
    )


def embedding_dim(embeddings: DataFrame) -> int:
    return int(embeddings.agg(F.max(F.size("embedding"))).first()[0])


def sparse_dim(lineitem: DataFrame) -> int:
    return int(lineitem.agg(F.max("l_linenumber")).first()[0])


def _fixture_dir(spark: SparkSession, sf_dir: str, name: str) -> str:
    tag = hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:12]
    return scratch_path(spark, "fixtures", tag, name)


def tag_scores_csv(spark: SparkSession, sf_dir: str) -> str:
    """Write the embedding tag scores once as a CSV with a header; return its folder."""
    path = _fixture_dir(spark, sf_dir, "tag_scores_csv")
    if not is_complete(spark, path):
        df = tag_scores_from_embeddings(table(spark, sf_dir, "embeddings"))
        df.write.mode("overwrite").option("header", True).csv(path)
    return path


def rating_lines_text(spark: SparkSession, sf_dir: str) -> str:
    """Write the rating file lines once as text; return its folder."""
    path = _fixture_dir(spark, sf_dir, "rating_lines_txt")
    if not is_complete(spark, path):
        rating_file_lines(table(spark, sf_dir, "events")).select("value").write.mode("overwrite").text(path)
    return path
