"""Rating text → typed rows, with bad rows set aside instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import RATING_MESSAGE, SEPARATOR, field, first_field, java_float, split_fields, strict_int

REJECT_COL = "reject_reason"


def project_value(records: DataFrame, value_col: str = "value") -> DataFrame:
    """Keep only the message value, as text (Kafka delivers it as bytes)."""
    return records.select(F.col(value_col).cast("string").alias("value"))


def _reject_reason(value: Column) -> Column:
    """Why a line is not a rating; the split-based check, run for bad lines only."""
    fields = split_fields(value)
    return (
        F.when(value.isNull(), F.lit("null_value"))
        .when(F.size(fields) != 3, F.lit("field_count"))
        .when(strict_int(field(fields, 0)).isNull(), F.lit("user_id"))
        .when(strict_int(field(fields, 1)).isNull(), F.lit("movie_id"))
        .when(java_float(field(fields, 2)).isNull(), F.lit("rating"))
        .otherwise(F.lit("rating"))
    )


def parse_rating(
    lines: DataFrame,
    value_col: str = "value",
    keep: list[str] | tuple[str, ...] = (),
    on_error: str = "quarantine",
) -> DataFrame:
    """``user,movie,rating`` text → ``user_id INT, movie_id INT, rating FLOAT``.

    Every input row comes out once, with ``reject_reason`` null for a good row.
    Split with :func:`accepted` / :func:`quarantined`. With ``on_error="fail"``
    the first bad row fails the task, as the reference's parse does.

    A good line is recognised by one whole-line pattern; the field-by-field
    diagnosis only runs for lines that fail it.
    """
    if on_error not in ("quarantine", "fail"):
        raise ValueError("on_error must be 'quarantine' or 'fail'")
    columns = [F.col(c) for c in keep]
    staged = lines.select(*columns, F.col(value_col).cast("string").alias("_v"))
    v = F.col("_v")
    # one pattern match decides the shape; the fields then come from a plain
    # split, and Spark's float cast trims and reads suffixes like Java's does
    staged = staged.select(*columns, "_v", F.split(v, SEPARATOR, 4).alias("_f"))
    f = F.col("_f")
    read = F.struct(
        v.rlike(RATING_MESSAGE).alias("_shape"),
        F.get(f, 0).try_cast("int").alias("_u"),
        F.get(f, 1).try_cast("int").alias("_m"),
        F.get(f, 2).try_cast("float").alias("_r"),
    )
    # Bound once, as the one row of a generator: a filter on what was read is a filter on its columns, where
    # a projection's expressions would be copied into the filter below it and evaluated again.
    staged = staged.select(*columns, "_v", F.inline(F.array(read)))
    ok = F.col("_shape") & F.col("_u").isNotNull() & F.col("_m").isNotNull() & F.col("_r").isNotNull()
    staged = staged.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    ok = F.col("_ok")
    reason = F.when(ok, F.lit(None).cast("string")).otherwise(_reject_reason(F.col("_v")))
    if on_error == "fail":
        reason = F.when(
            ~ok,
            F.raise_error(
                F.concat(F.lit("bad rating line ("), reason, F.lit("): "), F.coalesce(F.col("_v"), F.lit("null")))
            ),
        ).cast("string")
    return staged.select(
        *[F.col(c) for c in keep],
        F.when(ok, F.col("_u")).alias("user_id"),
        F.when(ok, F.col("_m")).alias("movie_id"),
        F.when(ok, F.col("_r")).alias("rating"),
        reason.alias(REJECT_COL),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(REJECT_COL).isNull()).drop(REJECT_COL)


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(REJECT_COL).isNotNull())


def reject_bad_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Publisher-side check: only the first field (user id) must be an int.

    Adds ``user_id`` (null for a rejected line) and ``rejected`` (boolean).
    """
    user = strict_int(first_field(F.col(value_col)))
    return lines.withColumn("user_id", user).withColumn("rejected", user.isNull())


def user_parity_key(user_id="user_id", partitions: int = 2) -> Column:
    """Key and partition number of a rating: ``user_id`` modulo ``partitions`` (never negative)."""
    c = F.col(user_id) if isinstance(user_id, str) else user_id
    return F.pmod(c, F.lit(partitions)).cast("int")


def rekey_by_movie(ratings: DataFrame) -> DataFrame:
    """``(movie_id, user_id, rating)`` ordering used for the join with movie vectors."""
    return ratings.select("movie_id", "user_id", "rating")


def stamp_time(df: DataFrame, col: str = "timestamp") -> DataFrame:
    """Attach the current time (one value per query, as Spark evaluates it)."""
    return df.withColumn(col, F.current_timestamp())
