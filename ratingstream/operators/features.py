"""Movie feature vectors: long tag scores → dense vectors, and the rating join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import scale, to_double_via_text

# Bytes per row besides the vector payload, for the broadcast size check.
_ROW_OVERHEAD_BYTES = 64


def _finite(col: str) -> Column:
    """False for null, NaN and infinite numbers."""
    return F.coalesce(F.abs(F.col(col)) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(col)


def tag_score_rejects(scores: DataFrame, dim: int) -> DataFrame:
    """Rows the vector assembly cannot use: a null field, a relevance that is no finite number, a tag outside ``1..dim``.

    One NaN in a vector would make every distance to a centre it moved NaN, for good.
    """
    bad = (
        F.col("movie_id").isNull()
        | F.col("tag_id").isNull()
        | ~_finite("relevance")
        | (F.col("tag_id") < 1)
        | (F.col("tag_id") > dim)
    )
    return scores.where(bad)


def assemble_tag_vectors(scores: DataFrame, dim: int, on_error: str = "quarantine") -> DataFrame:
    """Pivot ``(movie_id, tag_id, relevance)`` into one dense ``array<float>`` per movie.

    Position ``tag_id - 1`` holds the relevance; a missing tag is 0. A repeated
    ``(movie_id, tag_id)`` keeps the largest relevance (deterministic). Rows with
    nulls, non-finite scores or out-of-range tags are left out (see :func:`tag_score_rejects`), or
    fail the job with ``on_error="fail"``.

    Plan: a partial+final ``max`` on ``(movie, tag)`` collapses duplicates before
    the shuffle, then a per-movie ``collect_list`` holds at most ``dim`` entries.
    """
    in_range = (
        F.col("movie_id").isNotNull()
        & F.col("tag_id").isNotNull()
        & _finite("relevance")
        & F.col("tag_id").between(1, dim)
    )
    if on_error == "fail":
        scores = scores.withColumn(
            "relevance",
            F.when(in_range, F.col("relevance")).otherwise(
                F.raise_error(F.lit(f"tag score outside 1..{dim}, null or not finite")).cast("float")
            ),
        )
    elif on_error == "quarantine":
        scores = scores.where(in_range)
    else:
        raise ValueError("on_error must be 'quarantine' or 'fail'")

    per_tag = scores.groupBy("movie_id", "tag_id").agg(F.max("relevance").alias("relevance"))
    per_movie = per_tag.groupBy("movie_id").agg(
        F.collect_list(F.struct("tag_id", F.lit(0).alias("filler"), "relevance")).alias("entries")
    )
    # Tags are unique and within 1..dim here, so a full entry list only needs
    # sorting. A list with gaps gets a zero filler for every tag, sorted so a
    # real entry comes just before its filler; the first entry of each tag is
    # kept. Both are O(dim log dim) per movie.
    fillers = F.transform(
        F.sequence(F.lit(1), F.lit(dim)),
        lambda i: F.struct(i.alias("tag_id"), F.lit(1).alias("filler"), F.lit(0.0).cast("float").alias("relevance")),
    )
    with_all = per_movie.select(
        "movie_id",
        F.array_sort(
            F.when(F.size("entries") == dim, F.col("entries")).otherwise(F.concat("entries", fillers))
        ).alias("entries"),
    )
    entries = F.col("entries")
    first_of_tag = F.filter(
        entries,
        lambda e, k: (k == 0) | (F.element_at(entries, k)["tag_id"] != e["tag_id"]),
    )
    return with_all.select(
        F.col("movie_id").cast("int").alias("movie_id"),
        F.transform(
            F.when(F.size("entries") == dim, entries).otherwise(first_of_tag), lambda e: e["relevance"]
        ).alias("scores"),
    )


def array_to_features(vectors: DataFrame, src: str = "scores", dst: str = "features") -> DataFrame:
    """Float scores → double features through text, once per movie."""
    return vectors.withColumn(dst, to_double_via_text(src))


def scale_features(df: DataFrame, by: str = "rating", src: str = "scores", dst: str = "features") -> DataFrame:
    """Scores times the rating (float arithmetic), then to double through text.

    This is the evident intent of the reference; its code discards the product,
    which is the default behaviour of the pipeline (``scale_by_rating=False``).
    """
    return df.withColumn(dst, to_double_via_text(scale(src, F.col(by))))


def vector_bytes(dim: int, columns: list[tuple[str, str]] | None = None) -> int:
    """Bytes of a row whose array columns (name, type) hold ``dim`` elements each; one double array by default."""
    if columns is None:
        return dim * 8 + _ROW_OVERHEAD_BYTES
    widths = {"array<float>": 4, "array<double>": 8}
    return sum(dim * widths[t] for _, t in columns if t in widths) + _ROW_OVERHEAD_BYTES


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], hot_rows: int, salts: int = 32) -> DataFrame:
    """Inner join of a table with hot keys to one with few rows per key.

    Keys of which ``left`` has more than ``hot_rows`` rows (there are at most rows /
    ``hot_rows`` of them) are split: their rows are dealt over ``salts`` parts, and the
    matching rows of ``right`` are copied to each. Other keys join as they are.
    """
    hot = left.groupBy(*keys).count().where(F.col("count") > hot_rows).select(*keys, F.lit(True).alias("_hot"))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns if c not in keys] or [F.lit(0)]), F.lit(salts)).cast("int")
    one = F.when(F.col("_hot"), spread).otherwise(F.lit(0))
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    dealt = left.join(F.broadcast(hot), keys, "left").withColumn("_salt", one).drop("_hot")
    copied = right.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(every)).drop("_hot")
    return dealt.join(copied, [*keys, "_salt"], "inner").drop("_salt")


def join_ratings_features(
    ratings: DataFrame,
    vectors: DataFrame,
    n_vectors: int | None = None,
    dim: int | None = None,
    broadcast_limit_bytes: int = 256 * 1024 * 1024,
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """Inner equi-join of ratings with movie vectors on ``movie_id``.

    Ratings without a vector are dropped; repeated ratings keep their
    multiplicity. The vector side is broadcast when ``n_vectors * row size`` (all its
    array columns counted) is within the limit (both must be given); otherwise both sides are
    shuffled, with movies of more than ``hot_rows`` ratings split.
    """
    if n_vectors is not None and dim is not None:
        if n_vectors * vector_bytes(dim, vectors.dtypes) <= broadcast_limit_bytes:
            return ratings.join(F.broadcast(vectors), "movie_id", "inner")
        return salted_join(ratings, vectors, ["movie_id"], hot_rows)
    return ratings.join(vectors, "movie_id", "inner")


def label_points(joined: DataFrame, features: str = "features") -> DataFrame:
    """Labelled point: the user id as a double label next to the features."""
    return joined.withColumn("label", F.col("user_id").cast("double")).select(
        "label", *[c for c in joined.columns if c != "label"]
    )


def project_features(df: DataFrame, features: str = "features") -> DataFrame:
    return df.select(features)


def sample_threshold(fraction: float) -> str:
    """Eight hex digits: an md5 prefix below this keeps the row."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie in [0, 1]")
    return format(min(int(round(fraction * 16**8)), 16**8 - 1), "08x") if fraction < 1 else "g"


def sample_rows(
    df: DataFrame,
    fraction: float,
    seed: int | None = None,
    key_cols: list[str] | tuple[str, ...] | None = None,
) -> DataFrame:
    """Bernoulli sample without replacement.

    With ``key_cols`` the decision is a hash of the key (and seed): the same
    rows are kept on every run and on replay, and an SQL engine with ``md5``
    can reproduce it. Without it, Spark's ``sample`` (seeded) is used.
    """
    if not key_cols:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    parts = ([F.lit(str(seed))] if seed is not None else []) + [F.col(c).cast("string") for c in key_cols]
    h = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8)
    return df.where(h < F.lit(sample_threshold(fraction)))
