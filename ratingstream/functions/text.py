"""Column functions for the comma-separated rating text.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The field separator of rating lines and messages, and the
# accepted spellings of numbers (a Java-style integer, and a Java-style float:
# decimal with optional exponent or hexadecimal with a binary exponent,
# optional f/F/d/D suffix, NaN and Infinity).
SEPARATOR = ","
INT_PATTERN = r"^[+-]?[0-9]+\z"
FLOAT_PATTERN = (
    r"^[+-]?(NaN|Infinity|(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    r"|0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+)[fFdD]?)\z"
)
# A whole good rating message: user id, movie id, rating (blanks and control
# chars around it, optional f/F/d/D suffix), then nothing but trailing commas.
RATING_MESSAGE = (
    r"^([+-]?[0-9]+),([+-]?[0-9]+),[\x00-\x20]*"
    r"([+-]?(?:NaN|Infinity|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
    r"|0[xX](?:[0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+))"
    r"[fFdD]?[\x00-\x20]*,*\z"
)
# Java's String.trim removes every char up to and including the space.
_EDGE_CONTROL = r"^[\x00-\x20]+|[\x00-\x20]+\z"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_fields(value) -> Column:
    """Split on commas the way Java's ``String.split(",")`` does.

    Trailing empty fields are dropped; a text made only of commas gives an
    empty array; a text without a comma gives a one-element array.
    """
    v = _c(value)
    trimmed = F.regexp_replace(v, ",+\\z", "")
    return (
        F.when(v.rlike("^,+\\z"), F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, SEPARATOR, -1))
    )


def field(fields: Column, i: int) -> Column:
    """0-based field, null when absent (ANSI-safe)."""
    return F.get(fields, i)


def strict_int(text) -> Column:
    """Integer parse with no surrounding blanks allowed; null when invalid or out of range."""
    t = _c(text)
    return F.when(t.rlike(INT_PATTERN), t.try_cast("int"))


def java_float(text) -> Column:
    """Float parse that trims control chars and blanks and accepts a type suffix."""
    t = F.regexp_replace(_c(text), _EDGE_CONTROL, "")
    body = F.regexp_replace(t, "[fFdD]\\z", "")
    unsigned = F.regexp_replace(body, r"^[+-]", "")
    negative = body.startswith("-")
    special = (
        F.when(unsigned == "NaN", F.lit(float("nan")).cast("float"))
        .when((unsigned == "Infinity") & negative, F.lit(float("-inf")).cast("float"))
        .when(unsigned == "Infinity", F.lit(float("inf")).cast("float"))
    )
    return F.when(t.rlike(FLOAT_PATTERN), F.coalesce(special, body.try_cast("float")))


def first_field(value) -> Column:
    """Text before the first comma (Java's ``split(",")(0)``; empty when there is none)."""
    return F.substring_index(_c(value), SEPARATOR, 1)


def drop_last_field(value) -> Column:
    """Remove the last comma-separated field and join the rest back with commas.

    Same as Java's ``split(",").dropRight(1).mkString(",")``: trailing empty
    fields go first, then the last remaining field with its comma.
    """
    s = F.rtrim(_c(value), F.lit(SEPARATOR))
    last = F.substring_index(s, SEPARATOR, -1)
    return F.substring(s, F.lit(1), F.length(s) - F.length(last) - F.lit(1))


def encode_int_key(c) -> Column:
    """A 32-bit int as 4 big-endian bytes (what an integer key serializer writes)."""
    return F.unhex(F.lpad(F.right(F.hex(_c(c).cast("bigint")), F.lit(8)), 8, "0"))


def decode_int_key(b) -> Column:
    """Inverse of :func:`encode_int_key` for 4-byte keys."""
    h = F.hex(_c(b))
    u = F.conv(h, 16, 10).cast("bigint")
    return F.when(F.length(h) == 8, F.when(u >= 2**31, u - 2**32).otherwise(u).cast("int"))
