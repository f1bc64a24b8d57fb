"""Column functions over dense vectors held as ``array<float|double>``."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double_via_text(arr) -> Column:
    """Float elements to doubles through their text form.

    The reference formats each float as text and parses the text as a double,
    so 0.1f becomes 0.1 rather than 0.10000000149011612.
    """
    return F.transform(_c(arr), lambda x: x.cast("string").cast("double"))


def to_double(arr) -> Column:
    """Exact widening cast of every element."""
    return _c(arr).cast("array<double>")


def scale(arr, factor) -> Column:
    """Multiply every element by ``factor`` in the element type."""
    f = _c(factor)
    return F.transform(_c(arr), lambda x: x * f)


def format_vector(arr) -> Column:
    """Vector as text without brackets: elements joined by commas."""
    return F.array_join(F.transform(_c(arr), lambda x: x.cast("string")), ",")


def squared_distance(a, b) -> Column:
    """Sum of squared element differences, summed left to right."""
    return F.aggregate(
        F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)),
        F.lit(0.0).cast("double"),
        lambda acc, v: acc + v,
    )


def vector_sum(arr) -> Column:
    return F.aggregate(_c(arr), F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def centers_literal(centers) -> Column:
    """K centres as one ``array<array<double>>`` literal.

    Catalyst folds the nested ``array(...)`` into a single literal, so the
    plan carries one constant instead of K x D expressions.
    """

    def literal(x: float) -> str:
        return f"{float(x)!r}D" if math.isfinite(x) else f"double('{float(x)!r}')"

    inner = ["array(" + ",".join(map(literal, c)) + ")" for c in centers]
    return F.expr("array(" + ",".join(inner) + ")")


def nearest_center(features, centers) -> Column:
    """Index of the nearest centre by squared Euclidean distance; ties go to the lowest index.

    A distance that is no number counts as infinite.
    """
    cs = centers_literal(centers) if isinstance(centers, (list, tuple)) else _c(centers)
    f = _c(features)
    scored = F.transform(
        cs, lambda c, i: F.struct(F.nanvl(squared_distance(f, c), F.lit(float("inf"))).alias("d"), i.alias("i"))
    )
    return F.array_min(scored).getField("i")
