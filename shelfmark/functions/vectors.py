"""Vector arithmetic on array columns, evaluated in the JVM.

Sums are taken in double. Arrays of different length give NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _total(products: Column) -> Column:
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_total(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in [-1, 1]; NULL when either vector has no length."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def l2_squared(a: Column, b: Column) -> Column:
    """Squared Euclidean distance."""

    def gap(x: Column, y: Column) -> Column:
        return (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))

    return _total(F.zip_with(a, b, gap))


def _scaled_to_one(a: Column, length: Callable[[Column], Column]) -> Column:
    """``a`` by its ``length``; a vector without length becomes zeros.

    Vector and length are each bound to a name by a transform of a single element: inside
    the inner lambda they would be worked out again for every number of the vector.
    """
    bound = F.transform(F.array(a), lambda v: F.struct(v.alias("v"), length(v).alias("length")))

    def divided(s: Column) -> Column:
        return F.transform(
            s["v"], lambda x: F.coalesce(F.try_divide(x.cast("double"), s["length"]), F.lit(0.0)).cast("float")
        )

    return F.transform(bound, divided)[0]


def unit(a: Column) -> Column:
    """The vector scaled to length one; a zero vector stays zero."""
    return _scaled_to_one(a, norm)


def reweight(a: Column, weights: Sequence[float]) -> Column:
    """Scale each dimension by the root of its weight, then renormalise.

    The dot product of two rescaled vectors is the weighted dot product of the
    originals.
    """
    roots = F.array(*[F.lit(float(w) ** 0.5) for w in weights])
    scaled = F.zip_with(a, roots, lambda x, r: x.cast("double") * r)
    return _scaled_to_one(scaled, norm)
