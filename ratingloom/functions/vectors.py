"""Row-wise vector expressions over ``array<float|double>`` columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    An expression used inside a lambda is otherwise evaluated again for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(v: Column, epsilon: float = 1e-12) -> Column:
    """``v`` divided by its length; a zero vector stays zero."""

    def scaled(vector: Column) -> Column:
        length = F.greatest(l2_norm(vector), F.lit(epsilon))
        return bind(length, lambda n: F.transform(vector, lambda x: x.cast("double") / n))

    return bind(v, scaled)


def squared_distance(a: Column, b: Column) -> Column:
    terms = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column, epsilon: float = 0.0) -> Column:
    """Cosine similarity; 0 when either vector is zero."""
    scale = l2_norm(a) * l2_norm(b) + F.lit(epsilon)
    return bind(scale, lambda s: F.when(s > 0, dot(a, b) / s).otherwise(F.lit(0.0)))
