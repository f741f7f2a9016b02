"""Expressions over ``ARRAY<FLOAT|DOUBLE>`` vectors."""

from pyspark.sql import Column, functions as F

# Fixed value: guard against zero vectors.
EPSILON = 1e-8


def norm(vector: Column) -> Column:
    squares = F.aggregate(
        vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    return F.sqrt(squares)


def normalized(vector: Column, epsilon: float = EPSILON) -> Column:
    """Row-wise L2 normalisation.

    Vector and length are bound by one-element arrays: an expression inside a lambda is evaluated for every component.
    """
    def scaled(v: Column) -> Column:
        return F.element_at(F.transform(F.array(norm(v) + F.lit(epsilon)), lambda n: F.transform(v, lambda x: x.cast("double") / n)), 1)

    return F.element_at(F.transform(F.array(vector), scaled), 1)


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
