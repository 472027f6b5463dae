"""Column functions over ``array<float>`` vectors, summed in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def inner_product(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def squared_l2(a: Column, b: Column) -> Column:
    """Squared Euclidean distance."""

    def diff(x, y):
        return x.cast("double") - y.cast("double")

    return _total(F.zip_with(a, b, lambda x, y: diff(x, y) * diff(x, y)))


def norm(v: Column) -> Column:
    return F.sqrt(_total(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))


def l2_normalize(v: Column) -> Column:
    """Unit-length vector; the zero vector stays as it is."""
    scaled = F.element_at(
        F.transform(
            F.array(norm(v)),
            lambda n: F.transform(
                v, lambda x: F.when(n > 0, (x.cast("double") / n).cast("float")).otherwise(x)
            ),
        ),
        1,
    )
    return scaled
