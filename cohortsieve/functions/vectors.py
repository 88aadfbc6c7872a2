"""Column functions over embedding arrays, evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: smallest norm a vector is divided by.
NORM_FLOOR = 1e-9


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(_dot(a, a))


def unit(a: Column) -> Column:
    """``a`` scaled to length one; a zero vector stays zero.

    The length is bound outside the scaling, so it is computed once per vector, not once per element.
    """
    measured = F.array(F.struct(a.alias("v"), F.greatest(norm(a), F.lit(NORM_FLOOR)).alias("length")))
    scaled = F.transform(measured, lambda m: F.transform(m["v"], lambda x: x.cast("double") / m["length"]))
    return F.element_at(scaled, 1)


def cosine(a: Column, b: Column) -> Column:
    floor = F.lit(NORM_FLOOR)
    return _dot(a, b) / (F.greatest(norm(a), floor) * F.greatest(norm(b), floor))
