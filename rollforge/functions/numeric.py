"""Numerically stable Column builders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_sigmoid(x: Column) -> Column:
    return F.when(x >= 0, -F.log1p(F.exp(-x))).otherwise(x - F.log1p(F.exp(x)))


def sigmoid(x: Column) -> Column:
    return F.when(x >= 0, 1.0 / (1.0 + F.exp(-x))).otherwise(F.exp(x) / (1.0 + F.exp(x)))


def softplus(x: Column) -> Column:
    return -log_sigmoid(-x)


def clamp(x: Column, low: float | Column | None = None, high: float | Column | None = None) -> Column:
    """Clamp; NULL stays NULL (``greatest``/``least`` alone would skip it)."""
    y = x
    if high is not None:
        y = F.least(y, high if isinstance(high, Column) else F.lit(float(high)))
    if low is not None:
        y = F.greatest(y, low if isinstance(low, Column) else F.lit(float(low)))
    return F.when(x.isNotNull(), y)


# fixed value: largest exponent kept by the capped exponential (float32 range)
EXP_CAP = 88.7228


def capped_exp(x: Column, cap: float = EXP_CAP) -> Column:
    return F.exp(F.least(x, F.lit(cap)))


def k3(ref: Column, new: Column) -> Column:
    """Non-negative KL estimate of one token."""
    d = ref - new
    return F.exp(d) - d - 1.0


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def masked_sum(values: Column, mask: Column) -> Column:
    """Sum of ``values[i]`` where ``mask[i]`` is not 0, inside one row."""
    kept = F.zip_with(values, mask, lambda v, m: F.when(m != 0, v).otherwise(F.lit(0.0)))
    return F.aggregate(kept, F.lit(0.0), lambda a, v: a + v)


def array_total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def mask_count(mask: Column) -> Column:
    return F.aggregate(mask, F.lit(0.0), lambda a, m: a + m)


def bound(values: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """``body`` of a struct of the named values, each computed once a row.

    A lambda over the elements of an array that names a derived column gets that
    column's whole expression, and computes it again for every element.
    """
    return F.get(F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), body), F.lit(0))
