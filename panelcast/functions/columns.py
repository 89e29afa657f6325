"""Scalar column builders."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column, epsilon: float = 1e-6) -> Column:
    """``x / (y + epsilon)``: finite when ``y`` is zero."""
    return numerator / (denominator + F.lit(epsilon))


def ratio_or_null(numerator: Column, denominator: Column) -> Column:
    """``x / y`` with null instead of a division error when ``y`` is zero."""
    return numerator / F.nullif(denominator, F.lit(0.0))


def right_closed_bins(value: Column, edges: Sequence[float], labels: Sequence[str]) -> tuple[Column, Column]:
    """Label and position of the bin ``(edges[i], edges[i+1]]`` that holds ``value``.

    Null, and values outside the edges, give null for both.
    """
    if len(edges) != len(labels) + 1 or list(edges) != sorted(edges):
        raise ValueError("need ascending edges, one more than labels")
    label = position = None
    for i, name in enumerate(labels):
        low, high = edges[i], edges[i + 1]
        inside = value.isNotNull()
        if not math.isinf(low):
            inside = inside & (value > F.lit(float(low)))
        if not math.isinf(high):
            inside = inside & (value <= F.lit(float(high)))
        label = F.when(inside, name) if label is None else label.when(inside, name)
        position = F.when(inside, i) if position is None else position.when(inside, i)
    return label, position


def series_label(*keys: str) -> Column:
    """Text key of a series, ``"store | family"``; null if any key is null."""
    parts = []
    for key in keys:
        parts += [F.lit(" | "), F.col(key).cast("string")]
    return F.concat(*parts[1:])


def to_number(value: Column) -> Column:
    """Numeric reading of a column; text that is not a number, and NaN, give null."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def contains_text(text: Column, needle: str) -> Column:
    """Case-insensitive substring test that is false for null."""
    return F.coalesce(F.contains(F.lower(text), F.lit(needle.lower())), F.lit(False))
