"""Window aggregates over the rows *before* the current one."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def expanding_mean(value: Column, series: WindowSpec, min_rows: int) -> Column:
    """Mean of all earlier rows of ``series``, null while fewer than ``min_rows`` of them are non-null."""
    frame = series.rowsBetween(Window.unboundedPreceding, -1)
    counted = F.count(value).over(frame)
    return F.when(counted >= min_rows, F.sum(value).over(frame) / counted)
