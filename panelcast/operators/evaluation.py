"""Grouped forecast metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.metrics import metric_columns


def grouped_metrics(
    scored: DataFrame,
    by: Sequence[str] = (),
    extra: Sequence[Column] = (),
    null_policy: str = "propagate",
    wape_scale: float = 1.0,
    count: bool = True,
) -> DataFrame:
    """Row count, MAE, RMSE, WAPE and any further aggregates per group, in one aggregation."""
    counted = [F.count("*").alias("count")] if count else []
    metrics = metric_columns(null_policy=null_policy, wape_scale=wape_scale)
    return scored.groupBy(*by).agg(*counted, *metrics, *extra)


def by_origin_and_horizon(scored: DataFrame, date: str = "date") -> DataFrame:
    """MAE, RMSE, WAPE (a fraction) for each forecast origin and horizon."""
    return grouped_metrics(scored.withColumnRenamed(date, "origin"), ["origin", "horizon"])


def overall(scored: DataFrame) -> DataFrame:
    """Metrics pooled over all scored rows."""
    return grouped_metrics(scored)


def horizon_average(per_cell: DataFrame) -> DataFrame:
    """Unweighted mean over the origins of each horizon's metrics: a mean of WAPEs, not a pooled one."""
    return per_cell.groupBy("horizon").agg(
        F.avg("mae").alias("mae"), F.avg("rmse").alias("rmse"), (F.avg("wape") * 100).alias("wape_pct")
    )


def metrics_by_slices(scored: DataFrame, slices: Sequence[Sequence[str]]) -> DataFrame:
    """Several groupings in one scan: one row per slice and group, other group columns null.

    ``slice`` names the grouping, so that a null level is not taken for "all levels".
    """
    names = list(dict.fromkeys(name for part in slices for name in part))
    sets = [[F.col(name) for name in part] for part in slices]
    bits = {"+".join(part) or "all": [name not in part for name in names] for part in slices}
    label = None
    for text, absent in bits.items():
        number = sum(1 << (len(names) - 1 - i) for i, gone in enumerate(absent) if gone)
        test = F.grouping_id(*names) == number
        label = F.when(test, text) if label is None else label.when(test, text)
    return scored.groupingSets(sets, *names).agg(
        label.alias("slice"), F.count("*").alias("count"), *metric_columns()
    )
