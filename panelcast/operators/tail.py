"""Errors of high-volume rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.config import DiagnosticsSpec
from panelcast.functions.columns import ratio_or_null, right_closed_bins
from panelcast.functions.metrics import error_columns
from panelcast.functions.quantiles import exact_quantiles
from panelcast.operators.evaluation import grouped_metrics

ROW_KEYS = ("store_nbr", "family", "date", "horizon")
LIST_COLUMNS = ("date", "horizon", "store_nbr", "family", "target", "prediction", "error", "prediction_ratio")


def tail_rows(scored: DataFrame, tail_threshold: float) -> DataFrame:
    """Rows whose target exceeds the threshold, with their error columns."""
    return error_columns(scored.where(F.col("target") > F.lit(float(tail_threshold))))


def _slice_extras() -> list[Column]:
    return [F.avg("error").alias("mean_error"), F.avg("prediction_ratio").alias("mean_ratio")]


def tail_overall(tail: DataFrame) -> DataFrame:
    """Row count, MAE, RMSE, WAPE percent, mean and median error: one row."""
    totals = grouped_metrics(tail, extra=[F.avg("error").alias("mean_error")], wape_scale=100.0)
    median = exact_quantiles(tail, "error", {"m": 0.5}).select("m").scalar()
    return totals.withColumn("median_error", median)


def tail_by(tail: DataFrame, by: Sequence[str]) -> DataFrame:
    """Metrics, mean error and mean ratio of the tail per group."""
    return grouped_metrics(tail, by, _slice_extras(), wape_scale=100.0)


def tail_by_horizon(tail: DataFrame) -> DataFrame:
    return tail_by(tail, ["horizon"])


def tail_by_origin(tail: DataFrame, date: str = "date") -> DataFrame:
    return tail_by(tail.withColumnRenamed(date, "origin"), ["origin"])


def spike_severity(tail: DataFrame, spec: DiagnosticsSpec = DiagnosticsSpec()) -> DataFrame:
    """The same per size class of the target; classes without rows do not appear."""
    label, order = right_closed_bins(F.col("target"), spec.spike_edges, spec.spike_labels)
    binned = tail.withColumns({"spike_level": label, "level_order": order}).where(F.col("spike_level").isNotNull())
    return tail_by(binned, ["spike_level", "level_order"])


def smallest(df: DataFrame, column: str, n: int, columns: Sequence[str] = LIST_COLUMNS) -> DataFrame:
    """The ``n`` rows with the smallest value, ties in key order (a distributed top-k)."""
    return df.orderBy(F.col(column).asc_nulls_last(), *ROW_KEYS).limit(n).select(*columns)


def largest_underpredictions(tail: DataFrame, spec: DiagnosticsSpec = DiagnosticsSpec()) -> DataFrame:
    return smallest(tail, "error", spec.tail_list)


def coverage_distribution(tail: DataFrame, spec: DiagnosticsSpec = DiagnosticsSpec()) -> DataFrame:
    """Count and percent of tail rows per class of prediction / target; empty classes stay with 0."""
    label, _ = right_closed_bins(F.col("prediction_ratio"), spec.coverage_edges, spec.coverage_labels)
    counts = [F.count_if(label == name).alias(f"_c{i}") for i, name in enumerate(spec.coverage_labels)]
    rows = [
        F.struct(
            F.lit(i).alias("level_order"), F.lit(name).alias("prediction_coverage"), F.col(f"_c{i}").alias("count")
        )
        for i, name in enumerate(spec.coverage_labels)
    ]
    # one aggregated row holds all classes; classes are a fixed list
    return (
        tail.agg(F.count("*").alias("_rows"), *counts)
        .select("_rows", F.inline(F.array(*rows)))
        .withColumn("percentage", ratio_or_null(F.col("count") * 100.0, F.col("_rows").cast("double")))
        .drop("_rows")
    )


def underprediction_rates(tail: DataFrame, spec: DiagnosticsSpec = DiagnosticsSpec()) -> DataFrame:
    """Percent of tail rows predicted below the target, and below the severe share of it."""
    under = F.coalesce(F.col("prediction") < F.col("target"), F.lit(False))
    severe = F.coalesce(F.col("prediction_ratio") < F.lit(spec.severe_ratio), F.lit(False))
    percent = lambda test: F.avg(test.cast("double")) * 100
    return tail.agg(
        percent(under).alias("underprediction_rate_pct"), percent(severe).alias("severe_underprediction_rate_pct")
    )
