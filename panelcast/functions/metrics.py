"""Forecast error columns and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.columns import ratio_or_null


def error_columns(df: DataFrame, target: str = "target", prediction: str = "prediction") -> DataFrame:
    """Add ``error`` (prediction - target), ``absolute_error`` and ``prediction_ratio``."""
    error = F.col(prediction) - F.col(target)
    return df.withColumns(
        {
            "error": error,
            "absolute_error": F.abs(error),
            "prediction_ratio": ratio_or_null(F.col(prediction), F.col(target)),
        }
    )


def metric_columns(
    target: str = "target",
    prediction: str = "prediction",
    null_policy: str = "propagate",
    wape_scale: float = 1.0,
) -> list[Column]:
    """MAE, RMSE, WAPE and the number of rows without an error, as aggregates.

    ``null_policy="propagate"`` makes the metrics of a group null as soon as one
    of its rows lacks a target or a prediction; ``"skip"`` leaves such rows out.
    WAPE is null when the actuals sum to zero.
    """
    if null_policy not in ("propagate", "skip"):
        raise ValueError(f"unknown null policy {null_policy!r}")
    actual, error = F.col(target), F.col(prediction) - F.col(target)
    missing = F.count_if(error.isNull())
    magnitude = F.abs(error)
    scored_actual = F.when(error.isNotNull(), F.abs(actual))
    mae = F.avg(magnitude)
    rmse = F.sqrt(F.avg(error * error))
    wape = ratio_or_null(F.sum(magnitude), F.sum(scored_actual)) * F.lit(wape_scale)
    if null_policy == "propagate":
        mae, rmse, wape = (F.when(missing == 0, m) for m in (mae, rmse, wape))
    return [mae.alias("mae"), rmse.alias("rmse"), wape.alias("wape"), missing.alias("n_null")]


def bias_columns(error: str = "error") -> list[Column]:
    """Mean signed error and the direction it points to."""
    mean = F.avg(error)
    direction = F.when(mean < 0, "under").when(mean > 0, "over").when(mean == 0, "none")
    return [mean.alias("mean_error"), direction.alias("direction")]
