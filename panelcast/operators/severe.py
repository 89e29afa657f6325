"""Severe under-predictions within the tail: where they sit and what their history looks like."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.config import HISTORY_WORDS, DiagnosticsSpec
from panelcast.functions.columns import ratio_or_null, series_label, to_number
from panelcast.functions.quantiles import exact_quantiles
from panelcast.operators.tail import smallest


def is_severe(spec: DiagnosticsSpec = DiagnosticsSpec()) -> Column:
    return F.coalesce(F.col("prediction_ratio") < F.lit(spec.severe_ratio), F.lit(False))


def is_well_predicted(spec: DiagnosticsSpec = DiagnosticsSpec()) -> Column:
    return F.coalesce(F.col("prediction_ratio").between(F.lit(spec.well_low), F.lit(spec.well_high)), F.lit(False))


def severe_rows(tail: DataFrame, spec: DiagnosticsSpec = DiagnosticsSpec()) -> DataFrame:
    return tail.where(is_severe(spec))


def severe_overview(tail: DataFrame, spec: DiagnosticsSpec = DiagnosticsSpec()) -> DataFrame:
    """Tail rows, severe rows and severe percent (null without tail rows): one row."""
    return tail.agg(
        F.count("*").alias("tail_rows"), F.count_if(is_severe(spec)).alias("severe_rows")
    ).withColumn("severe_rate", ratio_or_null(F.col("severe_rows") * 100.0, F.col("tail_rows").cast("double")))


def severe_by(tail: DataFrame, by: Sequence[str | Column], spec: DiagnosticsSpec = DiagnosticsSpec()) -> DataFrame:
    """Severe and tail counts, severe percent, and the severe rows' mean ratio and error, per group.

    One aggregation; groups without severe rows do not appear.
    """
    severe = is_severe(spec)
    return (
        tail.groupBy(*by)
        .agg(
            F.count_if(severe).alias("severe_count"),
            F.count("*").alias("tail_count"),
            (F.count_if(severe) * 100.0 / F.count("*")).alias("severe_rate"),
            F.avg(F.when(severe, F.col("prediction_ratio"))).alias("mean_ratio"),
            F.avg(F.when(severe, F.col("error"))).alias("mean_error"),
        )
        .where(F.col("severe_count") > 0)
    )


def severe_by_family(tail: DataFrame, spec: DiagnosticsSpec = DiagnosticsSpec()) -> DataFrame:
    return severe_by(tail, ["family"], spec)


def severe_by_store(tail: DataFrame, spec: DiagnosticsSpec = DiagnosticsSpec()) -> DataFrame:
    """The stores with most severe rows."""
    stores = severe_by(tail, ["store_nbr"], spec)
    return stores.orderBy(F.desc("severe_count"), "store_nbr").limit(spec.store_list)


def severe_by_horizon(tail: DataFrame, spec: DiagnosticsSpec = DiagnosticsSpec()) -> DataFrame:
    return severe_by(tail, ["horizon"], spec)


def severe_by_origin(tail: DataFrame, spec: DiagnosticsSpec = DiagnosticsSpec()) -> DataFrame:
    return severe_by(tail, [F.col("date").alias("origin")], spec)


def history_columns(columns: Sequence[str], words: Sequence[str] = HISTORY_WORDS) -> list[str]:
    """The columns whose name contains one of the words."""
    return [c for c in columns if any(word in c.lower() for word in words)]


def population_means(
    rows: DataFrame, features: Sequence[str], populations: dict[str, Column]
) -> DataFrame:
    """Mean of every feature in every population: one aggregation, then one row per feature."""
    means = [
        F.avg(F.when(test, to_number(F.col(f)))).alias(f"_{i}_{name}")
        for i, f in enumerate(features)
        for name, test in populations.items()
    ]
    per_feature = [
        F.struct(
            F.lit(f).alias("feature"),
            *[F.col(f"_{i}_{name}").alias(f"{name}_mean") for name in populations],
        )
        for i, f in enumerate(features)
    ]
    return rows.agg(*means).select(F.inline(F.array(*per_feature)))


def population_medians(
    rows: DataFrame, features: Sequence[str], populations: dict[str, Column]
) -> DataFrame:
    """Exact median of every feature in every population, one row per feature.

    The groups are the listed features times the listed populations, so their number is
    fixed by the caller.
    """
    entries = [
        F.when(
            test & number.isNotNull(),
            F.struct(F.lit(f).alias("feature"), F.lit(name).alias("population"), number.alias("value")),
        )
        for f in features
        for number in [to_number(F.col(f))]
        for name, test in populations.items()
    ]
    stacked = rows.select(F.inline(F.array_compact(F.array(*entries))))
    medians = exact_quantiles(stacked, "value", {"m": 0.5}, by=["feature", "population"], bounded_groups=True)
    return medians.groupBy("feature").agg(
        *[F.max(F.when(F.col("population") == name, F.col("m"))).alias(f"{name}_median") for name in populations]
    )


def history_comparison(
    tail: DataFrame, features: Sequence[str], spec: DiagnosticsSpec = DiagnosticsSpec()
) -> DataFrame:
    """Mean and median of each history feature, severe rows against the whole tail."""
    populations = {"severe": is_severe(spec), "tail": F.lit(True)}
    means = population_means(tail, features, populations)
    medians = population_medians(tail, features, populations)
    return means.join(medians, "feature", "left").select(
        "feature",
        "severe_mean",
        "tail_mean",
        "severe_median",
        "tail_median",
        (F.col("severe_mean") - F.col("tail_mean")).alias("mean_difference"),
        (F.col("severe_median") - F.col("tail_median")).alias("median_difference"),
    )


def worst_severe(tail: DataFrame, spec: DiagnosticsSpec = DiagnosticsSpec()) -> DataFrame:
    return smallest(severe_rows(tail, spec), "prediction_ratio", spec.severe_list)


def well_predicted_rows(tail: DataFrame, spec: DiagnosticsSpec = DiagnosticsSpec()) -> DataFrame:
    return tail.where(is_well_predicted(spec))


def series_counts(tail: DataFrame, spec: DiagnosticsSpec = DiagnosticsSpec()) -> DataFrame:
    """Severe and tail counts of every series that has severe rows."""
    return severe_by(tail, [series_label("store_nbr", "family").alias("series")], spec).select(
        "series", "severe_count", "tail_count", "severe_rate"
    )


def series_concentration(tail: DataFrame, spec: DiagnosticsSpec = DiagnosticsSpec()) -> DataFrame:
    """The series with most severe rows."""
    ranked = series_counts(tail, spec).orderBy(F.desc("severe_count"), F.desc("severe_rate"), "series")
    return ranked.limit(spec.series_list)


def severe_summary(
    tail: DataFrame, features: Sequence[str], spec: DiagnosticsSpec = DiagnosticsSpec()
) -> DataFrame:
    """Severe and well-predicted counts, severe percent, distinct severe series: one row.

    Counting series first keeps the distinct count a plain two-step aggregation.
    """
    per_series = tail.groupBy("store_nbr", "family").agg(
        F.count("*").alias("rows"),
        F.count_if(is_severe(spec)).alias("severe"),
        F.count_if(is_well_predicted(spec)).alias("well"),
    )
    total = lambda name: F.coalesce(F.sum(name), F.lit(0))
    return per_series.agg(
        total("severe").alias("severe_rows"),
        ratio_or_null(F.sum("severe") * 100.0, F.sum("rows").cast("double")).alias("severe_rate"),
        total("well").alias("well_predicted_rows"),
        F.count_if(F.col("severe") > 0).alias("severe_series"),
    ).withColumn("history_features", F.lit(len(history_columns(features))))


def promotion_test(
    tail: DataFrame, spec: DiagnosticsSpec = DiagnosticsSpec(), promotion: str = "target_onpromotion"
) -> DataFrame:
    """Percent of rows on promotion on the target day, severe against well predicted: one row."""
    on = (F.col(promotion) > 0).cast("double") * 100
    severe, well = is_severe(spec), is_well_predicted(spec)
    return tail.agg(
        F.count_if(severe).alias("severe_rows"),
        F.count_if(well).alias("well_rows"),
        F.avg(F.when(severe, on)).alias("severe_promotion_pct"),
        F.avg(F.when(well, on)).alias("well_promotion_pct"),
    )
