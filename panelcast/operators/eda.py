"""Totals and seasonality of the measure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.config import PanelSpec


def daily_total(panel: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Sum over all series per day."""
    return panel.groupBy(spec.date).agg(F.sum(spec.value).alias(spec.value))


def daily_span(daily: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """First day, last day and number of days: one row."""
    return daily.agg(
        F.min(spec.date).alias("first_day"), F.max(spec.date).alias("last_day"), F.count(spec.date).alias("days")
    )


def year_profile(daily: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Daily total by year and day of the year."""
    return daily.select(
        F.year(spec.date).alias("year"), F.dayofyear(spec.date).alias("day_of_year"), F.col(spec.value)
    )


def year_columns(daily: DataFrame, years: list[int], spec: PanelSpec = PanelSpec()) -> DataFrame:
    """The same with one column per listed year."""
    profile = year_profile(daily, spec)
    return profile.groupBy("day_of_year").pivot("year", years).agg(F.sum(spec.value))


def monthly_seasonality(daily: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Mean daily total per calendar month, over all years."""
    return daily.groupBy(F.month(spec.date).alias("month")).agg(F.avg(spec.value).alias("mean_sales"))


def weekly_seasonality(daily: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Mean daily total per weekday, Monday is 0."""
    return daily.groupBy(F.weekday(spec.date).alias("weekday")).agg(F.avg(spec.value).alias("mean_sales"))
