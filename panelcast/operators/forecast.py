"""Forecasts of days whose measure is not known yet."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.config import DirectSpec, FeatureSpec, PanelSpec
from panelcast.operators.direct import at_origins, build_direct


def future_rows(
    featured: DataFrame,
    origin: dt.date,
    direct: DirectSpec = DirectSpec(),
    features: FeatureSpec = FeatureSpec(),
    spec: PanelSpec = PanelSpec(),
    stores: DataFrame | None = None,
    series: DataFrame | None = None,
) -> DataFrame:
    """Rows as the model reads them, one per series and horizon after ``origin``, without a target.

    A series that has no row on the origin day, or too short a history for its features, has no rows.
    """
    rows = build_direct(
        featured, direct, features, spec, at_origins([origin], spec), stores=stores, series=series, need_target=False
    )
    return rows.drop("target")


def answer(
    wanted: DataFrame, forecast: DataFrame, spec: PanelSpec = PanelSpec(), columns: Sequence[str] = ("horizon", "prediction")
) -> DataFrame:
    """Every wanted row (series keys and day) with its forecast.

    ``forecast`` holds one row per series and ``target_date``.  A wanted row whose day is out of
    reach, or whose series is unknown or null, keeps null; repeated rows are all answered.
    """
    found = forecast.select(*spec.keys, F.col("target_date").alias(spec.date), *columns)
    return wanted.drop(*columns).join(found, [*spec.keys, spec.date], "left")
