"""The direct multi-horizon dataset: one row per (series, origin day, horizon)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.config import DirectSpec, FeatureSpec, PanelSpec, SplitSpec
from panelcast.operators.enrich import add_store_attributes
from panelcast.operators.features import value_of_day
from panelcast.operators.panel import series_window


def series_dimension(series: DataFrame, stores: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """One row per series: its keys and the attributes of its store.

    Narrow enough to be moved by store for the join and by series afterwards; no measure travels
    with it.
    """
    return add_store_attributes(series.select(*spec.keys).distinct(), stores)


def build_direct(
    featured: DataFrame,
    direct: DirectSpec = DirectSpec(),
    features: FeatureSpec = FeatureSpec(),
    spec: PanelSpec = PanelSpec(),
    origins: Column | None = None,
    target_columns: Sequence[str] = (),
    extra_columns: Sequence[str] = (),
    stores: DataFrame | None = None,
    series: DataFrame | None = None,
    need_target: bool = True,
) -> DataFrame:
    """Stack all horizons in a single pass over the featured panel.

    Every value a horizon needs sits a fixed number of rows from the origin: the target ``h`` rows
    ahead, lag ``k`` of the target ``k - h`` rows behind.  Each distance is a column of the one
    window by series that the features are computed in as well, and the horizons are stacked from
    those columns, so the panel is read once, sorted once, and no row is joined to its own series.
    Rows of ``origin_features`` hold only origins, with the values of the days around them; rows of
    ``array_features`` hold their series' arrays, from which the horizons are read by place.
    A lag shorter than its horizon would look past the origin, so it is null there.

    ``origins`` is a condition on the origin row, applied before the horizons are stacked.
    ``target_columns`` are read at the target row as ``target_<name>``; ``extra_columns`` are
    carried from the origin row.  Rows without a target or without a defined lag or feature
    are left out, as are rows without a series key; ``need_target=False`` keeps rows whose target
    lies after the panel's last day.

    ``stores`` adds the store attributes: they are joined to the series, one row each, and that
    narrow table is joined to the placed rows, so measures move by series once.  ``series`` names the
    series (rows with the keys, repeated or not); without it they are taken from ``featured``.
    """
    lags, window = direct.aligned_lags, series_window(spec)
    value = F.col(spec.value)
    back = sorted({k - h for k in lags for h in direct.horizons if h <= k})
    ahead = F.struct(value, *target_columns)
    distances = {f"_ahead_{h}": F.lead(ahead, h).over(window) for h in direct.horizons}
    distances |= {f"_back_{d}": F.lag(value, d).over(window) if d else value for d in back}
    by_day, by_place = ("_days" in featured.columns, "_place" in featured.columns)
    rows = featured if by_day or by_place else featured.withColumns(distances)
    for key in spec.keys:
        rows = rows.where(F.col(key).isNotNull())
    if origins is not None:
        rows = rows.where(origins)
    attributes = [c for c in direct.static_columns if c in featured.columns]
    if stores is not None:
        dimension = series_dimension(featured if series is None else series, stores, spec)
        attributes = [c for c in direct.static_columns if c in dimension.columns]
        rows = rows.join(dimension.select(*spec.keys, *attributes), list(spec.keys), "left")

    def at_horizon(h: int) -> Column:
        missing = F.lit(None).cast(featured.schema[spec.value].dataType)
        return F.struct(
            F.lit(h).alias("horizon"),
            F.col(f"_ahead_{h}").getField(spec.value).alias("target"),
            *[(F.col(f"_back_{k - h}") if h <= k else missing).alias(f"lag_{k}") for k in lags],
            *[F.col(f"_ahead_{h}").getField(c).alias(f"target_{c}") for c in target_columns],
        )

    # what must be known at the origin does not depend on the horizon
    known = F.lit(True)
    for name in features.origin_columns:
        known = known & F.col(name).isNotNull()
    carried = [*spec.keys, *attributes, spec.date, value.alias("origin_sales"), *features.origin_columns, *extra_columns]
    rows = rows.where(known)
    if by_day:
        around = ["_days", "_first", "_last", "_zero"]
        each = rows.select(*carried, *around, F.explode(F.array(*[F.lit(h) for h in direct.horizons])).alias("horizon"))
        of_target = lambda k: value_of_day(F.date_add(spec.date, F.col("horizon") - k))
        looked_up = {"target": of_target(0).getField(spec.value)}
        looked_up |= {f"lag_{k}": F.when(F.col("horizon") <= k, of_target(k).getField(spec.value)) for k in lags}
        looked_up |= {f"target_{c}": of_target(0).getField(c) for c in target_columns}
        stacked = each.withColumns(looked_up).drop(*around)
    elif by_place:
        measures = dict.fromkeys([spec.value, *target_columns])
        around = ["_place", *[f"_all_{c}" for c in measures]]
        each = rows.select(*carried, *around, F.explode(F.array(*[F.lit(h) for h in direct.horizons])).alias("horizon"))
        of_target = lambda c, k: F.get(f"_all_{c}", F.col("_place") + F.col("horizon") - k)
        looked_up = {"target": of_target(spec.value, 0)}
        looked_up |= {f"lag_{k}": F.when(F.col("horizon") <= k, of_target(spec.value, k)) for k in lags}
        looked_up |= {f"target_{c}": of_target(c, 0) for c in target_columns}
        stacked = each.withColumns(looked_up).drop(*around)
    else:
        stacked = rows.select(*carried, F.inline(F.array(*[at_horizon(h) for h in direct.horizons])))

    complete = F.col("target").isNotNull() if need_target else F.lit(True)
    for k in lags:
        complete = complete & (F.col(f"lag_{k}").isNotNull() | (F.col("horizon") > k))
    target_date = F.date_add(spec.date, F.col("horizon"))
    return (
        stacked.where(complete)
        .withColumn("target_date", target_date)
        .withColumns({"day_of_week": F.weekday("target_date"), "month": F.month("target_date")})
    )


def in_training(split: SplitSpec = SplitSpec(), spec: PanelSpec = PanelSpec()) -> Column:
    """Origins within the history years before the split date."""
    return F.col(spec.date).between(F.lit(split.train_start), F.lit(split.train_end))


def at_origins(origins: Sequence[dt.date], spec: PanelSpec = PanelSpec()) -> Column:
    return F.col(spec.date).isin([F.lit(o) for o in origins])


def training_rows(direct: DataFrame, split: SplitSpec = SplitSpec(), spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Training slice; with ``purge_horizon`` no target lies after the training period."""
    rows = direct.where(in_training(split, spec))
    return rows.where(F.col("target_date") <= F.lit(split.train_end)) if split.purge_horizon else rows


def validation_rows(direct: DataFrame, split: SplitSpec = SplitSpec(), spec: PanelSpec = PanelSpec()) -> DataFrame:
    return direct.where(at_origins(split.validation_origins, spec))


def tail_slices(
    direct: DataFrame, tail_threshold: float, split: SplitSpec = SplitSpec(), spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """Row counts of the high-volume part of the training period and of the main origins, in one scan."""
    tail = direct.where(F.col("target") > F.lit(float(tail_threshold)))
    return tail.agg(
        F.count_if(in_training(split, spec)).alias("tail_train_rows"),
        F.count_if(at_origins(split.baseline_origins, spec)).alias("tail_valid_rows"),
    )


def overlap_audit(direct: DataFrame, split: SplitSpec = SplitSpec(), spec: PanelSpec = PanelSpec()) -> DataFrame:
    """How far training and validation rows share origins or target days."""
    train, valid = in_training(split, spec), at_origins(split.validation_origins, spec)
    return direct.agg(
        F.count_if(train).alias("train_rows"),
        F.count_if(valid).alias("validation_rows"),
        F.count_if(train & valid).alias("shared_rows"),
        F.count_if(train & (F.col("target_date") > F.lit(split.train_end))).alias("train_targets_after_split"),
    )


def split_overlap(
    training: DataFrame, validation: DataFrame, split: SplitSpec = SplitSpec(), spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """The same audit for the two slices of a run: training rows at validation origins are shared rows."""
    validation_rows_total = validation.agg(F.count("*")).scalar()
    return training.agg(
        F.count("*").alias("train_rows"),
        F.count_if(at_origins(split.validation_origins, spec)).alias("shared_rows"),
        F.count_if(F.col("target_date") > F.lit(split.train_end)).alias("train_targets_after_split"),
    ).withColumn("validation_rows", validation_rows_total)
