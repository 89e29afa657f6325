"""From raw facts to a dense daily panel."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.config import PanelSpec


def series_window(spec: PanelSpec = PanelSpec()) -> Window:
    """Rows of one series in day order.

    A series has one row per day, so a window partition is bounded by the length of the
    calendar however many facts a hot series has: ``daily_panel`` folds them first.
    """
    return Window.partitionBy(*spec.keys).orderBy(spec.date)


def by_series(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Place each series in one of the session's shuffle partitions.

    The windows need this exchange anyway.  Naming the number keeps adaptive execution from
    merging partitions by their size before the calendar is filled and the horizons are
    stacked, which multiply the rows many times over without another exchange.
    """
    conf = df.sparkSession.conf
    default = conf.get("spark.sql.shuffle.partitions")
    partitions = int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", default))
    return df.repartition(partitions, *spec.keys)


def daily_panel(
    facts: DataFrame,
    keys: Mapping[str, Column],
    date: Column,
    measures: Mapping[str, Column],
    spec: PanelSpec = PanelSpec(),
) -> DataFrame:
    """Fold facts to one row per (series, day).

    The aggregation is partial on the map side and shuffles by series *and* day, so a
    series that owns a large share of the facts is spread over its days.
    """
    groups = [column.alias(name) for name, column in keys.items()] + [date.alias(spec.date)]
    return facts.groupBy(*groups).agg(*[agg.alias(name) for name, agg in measures.items()])


def stretch_rows(
    reach: DataFrame,
    panel: DataFrame,
    zero_columns: Sequence[str] = ("sales",),
    held: Sequence[str] = (),
    spec: PanelSpec = PanelSpec(),
) -> DataFrame:
    """The rows of ``panel`` repeated for every day from ``_from`` to ``_to`` of ``reach``.

    On added days ``zero_columns`` are zero and other columns null.  ``held`` columns keep their
    value on the days after their row.
    """
    days = reach.withColumn("_day", F.explode(F.sequence("_from", "_to")))
    day = F.col(spec.date)
    real = F.col("_day") == day

    def column(name: str) -> Column:
        if name == spec.date:
            return F.col("_day").alias(name)
        if name in spec.keys:
            return F.col(name)
        kept = F.when(F.col("_day") >= day if name in held else real, F.col(name))
        if name in zero_columns:
            kept = kept.otherwise(F.lit(0).cast(panel.schema[name].dataType))
        return kept.alias(name)

    return days.select(*[column(name) for name in panel.columns])


def densify_calendar(
    panel: DataFrame,
    start: dt.date,
    end: dt.date,
    zero_columns: Sequence[str] = ("sales",),
    spec: PanelSpec = PanelSpec(),
    kept: tuple[dt.date, dt.date] | None = None,
    held: Sequence[str] = (),
    placed: bool = False,
) -> DataFrame:
    """One row per series for every day of ``[start, end]``; missing days get zeros.

    Each row is stretched up to the day before the next one, so the calendar is neither
    crossed with the series nor joined to them: one shuffle by series, which the feature
    windows then reuse.  Two rows of one series and day are an error: fold them first.  Columns outside ``zero_columns`` are null on added days.

    ``kept`` leaves out the days outside of it, but no series.  ``held`` columns keep their value
    up to the next row.  Rows that ``by_series`` has ``placed`` are not moved again.
    """
    day, series = F.col(spec.date), series_window(spec)
    first = F.lag(day).over(series).isNull()
    within = panel.where(day.between(F.lit(start), F.lit(end)))
    reach = (within if placed else by_series(within, spec)).withColumns(
        {
            "_from": F.when(first, F.lit(start)).otherwise(day),
            "_to": F.coalesce(F.date_sub(F.lead(day).over(series), 1), F.lit(end)),
        }
    )
    # a sequence would count backwards between two rows of one day
    repeated = F.raise_error(F.concat(F.lit("a series has several rows for "), day.cast("string"))).cast("date")
    reach = reach.withColumn("_to", F.when(F.col("_to") < F.col("_from"), repeated).otherwise(F.col("_to")))
    if kept is not None:
        clipped = {"_from": F.greatest("_from", F.lit(kept[0])), "_to": F.least("_to", F.lit(kept[1]))}
        reach = reach.withColumns(clipped).where(F.col("_from") <= F.col("_to"))
    return stretch_rows(reach, panel, zero_columns, held, spec)
