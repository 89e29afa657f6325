"""A demand panel from the order-and-shipment tables: supplier x return flag x ship day.

Each supplier is a store, so stores, series and panel rows grow with the data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from panelcast.config import INF, DiagnosticsSpec, DirectSpec, PanelSpec, SplitSpec
from panelcast.operators.direct import at_origins, build_direct, in_training, series_dimension, training_rows
from panelcast.operators.features import add_features, array_features, origin_features, series_arrays
from panelcast.operators.forecast import future_rows
from panelcast.operators.panel import daily_panel, densify_calendar
from panelcast.operators.tail import tail_rows
from panelcast.sources.sinks import materialize

SPLIT = SplitSpec(
    split_date=dt.date(2001, 6, 1),
    history_years=1,
    baseline_origins=(dt.date(2001, 5, 31), dt.date(2001, 6, 15), dt.date(2001, 6, 30)),
    extra_origins=(dt.date(2001, 6, 10),),
)
PANEL = PanelSpec()
PURGED_SPLIT = replace(SPLIT, purge_horizon=True)

DIAGNOSTICS = DiagnosticsSpec(
    tail_threshold=20,
    spike_edges=(20, 30, 40, 60, 100, INF),
    spike_labels=("20-30", "30-40", "40-60", "60-100", ">100"),
    level_edges=(-INF, 0, 10, 25, 50, 100, INF),
    level_labels=("0", "0 < sales <= 10", "10 < sales <= 25", "25 < sales <= 50", "50 < sales <= 100", "> 100"),
    sample_size=3000,
)

# One row per rule of the holiday logic.
HOLIDAYS = """
  ('2000-12-25', 'Holiday',    'National', 'ALL',    'Navidad',              FALSE),
  ('2000-12-26', 'Additional', 'National', 'ALL',    'Navidad+1',            FALSE),
  ('2001-01-01', 'Holiday',    'National', 'ALL',    'Primer dia del ano',   FALSE),
  ('2001-05-24', 'Holiday',    'National', 'ALL',    'Batalla',              TRUE),
  ('2001-05-25', 'Transfer',   'National', 'ALL',    'Traslado Batalla',     FALSE),
  ('2001-06-05', 'Holiday',    'Regional', 'ASIA',   'Provincializacion',    FALSE),
  ('2001-06-05', 'Holiday',    'Regional', 'ASIA',   'Provincializacion II', FALSE),
  ('2001-06-12', 'Holiday',    'Local',    'CITY_3', 'Fundacion',            FALSE),
  ('2001-06-13', 'Holiday',    'Local',    'CITY_7', 'Fundacion',            TRUE),
  ('2000-11-24', 'Event',      'National', 'ALL',    'Black Friday',         FALSE),
  ('2000-11-27', 'Event',      'National', 'ALL',    'Cyber Monday',         FALSE),
  ('2001-05-12', 'Event',      'National', 'ALL',    'dia de la madre-1',    FALSE),
  ('2001-05-13', 'Event',      'National', 'ALL',    'Dia de la Madre',      FALSE),
  ('2001-06-20', 'Bridge',     'National', 'ALL',    NULL,                   FALSE),
  ('2001-06-23', 'Work Day',   'National', 'ALL',    'Recupero',             FALSE)
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def facts(spark: SparkSession, folder: str) -> DataFrame:
    """One row per series and day with shipments, before the calendar is filled."""
    return daily_panel(
        table(spark, folder, "lineitem"),
        keys={"store_nbr": F.col("l_suppkey"), "family": F.col("l_returnflag")},
        date=F.col("l_shipdate").cast("date"),
        measures={"sales": F.sum("l_quantity"), "onpromotion": F.count_if(F.col("l_discount") >= 0.05)},
    )


def _dense(folded: DataFrame, ends: Row) -> DataFrame:
    return densify_calendar(folded, ends.first, ends.last, zero_columns=("sales", "onpromotion"))


def panel(spark: SparkSession, folder: str) -> DataFrame:
    """The dense panel from the first to the last ship day: store_nbr, family, date, sales, onpromotion."""
    shipped = table(spark, folder, "lineitem")
    # two numbers, read from the column's statistics or its one scan
    day = F.col("l_shipdate").cast("date")
    return _dense(facts(spark, folder), shipped.agg(F.min(day).alias("first"), F.max(day).alias("last")).first())


def stores(spark: SparkSession, folder: str) -> DataFrame:
    town = F.col("s_nationkey") % 10
    letter = F.when(town % 3 == 0, "A").when(town % 3 == 1, "B").otherwise("C")
    suppliers, nations, regions = (table(spark, folder, n) for n in ("supplier", "nation", "region"))
    return (
        suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("store_nbr"),
            F.concat(F.lit("CITY_"), town.cast("string")).alias("city"),
            F.col("r_name").alias("state"),
            letter.alias("type"),
            (town % 4 + 1).alias("cluster"),
        )
    )


def holidays(spark: SparkSession) -> DataFrame:
    return spark.sql(
        "SELECT CAST(d AS DATE) AS date, type, locale, locale_name, description, transferred "
        f"FROM (VALUES {HOLIDAYS}) AS t(d, type, locale, locale_name, description, transferred)"
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per day and customer nation."""
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("o_orderdate").cast("date").alias("date"), F.col("c_nationkey").alias("store_nbr"))
        .agg(F.count("*").alias("transactions"))
    )


def featured(spark: SparkSession, folder: str) -> DataFrame:
    return add_features(panel(spark, folder))


Span = tuple[dt.date, dt.date]
TRAINING_SPAN: Span = (SPLIT.train_start, SPLIT.train_end)
VALIDATION_SPAN: Span = (min(SPLIT.validation_origins), max(SPLIT.validation_origins))
BOTH_SPAN: Span = (min(TRAINING_SPAN[0], VALIDATION_SPAN[0]), max(TRAINING_SPAN[1], VALIDATION_SPAN[1]))


def folded_facts(spark: SparkSession, folder: str) -> tuple[DataFrame, Row]:
    """The folded shipments as a written table, and the ends of their calendar."""
    folded = materialize(facts(spark, folder), "facts")
    return folded, folded.agg(F.min("date").alias("first"), F.max("date").alias("last")).first()


def _calendar_features(folded: DataFrame, ends: Row, span: Span | None, stores: DataFrame) -> DataFrame:
    """The features of the days of ``span``, with the series' attributes and its arrays beside them."""
    dimension = series_dimension(folded, stores)
    if ends.first is None:
        # no day at all
        return add_features(_dense(folded, ends)).join(dimension, list(PANEL.keys), "left")
    measures = ("sales", "onpromotion")
    days = (ends.first, ends.last) if span is None else (max(ends.first, span[0]), min(ends.last, span[1]))
    series = series_arrays(folded, ends.first, ends.last, measures, attributes=dimension)
    return array_features(series, ends.first, days, measures)


def _origin_features(folded: DataFrame, ends: Row, days: Sequence[dt.date], spec: DirectSpec = DirectSpec()) -> DataFrame:
    if ends.first is None:
        return add_features(_dense(folded, ends))
    return origin_features(folded, ends.first, ends.last, days, max(spec.horizons), ("sales", "onpromotion"))


def direct(
    spark: SparkSession, folder: str, origins: Column | None = None, target_columns: Sequence[str] = (),
    spec: DirectSpec = DirectSpec(), span: Span | None = None, days: Sequence[dt.date] | None = None,
    read: tuple[DataFrame, Row] | None = None,
) -> DataFrame:
    """Direct rows with store attributes.

    The shipments are read once, to fold them; the folded rows are written, and the ends of the
    calendar, the series' arrays and the list of series all come from them.  ``span`` holds the first
    and the last day that ``origins`` asks for: only their rows are made.
    ``days`` are a few origins instead: the calendar is not filled at all.  ``read`` is what
    ``folded_facts`` gave, for callers that build several frames from it.
    """
    folded, ends = folded_facts(spark, folder) if read is None else read
    if days is not None:
        rows = _origin_features(folded, ends, days, spec)
        return build_direct(
            rows, spec, origins=at_origins(days), target_columns=target_columns, stores=stores(spark, folder), series=folded
        )
    if span is not None:
        origins = F.col("date").between(*[F.lit(d) for d in span]) & (F.lit(True) if origins is None else origins)
    return build_direct(
        _calendar_features(folded, ends, span, stores(spark, folder)), spec, origins=origins, target_columns=target_columns
    )


def future(spark: SparkSession, folder: str) -> DataFrame:
    """Direct rows from the panel's last day on, whose targets are not known."""
    folded, ends = folded_facts(spark, folder)
    return future_rows(_origin_features(folded, ends, [ends.last]), ends.last, stores=stores(spark, folder), series=folded)


def validation(spark: SparkSession, folder: str, target_columns: Sequence[str] = ()) -> DataFrame:
    return direct(spark, folder, target_columns=target_columns, days=SPLIT.validation_origins)


def stand_in_forecast(rows: DataFrame) -> DataFrame:
    """A deterministic forecast for the diagnostics: recent level or the value four weeks before the target."""
    return rows.withColumn("prediction", F.greatest("rolling_mean_28", "lag_28"))


def scored(spark: SparkSession, folder: str, target_columns: Sequence[str] = ()) -> DataFrame:
    return stand_in_forecast(validation(spark, folder, target_columns))


def tail(spark: SparkSession, folder: str, target_columns: Sequence[str] = ()) -> DataFrame:
    return tail_rows(scored(spark, folder, target_columns), DIAGNOSTICS.tail_threshold)


def scored_table(spark: SparkSession, folder: str) -> DataFrame:
    """The scored rows as a written table, for queries that read them several times."""
    return materialize(scored(spark, folder), "scored")


def tail_table(spark: SparkSession, folder: str) -> DataFrame:
    return tail_rows(scored_table(spark, folder), DIAGNOSTICS.tail_threshold)


def training(spark: SparkSession, folder: str) -> DataFrame:
    return training_rows(direct(spark, folder, in_training(SPLIT), span=TRAINING_SPAN), SPLIT)


def training_table(spark: SparkSession, folder: str, columns: Sequence[str] = ("*",)) -> DataFrame:
    """The training rows as a written table, for those who read them many times."""
    return materialize(training(spark, folder).select(*columns), "training")
