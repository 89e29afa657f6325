"""Store attributes and calendar flags.

No join carries a hint, so Spark's own size check decides.  Tables of any size work.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.columns import contains_text

# Texts in a holiday's description that mark a known event.
EVENT_TEXTS = {
    "is_black_friday": "Black Friday",
    "is_cyber_monday": "Cyber Monday",
    "is_mothers_day": "Dia de la Madre",
}
CALENDAR_FLAGS = ("is_holiday", *EVENT_TEXTS)


def store_attributes(stores: DataFrame) -> DataFrame:
    """The store table with ``type`` and ``cluster`` as ``store_type`` and ``store_cluster``."""
    return stores.withColumnsRenamed({"type": "store_type", "cluster": "store_cluster"})


def add_store_attributes(df: DataFrame, stores: DataFrame) -> DataFrame:
    """Left join of the store attributes on ``store_nbr``; the run-time size of the stores decides how."""
    return df.join(store_attributes(stores), "store_nbr", "left")


def calendar_dimension(holidays: DataFrame, events: Mapping[str, str] = EVENT_TEXTS) -> DataFrame:
    """One row per day that any entry names: ``date``, ``_national``, ``_states``, ``_cities`` and a flag per event.

    A day's states and cities are few, so they travel as arrays and a panel row needs one look-up
    for all of its flags.
    """
    observed = {
        locale: (F.col("type") == "Holiday") & (F.col("locale") == locale) & (F.col("transferred") == F.lit(False))
        for locale in ("National", "Regional", "Local")
    }
    return holidays.groupBy("date").agg(
        F.coalesce(F.bool_or(observed["National"]), F.lit(False)).alias("_national"),
        F.collect_set(F.when(observed["Regional"], F.col("locale_name"))).alias("_states"),
        F.collect_set(F.when(observed["Local"], F.col("locale_name"))).alias("_cities"),
        *[
            F.coalesce(F.max(contains_text(F.col("description"), text).cast("int")), F.lit(0)).alias(f"_{flag}")
            for flag, text in events.items()
        ],
    )


def add_day_flags(
    df: DataFrame, holidays: DataFrame, events: Mapping[str, str] = EVENT_TEXTS, holiday: bool = True
) -> DataFrame:
    """``is_holiday`` and one 0/1 flag per event, from one join with the calendar's days.

    A holiday is national for every store, regional by ``state``, local by ``city``; an event's
    text occurs in any description of the day.
    """
    joined = df.join(calendar_dimension(holidays, events), "date", "left")
    flags = {flag: F.coalesce(F.col(f"_{flag}"), F.lit(0)) for flag in events}
    if holiday:
        free = [F.col("_national"), F.array_contains("_states", F.col("state")), F.array_contains("_cities", F.col("city"))]
        flags = {"is_holiday": F.greatest(*[F.coalesce(f, F.lit(False)).cast("int") for f in free])} | flags
    return joined.withColumns(flags).drop("_national", "_states", "_cities", *[f"_{flag}" for flag in events])


def add_holiday_flag(df: DataFrame, holidays: DataFrame) -> DataFrame:
    """``is_holiday``: national for every store, regional by ``state``, local by ``city``."""
    return add_day_flags(df, holidays, {})


def add_event_flags(
    df: DataFrame, holidays: DataFrame, events: Mapping[str, str] = EVENT_TEXTS
) -> DataFrame:
    """One 0/1 flag per event whose text occurs in any description of the day; same for all stores."""
    return add_day_flags(df, holidays, events, holiday=False)


def add_calendar(df: DataFrame, date: str = "date") -> DataFrame:
    """Weekday (Monday is 0) and month of ``date``."""
    return df.withColumns({"day_of_week": F.weekday(date), "month": F.month(date)})


def enrich(df: DataFrame, stores: DataFrame, holidays: DataFrame) -> DataFrame:
    """Store attributes, the four calendar flags, weekday and month."""
    joined = add_store_attributes(df, stores)
    return add_calendar(add_day_flags(joined, holidays))
