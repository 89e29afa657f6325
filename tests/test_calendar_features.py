"""Features of part of the calendar against those of the whole, on gaps, falls below zero, nulls and short spans."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelcast.config import FeatureSpec, PanelSpec
from panelcast.operators.direct import at_origins, build_direct, in_training
from panelcast.operators.features import _with_dips, add_features, add_rolling, add_spike_counts, add_spikes, calendar_features, origin_features
from panelcast.operators.panel import densify_calendar
from panelcast.plans import warehouse

FIRST, DAYS = dt.date(2020, 1, 1), 460
LAST = FIRST + dt.timedelta(days=DAYS - 1)


def folded(spark, gaps=True):
    """Series that are thin, dense, mostly negative, with nulls, and with one row only."""
    dice = random.Random(7)
    rows = []
    for store, share, low, high in [(1, 0.08, 0, 50), (2, 0.9, 0, 50), (3, 0.92, -9, 2), (4, 0.5, -40, 40), (5, 1.0, 3, 3), (7, 0.9, -5, -4)]:
        for i in range(DAYS):
            if dice.random() < share:
                null = store == 4 and i % 97 == 0
                rows.append((store, "a", FIRST + dt.timedelta(days=i), None if null else float(dice.randint(low, high)) / 4))
    rows += [(6, "a", FIRST + dt.timedelta(days=200), 5.0), (6, None, LAST, 1.0)]
    return spark.createDataFrame(rows, "store_nbr int, family string, date date, sales double")


def exact(rows):
    return [tuple(round(v, 7) if isinstance(v, float) else v for v in row) for row in rows]


def listed(df, columns):
    return exact(df.select(*columns).orderBy(*[F.col(c).asc_nulls_first() for c in ("store_nbr", "family", "date")]).collect())


@pytest.mark.parametrize("span", [None, (LAST - dt.timedelta(days=20), LAST - dt.timedelta(days=16)), (FIRST, FIRST + dt.timedelta(days=60)), (LAST, LAST)])
def test_features_of_a_span_are_those_of_the_whole_calendar(spark, span):
    rows = folded(spark)
    whole = add_features(densify_calendar(rows, FIRST, LAST)).drop("is_spike_day")
    part = calendar_features(rows, FIRST, LAST, span, ahead=15)
    inside = F.lit(True) if span is None else F.col("date").between(F.lit(span[0]), F.lit(span[1]))
    assert sorted(part.columns) == sorted(whole.columns)
    expected = listed(whole.where(inside), whole.columns)
    assert len(expected) == 8 * (DAYS if span is None else (span[1] - span[0]).days + 1)
    assert listed(part.where(inside), whole.columns) == expected


def test_span_fills_only_the_days_it_needs(spark):
    day = LAST - dt.timedelta(days=30)
    ends = calendar_features(folded(spark), FIRST, LAST, (day, day), ahead=15).agg(F.min("date"), F.max("date")).first()
    assert tuple(ends) == (day - dt.timedelta(days=365), day + dt.timedelta(days=15))


def test_missing_days_that_are_spikes_are_counted(spark):
    """After 40 days at -1, a missing day's zero exceeds its limit."""
    rows = [(1, "a", FIRST + dt.timedelta(days=i), -1.0) for i in range(60) if i not in (40, 41)]
    frame = spark.createDataFrame(rows, "store_nbr int, family string, date date, sales double")
    dense = add_spikes(add_rolling(densify_calendar(frame, FIRST, FIRST + dt.timedelta(days=59))))
    expected = dense.agg(F.sum("is_spike_day")).first()[0]
    counted = add_spike_counts(_with_dips(frame, FIRST + dt.timedelta(days=59), ["sales"], FeatureSpec(), PanelSpec()), FIRST)
    assert expected >= 1
    assert counted.agg(F.max("_spikes")).first()[0] == expected


def test_no_row_is_added_without_negative_measures(spark):
    rows = folded(spark).where("store_nbr in (1, 2, 5)")
    assert _with_dips(rows, LAST, ["sales"], FeatureSpec(), PanelSpec()).count() == rows.count()


def test_repeated_day_is_refused(spark):
    rows = folded(spark)
    twice = rows.unionByName(rows.where("store_nbr = 2"))
    with pytest.raises(Exception, match="several rows"):
        calendar_features(twice, FIRST, LAST, (LAST, LAST)).collect()


@pytest.mark.parametrize("windows", [(7, 14, 28), (3, 5, 10), (1, 4), (6, 9)])
def test_joined_windows_equal_plain_frames(spark, make_series, windows):
    dice = random.Random(3)
    values = [None if i == 50 else dice.random() * 1e6 for i in range(120)] + [0.1] * 40
    rows = add_rolling(make_series({(1, "a"): values}), FeatureSpec(windows=windows)).orderBy("date").collect()
    for i, row in enumerate(rows):
        for n in windows:
            window = values[max(i - n, 0):i]
            if len(window) < n or None in window:
                assert row[f"rolling_mean_{n}"] is None and row[f"rolling_std_{n}"] is None
                continue
            mean = sum(window) / n
            assert row[f"rolling_mean_{n}"] == pytest.approx(mean)
            if n == 1:
                assert row["rolling_std_1"] is None
                continue
            deviation = (sum((v - mean) ** 2 for v in window) / (n - 1)) ** 0.5
            assert row[f"rolling_std_{n}"] == pytest.approx(deviation, abs=1e-12 if len(set(window)) == 1 else 1e-7)


def test_only_the_shortest_window_adds_up_rows(spark, make_series):
    plan = add_rolling(make_series({(1, "a"): range(40)}))._jdf.queryExecution().optimizedPlan().toString()
    assert "-7, -1)" in plan and "-14, -1)" not in plan and "-28, -1)" not in plan


def test_direct_rows_of_a_span_are_those_of_all_days(spark, data):
    for origins, span in [
        (at_origins(warehouse.SPLIT.validation_origins), warehouse.VALIDATION_SPAN),
        (in_training(warehouse.SPLIT) & (F.dayofmonth("date") == 3), warehouse.TRAINING_SPAN),
    ]:
        part = warehouse.direct(spark, data, origins, ("onpromotion",), span=span)
        dense = add_features(warehouse.panel(spark, data))
        whole = build_direct(dense, origins=origins, target_columns=("onpromotion",), stores=warehouse.stores(spark, data))
        keys = ["store_nbr", "family", "date", "horizon"]
        assert part.columns == whole.columns
        found, expected = (exact(df.orderBy(*keys).collect()) for df in (part, whole))
        assert len(expected) > 0 and found == expected


ORIGINS = [FIRST, FIRST + dt.timedelta(days=20), LAST - dt.timedelta(days=40), LAST - dt.timedelta(days=16), LAST, LAST + dt.timedelta(days=3)]


def test_origins_have_the_features_of_the_whole_calendar(spark):
    rows = folded(spark)
    whole = add_features(densify_calendar(rows, FIRST, LAST)).drop("is_spike_day").where(at_origins(ORIGINS))
    part = origin_features(rows, FIRST, LAST, ORIGINS, ahead=15)
    expected = listed(whole, whole.columns)
    assert len(expected) == 8 * 5
    assert listed(part, whole.columns) == expected


@pytest.mark.parametrize("need_target", [True, False])
def test_direct_rows_of_origins_are_those_of_the_filled_calendar(spark, need_target):
    rows = folded(spark).withColumn("onpromotion", F.when(F.col("sales") > 1, F.col("store_nbr")))
    dense = add_features(densify_calendar(rows, FIRST, LAST, ["sales", "onpromotion"]))
    options = {"target_columns": ("onpromotion",), "need_target": need_target}
    whole = build_direct(dense, origins=at_origins(ORIGINS), **options)
    part = build_direct(origin_features(rows, FIRST, LAST, ORIGINS, 15, ["sales", "onpromotion"]), **options)
    keys = ["store_nbr", "family", "date", "horizon"]
    assert part.columns == whole.columns
    found, expected = (exact(df.orderBy(*keys).collect()) for df in (part, whole))
    assert len(expected) > 0 and found == expected


def test_origins_do_not_fill_the_calendar(spark):
    """A series keeps its own rows of the days around an origin, and no row is added for the others."""
    day = LAST - dt.timedelta(days=30)
    held = origin_features(folded(spark).where("store_nbr in (1, 6)"), FIRST, LAST, [day], 15).select(F.size("_days")).collect()
    assert len(held) == 3 and max(n for n, in held) < 20


def test_repeated_day_is_refused_at_origins(spark):
    rows = folded(spark)
    with pytest.raises(Exception, match="several rows"):
        origin_features(rows.unionByName(rows.where("store_nbr = 2")), FIRST, LAST, [LAST], 15).collect()
