"""Properties that only matter on large or uneven data, checked on plans and on small skewed input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.operators import baselines, direct, features, panel, severe, tail
from panelcast.plans import catalog, warehouse

SINGLE_PASS = [
    "panel", "holiday_flags", "spike_features", "direct_h7", "direct_all_summary", "seasonal_forecast", "tail_coverage",
    "severe_summary", "series_concentration", "worst_predictions", "eval_slices", "sample_fixed",
]


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SINGLE_PASS)
def test_no_cross_join_and_no_python_worker(spark, data, name):
    plan = physical(catalog.queries()[name](spark, data))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan


def test_scan_reads_only_needed_columns(spark, data):
    plan = physical(warehouse.panel(spark, data).select("store_nbr", "family", "date", "sales"))
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "l_shipdate" in scan and "l_extendedprice" not in scan and "l_discount" not in scan


@pytest.mark.parametrize("name", ["tail_largest_under", "worst_predictions", "sample_fixed", "severe_by_store"])
def test_top_lists_are_not_full_sorts(spark, data, name):
    assert "TakeOrderedAndProject" in physical(catalog.CHECKED[name](spark, data))


def test_hot_series_is_folded_before_the_windows(spark):
    """One series owns a third of the facts; the panel still has one row per series and day."""
    facts = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(1 + F.col("id") % 200).cast("int").alias("store"),
        F.lit("a").alias("family"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 450).cast("int")).alias("day"),
        (F.col("id") % 11).cast("double").alias("q"),
    )
    folded = panel.daily_panel(
        facts, {"store_nbr": F.col("store"), "family": F.col("family")}, F.col("day"), {"sales": F.sum("q")}
    )
    end = dt.date(2020, 1, 1) + dt.timedelta(days=449)
    dense = panel.densify_calendar(folded, dt.date(2020, 1, 1), end).cache()
    sizes = dense.groupBy("store_nbr").count()
    assert sizes.agg(F.min("count"), F.max("count")).first() == (450, 450)
    assert dense.agg(F.sum("sales")).first()[0] == facts.agg(F.sum("q")).first()[0]
    # the partial aggregation comes before the first exchange
    plan = physical(folded)
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning")
    rows = direct.build_direct(features.add_features(dense))
    assert rows.where("horizon = 1").count() == 201 * (450 - 365 - 1)


def test_hot_group_in_diagnostics(spark):
    """One store owns a third of the scored rows; counts and top lists stay whole."""
    scored = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500 + 2).cast("int").alias("store_nbr"),
        F.lit("a").alias("family"),
        F.lit(dt.date(2020, 1, 1)).alias("date"),
        (F.col("id") % 15 + 1).cast("int").alias("horizon"),
        (F.col("id") % 100 + 10).cast("double").alias("target"),
        (F.col("id") % 37).cast("double").alias("prediction"),
    )
    rows = tail.tail_rows(scored, 10)
    stores = severe.severe_by_store(rows).collect()
    expected = rows.where("store_nbr = 1 and prediction / target < 0.5").count()
    assert stores[0].store_nbr == 1 and stores[0].severe_count == expected
    whole = tail.tail_overall(rows).first()
    exact = rows.agg(F.median("error"), F.avg(F.abs("error"))).first()
    assert (whole.median_error, whole.mae) == (exact[0], pytest.approx(exact[1]))


def test_many_origins_read_history_once(spark, data):
    origins = [dt.date(2001, 5, 1) + dt.timedelta(days=i) for i in range(20)]
    history = warehouse.panel(spark, data)
    plan = physical(baselines.last_per_weekday(history, origins))
    assert plan.count("FileScan parquet") == 1
    assert baselines.weekly_seasonal_naive(history, origins).count() == 20 * 15 * history.select(
        "store_nbr", "family"
    ).distinct().count()


@pytest.mark.parametrize("name", ["direct_h1", "direct_h15", "direct_all_summary", "set_sizes"])
def test_days_of_the_calendar_are_not_moved_sorted_or_joined(spark, data, name):
    """Windows, sorts and joins of direct rows see folded rows or series; their days come from the series' arrays."""
    plan = catalog.CHECKED[name](spark, data)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    unfolded = next(i for i, line in enumerate(plan) if "Generate explode" in line and "_place#" in line)
    assert unfolded > 1
    for line in plan[:unfolded]:
        assert not any(f"{operator} " in line for operator in ("Window", "Sort", "Join", "RepartitionByExpression"))
