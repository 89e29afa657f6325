import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.operators import enrich
from panelcast.plans import warehouse


@pytest.fixture(scope="module")
def holidays(spark):
    return warehouse.holidays(spark)


@pytest.fixture(scope="module")
def days(spark, holidays):
    """Every holiday-table day and a plain day for four stores."""
    stores = spark.createDataFrame(
        [(3, "CITY_3", "ASIA"), (7, "CITY_7", "EUROPE"), (8, "CITY_3", "AFRICA"), (9, None, None)],
        "store_nbr int, city string, state string",
    )
    plain = spark.sql("SELECT DATE '2001-03-03' AS date")
    return holidays.select("date").union(plain).distinct().crossJoin(stores)


def flagged(df, flag):
    return {(r.date.isoformat(), r.store_nbr) for r in df.where(F.col(flag) == 1).collect()}


def test_holiday_scope(days, holidays):
    result = enrich.add_holiday_flag(days, holidays)
    assert result.count() == days.count()  # two regional rows on one day do not multiply
    every = (3, 7, 8, 9)
    expected = {(d, s) for d in ("2000-12-25", "2001-01-01") for s in every}
    expected |= {("2001-06-05", 3), ("2001-06-12", 3), ("2001-06-12", 8)}
    assert flagged(result, "is_holiday") == expected
    assert set(result.columns) == {*days.columns, "is_holiday"}


def test_events_ignore_locale_case_and_type(days, holidays):
    result = enrich.add_event_flags(days, holidays)
    every = (3, 7, 8, 9)
    assert flagged(result, "is_black_friday") == {("2000-11-24", s) for s in every}
    assert flagged(result, "is_cyber_monday") == {("2000-11-27", s) for s in every}
    assert flagged(result, "is_mothers_day") == {(d, s) for d in ("2001-05-12", "2001-05-13") for s in every}
    nulls = result.select([F.count_if(F.col(c).isNull()).alias(c) for c in enrich.EVENT_TEXTS]).first()
    assert set(nulls) == {0}


def test_store_join_keeps_unknown_stores(spark):
    facts = spark.createDataFrame([(1, 5.0), (2, 6.0)], "store_nbr int, sales double")
    stores = spark.createDataFrame([(1, "Quito", "P", "A", 3)], "store_nbr int, city string, state string, type string, cluster int")
    rows = {r.store_nbr: r for r in enrich.add_store_attributes(facts, stores).collect()}
    assert rows[1].store_type == "A" and rows[1].store_cluster == 3 and rows[2].store_type is None


def test_weekday_starts_on_monday(spark):
    row = enrich.add_calendar(spark.sql("SELECT DATE '2017-06-30' AS date")).first()
    assert (row.day_of_week, row.month) == (4, 6)
    assert dt.date(2017, 6, 30).weekday() == 4


def test_one_join_for_all_flags(spark, data):
    from panelcast.plans import catalog, warehouse

    plan = catalog.queries()["flag_audit"](spark, data)._jdf.queryExecution().executedPlan().toString()
    # stores with their nations and regions, the stores' own, and one for the calendar
    stores = warehouse.stores(spark, data)._jdf.queryExecution().executedPlan().toString()
    joins = lambda text: sum(text.count(j) for j in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin"))
    assert joins(plan) == joins(stores) + 2


def test_calendar_dimension(spark):
    rows = [
        ("2020-01-01", "Holiday", "Regional", "P", "a", False), ("2020-01-01", "Holiday", "Regional", "P", "b", False),
        ("2020-01-01", "Holiday", "Local", "Q", None, False), ("2020-01-02", "Holiday", "National", "E", "Black Friday x", True),
        ("2020-01-03", None, None, None, None, None), ("2020-01-04", "Holiday", "National", "E", "x", None),
    ]
    holidays = spark.createDataFrame(rows, "d string, type string, locale string, locale_name string, description string, transferred boolean")
    holidays = holidays.withColumn("date", F.to_date("d")).drop("d")
    days = {str(r.date): r for r in enrich.calendar_dimension(holidays).collect()}
    assert len(days) == 4 and days["2020-01-01"]._states == ["P"] and days["2020-01-01"]._cities == ["Q"]
    assert not any(r._national for r in days.values()) and days["2020-01-02"]._is_black_friday == 1
    panel = spark.sql("SELECT date_add(DATE'2020-01-01', CAST(i AS INT)) AS date, s AS state, c AS city FROM VALUES ('P', 'Z'), (NULL, 'Q'), (NULL, NULL) AS t(s, c), range(6) AS r(i)")
    found = enrich.add_day_flags(panel, holidays)
    assert {(r.state, r.city) for r in found.where("is_holiday = 1").collect()} == {("P", "Z"), (None, "Q")}
    assert found.where("is_black_friday = 1").count() == 3 and found.count() == 18
    assert found.where("is_holiday IS NULL OR is_mothers_day IS NULL").count() == 0
