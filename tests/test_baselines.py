import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelcast.config import DirectSpec
from panelcast.operators import baselines, evaluation

START = dt.date(2020, 1, 1)


def test_weekly_naive_repeats_last_weekday(make_series):
    panel = make_series({(1, "a"): range(60)})
    origins = [START + dt.timedelta(days=30), START + dt.timedelta(days=40)]
    rows = baselines.weekly_seasonal_naive(panel, origins).collect()
    assert len(rows) == 2 * 15
    for r in rows:
        i, h = (r.origin - START).days, r.horizon
        assert r.target == i + h
        assert r.prediction == i + h - 7 * ((h - 1) // 7 + 1)


def test_weekly_naive_skips_null_and_missing_history(make_series):
    values = [float(i) for i in range(30)]
    values[16] = None  # the same weekday as the origin plus seven
    panel = make_series({(1, "a"): values, (2, "b"): [1.0] * 30}).where("store_nbr = 1 or date >= '2020-01-23'")
    origin = START + dt.timedelta(days=22)
    rows = {(r.store_nbr, r.horizon): r for r in baselines.weekly_seasonal_naive(panel, [origin], DirectSpec(horizons=(1, 2, 3))).collect()}
    assert rows[1, 1].prediction == 9.0  # day 16 is null, so day 9
    assert rows[1, 2].prediction == 17.0
    # series 2 has only the origin day itself before the targets
    assert {rows[2, h].prediction for h in (1, 2, 3)} == {None}
    cells = baselines.score_cells(baselines.weekly_seasonal_naive(panel, [origin], DirectSpec(horizons=(1, 2))))
    assert all(r.mae is None and r.n_null == 1 for r in cells.collect())


def test_history_may_end_before_the_origin(make_series):
    panel = make_series({(1, "a"): range(20)}).where("date <> '2020-01-15'")
    rows = baselines.last_per_weekday(panel, [dt.date(2020, 1, 17)]).collect()
    assert {r.day_of_week: r.prediction for r in rows}[2] == 7.0  # Wednesday 15 is missing, so Wednesday 8
    assert len(rows) == 7


def test_common_population_and_comparison(spark):
    day = dt.date(2020, 1, 1)
    schema = "store_nbr int, origin date, horizon int, target double, prediction double"
    one = spark.createDataFrame([(1, day, 1, 10.0, 8.0), (2, day, 1, 10.0, 0.0)], schema)
    two = spark.createDataFrame([(1, day, 1, 10.0, 9.0), (3, day, 1, 10.0, 10.0)], schema)
    common = baselines.on_common_population({"one": one, "two": two}, ["store_nbr", "origin", "horizon"])
    assert [f.count() for f in common.values()] == [1, 1]
    cells = {name: baselines.score_cells(f) for name, f in common.items()}
    rows = {r.model: r for r in baselines.compare_models(cells, "two").collect()}
    assert rows["one"].average_wape == pytest.approx(0.2)
    assert rows["one"].reduction_pct == pytest.approx(50) and rows["two"].reduction_pct == pytest.approx(0)


def test_horizon_average_is_unweighted(spark):
    rows = [(1, "o1", 1, 10.0, 5.0), (1, "o2", 1, 1000.0, 1000.0)]
    scored = spark.createDataFrame(rows, "store_nbr int, date string, horizon int, target double, prediction double")
    average = evaluation.horizon_average(evaluation.by_origin_and_horizon(scored)).first()
    assert average.wape_pct == pytest.approx(25)
    assert evaluation.overall(scored).first().wape == pytest.approx(5 / 1010)


def test_slices_in_one_scan(spark):
    rows = [(h, f, 10.0 * h, 9.0 * h) for h in (1, 2) for f in ("a", None)]
    scored = spark.createDataFrame(rows, "horizon int, family string, target double, prediction double")
    table = evaluation.metrics_by_slices(scored, [["horizon"], ["family"], ["horizon", "family"], []])
    counts = {r.slice: r.n for r in table.groupBy("slice").agg(F.count("*").alias("n")).collect()}
    assert counts == {"horizon": 2, "family": 2, "horizon+family": 4, "all": 1}
    assert {r.wape for r in table.select(F.round("wape", 9).alias("wape")).collect()} == {0.1}


def per_origin(panel, origins):
    """The same look-up written as one max_by per origin."""
    known = F.col("sales").isNotNull()
    lasts = [F.max_by("sales", F.when(known & (F.col("date") <= F.lit(o)), F.col("date"))).alias(f"o{i}") for i, o in enumerate(origins)]
    wide = panel.groupBy("store_nbr", "family", F.weekday("date").alias("day_of_week")).agg(*lasts)
    rows = F.array(*[F.struct(F.lit(o).alias("origin"), F.col(f"o{i}").alias("prediction")) for i, o in enumerate(origins)])
    return wide.select("store_nbr", "family", "day_of_week", F.inline(rows)).where("prediction IS NOT NULL")


def test_many_origins_in_one_job(spark, make_series):
    rng = random.Random(4)
    values = {(s, f): [rng.choice([None, float(rng.randrange(50))]) for _ in range(420)] for s in (1, 2) for f in "ab"}
    values[1, "a"][:200] = [None] * 200
    panel = make_series(values).where("pmod(hash(date, store_nbr), 5) > 0")
    start = dt.date(2020, 1, 1)
    for origins in (
        [start + dt.timedelta(days=i) for i in range(40, 405)],
        [start + dt.timedelta(days=i) for i in (404, 50, 50, 51, 300)],
        [start - dt.timedelta(days=9), start + dt.timedelta(days=3), start + dt.timedelta(days=900)],
    ):
        found = baselines.last_per_weekday(panel, origins)
        expected = per_origin(panel, sorted(set(origins))).select(found.columns)
        assert found.exceptAll(expected).count() == 0 and expected.exceptAll(found).count() == 0
    many = [start + dt.timedelta(days=i) for i in range(40, 405)]
    plan = baselines.last_per_weekday(panel, many)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("max_by") <= 4
    forecast = baselines.weekly_seasonal_naive(panel, many)
    one = baselines.weekly_seasonal_naive(panel, many[100:101])
    same = forecast.where(F.col("origin") == F.lit(many[100]))
    assert one.count() > 0 and one.exceptAll(same).count() == 0 and same.exceptAll(one).count() == 0


def test_weekly_naive_equals_its_join_and_joins_nothing(spark, make_series):
    """Against targets joined to ``last_per_weekday``, with gaps, nulls, repeated days and rows without a series key."""
    rng = random.Random(11)
    values = {(s, f): [rng.choice([None, float(rng.randrange(50))]) for _ in range(120)] for s in (1, 2, None) for f in ("a", None)}
    values[1, "a"][:70] = [None] * 70
    panel = make_series(values).where("pmod(hash(date, store_nbr), 5) > 0")
    panel = panel.unionByName(panel.where("store_nbr = 2 and day(date) = 9").withColumn("sales", F.lit(None).cast("double"))).cache()
    for origins, horizons in [
        ([START + dt.timedelta(days=i) for i in range(40, 100)], tuple(range(1, 16))),
        ([START + dt.timedelta(days=i) for i in (90, 30, 55, 55, 130)], (3, 7, 8, 22)),
        ([START - dt.timedelta(days=5)], (6, 7)),
    ]:
        found = baselines.weekly_seasonal_naive(panel, origins, DirectSpec(horizons=horizons))
        pairs = spark.createDataFrame([(o, h) for o in sorted(set(origins)) for h in horizons], "origin date, horizon int")
        targets = panel.join(pairs, F.date_add("origin", F.col("horizon")) == F.col("date")).withColumn("day_of_week", F.weekday("date"))
        known = baselines.last_per_weekday(panel, origins)
        expected = targets.join(known, ["store_nbr", "family", "day_of_week", "origin"], "left").select(
            "origin", "store_nbr", "family", F.col("date").alias("target_date"), "horizon", F.col("sales").alias("target"), "prediction"
        )
        assert found.columns == expected.columns and found.count() > 0
        assert found.exceptAll(expected).count() == 0 and expected.exceptAll(found).count() == 0
        assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
