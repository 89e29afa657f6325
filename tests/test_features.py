import datetime as dt
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.config import FeatureSpec
from panelcast.operators.features import add_features, add_rolling, add_spikes, add_trend, add_lags
from panelcast.operators.panel import daily_panel, densify_calendar

RNG = np.random.default_rng(7)
SERIES = {
    (1, "a"): list(RNG.integers(0, 40, 420)),
    (2, "a"): [None if i % 97 == 50 else v for i, v in enumerate(RNG.integers(0, 9, 420))],
    (2, "b"): [5] * 420,
    (3, "b"): [0] * 40,
}


def by_hand(values):
    """Every feature of every row of one series, from plain lists."""
    out, spikes = [], []
    for i, today in enumerate(values):
        row = {f"lag_{k}": values[i - k] if i >= k else None for k in (7, 14, 28, 365)}
        for n in (7, 14, 28):
            before = values[i - n : i] if i >= n else [None]
            known = None not in before
            row[f"rolling_mean_{n}"] = statistics.fmean(before) if known else None
            row[f"rolling_std_{n}"] = statistics.stdev(before) if known else None
        week, fortnight, level, spread = (
            row[c] for c in ("rolling_mean_7", "rolling_mean_14", "rolling_mean_28", "rolling_std_28")
        )
        ready = level is not None
        row["rolling_cv_28"] = spread / (level + 1e-6) if ready else None
        row["momentum_7_28"] = week - level if ready else None
        row["momentum_14_28"] = fortnight - level if ready else None
        row["trend_7_28"] = week / (level + 1e-6) if ready else None
        year_ago = row["lag_365"]
        row["yearly_ratio"] = level / (year_ago + 1e-6) if ready and year_ago is not None else None
        row["historical_spike_rate"] = statistics.fmean(spikes) if len(spikes) >= 30 else None
        row["is_spike_day"] = int(ready and today is not None and today > level + 2 * spread)
        spikes.append(row["is_spike_day"])
        out.append(row)
    return out


def test_features_match_hand_computation(make_series):
    rows = add_features(make_series(SERIES)).orderBy("store_nbr", "family", "date").collect()
    expected = [row for key in sorted(SERIES) for row in by_hand([None if v is None else float(v) for v in SERIES[key]])]
    assert len(rows) == len(expected)
    for got, want in zip(rows, expected):
        for column, value in want.items():
            assert (got[column] is None) == (value is None), (column, got)
            if value is not None:
                assert got[column] == pytest.approx(value, rel=1e-7, abs=1e-6), (column, got)


def test_warm_up_lengths(make_series):
    rows = add_rolling(make_series({(1, "a"): range(1, 31)})).orderBy("date").collect()
    for n in (7, 14, 28):
        assert rows[n - 1][f"rolling_mean_{n}"] is None and rows[n - 1][f"rolling_std_{n}"] is None
        assert rows[n][f"rolling_mean_{n}"] == pytest.approx((n + 1) / 2)


def test_null_sale_empties_only_windows_that_hold_it(make_series):
    values = [1.0] * 10 + [None] + [1.0] * 20
    rows = add_rolling(make_series({(1, "a"): values})).orderBy("date").collect()
    assert rows[10].rolling_mean_7 == 1.0  # the null is the row itself
    assert all(rows[i].rolling_mean_7 is None for i in range(11, 18))
    assert rows[18].rolling_mean_7 == 1.0


def test_constant_and_zero_series(make_series):
    rows = add_features(make_series({(1, "a"): [5] * 60, (2, "a"): [0] * 60})).where("date = '2020-02-20'").collect()
    assert [r.rolling_std_28 for r in rows] == [0.0, 0.0]
    assert sorted(r.rolling_cv_28 for r in rows) == [0.0, 0.0]
    assert [r.is_spike_day for r in rows] == [0, 0]


def test_spike_rate_counts_warm_up_zeros(make_series):
    values = [1, 2] * 20 + [500] + [1, 2] * 5
    rows = add_features(make_series({(1, "a"): values})).orderBy("date").collect()
    assert [r.is_spike_day for r in rows[:29]] == [0] * 29
    assert rows[29].historical_spike_rate is None and rows[30].historical_spike_rate == 0.0
    assert rows[40].is_spike_day == 1
    assert rows[40].historical_spike_rate == 0.0 and rows[41].historical_spike_rate == pytest.approx(1 / 41)


def test_first_definition_of_trend(make_series):
    panel = make_series({(1, "a"): [0] * 30 + list(range(1, 10))})
    rows = add_trend(add_rolling(add_lags(panel)), variant="ratio").orderBy("date").collect()
    assert rows[29].momentum_7_28 is None  # mean of 28 days is zero
    last = rows[-1]
    assert last.momentum_7_28 == pytest.approx(last.rolling_mean_7 / last.rolling_mean_28)
    assert last.trend_7_28 == pytest.approx(last.rolling_mean_7 - last.rolling_mean_28)
    with pytest.raises(ValueError):
        add_trend(panel, variant="other")


def test_features_do_not_see_the_future(make_series):
    """Changing every value from day d on leaves the features at d unchanged."""
    values = list(RNG.integers(0, 50, 400))
    changed = values[:380] + [999] * 20
    day = dt.date(2020, 1, 1) + dt.timedelta(days=380)
    columns = FeatureSpec().origin_columns
    rows = [
        add_features(make_series({(1, "a"): v})).where(F.col("date") == day).select(*columns).first()
        for v in (values, changed)
    ]
    assert rows[0] == rows[1]


def test_spike_multiplier_is_a_parameter(make_series):
    panel = add_rolling(make_series({(1, "a"): [1, 2] * 20 + [4]}))
    loose = add_spikes(panel, FeatureSpec(spike_sigmas=100.0)).where("is_spike_day = 1").count()
    tight = add_spikes(panel, FeatureSpec(spike_sigmas=2.0)).where("is_spike_day = 1").count()
    assert (loose, tight) == (0, 1)


def test_one_shuffle_by_series(spark, data):
    from panelcast.plans import warehouse

    plan = warehouse.featured(spark, data)._jdf.queryExecution().executedPlan().toString()
    # one exchange folds the facts, one places the series; windows and densifying add none
    assert plan.count("Exchange hashpartitioning") == 2


def test_daily_panel_and_densify(spark):
    d = lambda n: dt.date(2020, 1, n)
    facts = spark.createDataFrame(
        [(1, "a", d(3), 2.0, 1), (1, "a", d(3), 3.0, 0), (1, "a", d(6), 1.0, 1), (2, "b", d(1), 4.0, 0),
         (2, "b", d(12), 9.0, 0), (3, "c", d(12), 9.0, 0)],
        "s int, f string, day date, q double, promo int",
    )
    panel = daily_panel(
        facts,
        {"store_nbr": F.col("s"), "family": F.col("f")},
        F.col("day"),
        {"sales": F.sum("q"), "onpromotion": F.sum("promo"), "note": F.max("f")},
    )
    dense = densify_calendar(panel, d(1), d(10), ("sales", "onpromotion")).orderBy("store_nbr", "date").collect()
    # a series without a fact inside the range is not a series of the range
    assert [(r.store_nbr, r.date) for r in dense] == [(s, d(n)) for s in (1, 2) for n in range(1, 11)]
    assert [r.sales for r in dense[:10]] == [0, 0, 5, 0, 0, 1, 0, 0, 0, 0]
    assert [r.onpromotion for r in dense[:10]] == [0, 0, 1, 0, 0, 1, 0, 0, 0, 0]
    assert [r.note for r in dense[:3]] == [None, None, "a"]
    assert [r.sales for r in dense[10:]] == [4] + [0] * 9
