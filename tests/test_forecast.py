import datetime as dt

import numpy as np
import pytest

from panelcast.operators.direct import at_origins, build_direct
from panelcast.operators.features import add_features
from panelcast.operators.forecast import answer, future_rows

RNG = np.random.default_rng(11)
START = dt.date(2020, 1, 1)
VALUES = {(1, "a"): list(RNG.integers(1, 90, 430)), (2, "b"): list(RNG.integers(0, 20, 430))}
LAST = START + dt.timedelta(days=409)


def test_equal_to_rows_of_a_longer_panel_without_their_target(make_series):
    whole = add_features(make_series(VALUES))
    known = build_direct(whole, origins=at_origins([LAST])).drop("target")
    future = future_rows(add_features(make_series({k: v[:410] for k, v in VALUES.items()})), LAST)
    assert future.columns == known.columns
    assert sorted(future.collect()) == sorted(known.collect()) and future.count() == 30


def test_short_and_ended_series_have_no_rows(make_series):
    series = {(1, "a"): VALUES[1, "a"][:410], (3, "c"): VALUES[2, "b"][:300]}
    rows = future_rows(add_features(make_series(series)), LAST).collect()
    assert {(r.store_nbr, r.family) for r in rows} == {(1, "a")}
    assert [r.target_date for r in sorted(rows, key=lambda r: r.horizon)] == [LAST + dt.timedelta(days=h) for h in range(1, 16)]


def test_no_panel(make_series):
    assert future_rows(add_features(make_series({(1, "a"): []})), LAST).count() == 0


@pytest.fixture
def forecast(spark):
    rows = [(1, "a", START, START + dt.timedelta(days=h), h, float(10 * h)) for h in (1, 2)]
    return spark.createDataFrame(rows, "store_nbr int, family string, date date, target_date date, horizon int, prediction double")


def test_every_wanted_row_is_answered(spark, forecast):
    day = lambda h: START + dt.timedelta(days=h)
    wanted = [(0, 1, "a", day(1)), (1, 1, "a", day(1)), (2, 1, "a", day(9)), (3, 2, "a", day(1)), (4, None, "a", day(1)), (5, 1, "a", None)]
    asked = spark.createDataFrame([(*w, -1.0) for w in wanted], "id int, store_nbr int, family string, date date, prediction double")
    found = {r.id: (r.horizon, r.prediction) for r in answer(asked, forecast).collect()}
    assert found == {0: (1, 10.0), 1: (1, 10.0), 2: (None, None), 3: (None, None), 4: (None, None), 5: (None, None)}
    assert answer(asked.limit(0), forecast).count() == 0
