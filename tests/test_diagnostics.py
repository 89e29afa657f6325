import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.config import DiagnosticsSpec
from panelcast.operators import confidence, errors, evaluation, explain, profile, severe, signal, tail

SPEC = DiagnosticsSpec()
SCHEMA = (
    "store_nbr int, family string, date date, horizon int, target double, prediction double, rolling_cv_28 double, "
    "lag_28 double, target_onpromotion int"
)
D1, D2 = dt.date(2020, 1, 1), dt.date(2020, 2, 1)
# store, family, date, horizon, target, ratio, volatility, lag, promotion
CASES = [
    (1, "a", D1, 1, 2000.0, 0.25, 0.1, 10.0, 1),
    (1, "a", D1, 2, 2000.0, 0.49, 0.2, 20.0, 0),
    (1, "b", D1, 1, 1000.01, 0.5, 0.3, 30.0, 1),
    (2, "b", D1, 2, 20000.0, 0.75, 0.4, 40.0, 1),
    (2, "b", D2, 1, 20001.0, 1.0, 0.5, 50.0, 0),
    (2, "b", D2, 2, 5000.0, 1.25, 0.6, 60.0, 0),
    (3, "c", D2, 1, 5000.0, 1.5, 0.7, 70.0, 0),
    (3, "c", D2, 2, 1000.0, 0.1, 0.8, 80.0, 0),
    (3, "c", D2, 3, 0.0, 0.0, None, 90.0, 0),
]


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(s, f, d, h, t, t * r if t else 7.0, cv, lag, p) for s, f, d, h, t, r, cv, lag, p in CASES]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def rows(scored):
    return tail.tail_rows(scored, SPEC.tail_threshold).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_tail_is_strictly_above_the_threshold(rows):
    assert rows.count() == 7
    assert rows.agg(F.min("target")).first()[0] == 1000.01


def test_severe_is_strictly_below_half(rows):
    overview = severe.severe_overview(rows).first()
    assert (overview.tail_rows, overview.severe_rows) == (7, 2)
    assert severe.well_predicted_rows(rows).count() == 3  # 0.75, 1.0, 1.25
    rates = tail.underprediction_rates(rows).first()
    assert rates.underprediction_rate_pct == pytest.approx(400 / 7)
    assert rates.severe_underprediction_rate_pct == pytest.approx(200 / 7)


def test_coverage_keeps_empty_classes(rows):
    got = {r.prediction_coverage: r["count"] for r in tail.coverage_distribution(rows).collect()}
    assert got == {"<25%": 1, "25%-50%": 2, "50%-75%": 1, "75%-100%": 1, "100%-125%": 1, "125%-150%": 1, ">150%": 0}
    assert tail.coverage_distribution(rows).agg(F.sum("percentage")).first()[0] == pytest.approx(100)


def test_spike_classes_without_rows_do_not_appear(rows):
    got = {r.spike_level: r["count"] for r in tail.spike_severity(rows).collect()}
    assert got == {"1000-2000": 3, "2000-5000": 2, "10000-20000": 1, ">20000": 1}


def test_grouped_errors_sum_to_the_whole(scored):
    whole = errors.error_summary(scored).first()
    parts = errors.error_by_horizon(scored).collect()
    assert sum(r.mae * r["count"] for r in parts) == pytest.approx(whole.mae * whole["count"])
    assert sum(r["count"] for r in errors.error_by_sales_level(scored).collect()) == scored.count()


def test_severe_groups(rows):
    families = {r.family: r for r in severe.severe_by_family(rows).collect()}
    assert set(families) == {"a"} and families["a"].severe_rate == 100
    assert families["a"].mean_ratio == pytest.approx(0.37)
    assert [r.store_nbr for r in severe.severe_by_store(rows).collect()] == [1]
    assert [r.series for r in severe.series_concentration(rows).collect()] == ["1 | a"]
    summary = severe.severe_summary(rows, ["lag_28", "horizon"]).first()
    assert (summary.severe_rows, summary.well_predicted_rows, summary.severe_series, summary.history_features) == (2, 3, 1, 1)


def test_history_and_signal(rows):
    row = severe.history_comparison(rows, ["lag_28"]).first()
    assert (row.severe_mean, row.tail_mean, row.severe_median, row.tail_median) == (15.0, 40.0, 15.0, 40.0)
    comparison = signal.numeric_signal(rows, ["lag_28", "horizon"])
    got = {r.feature: r for r in comparison.collect()}
    assert got["lag_28"].well_mean == 50.0
    assert got["lag_28"].relative_mean_difference_pct == pytest.approx(-70)
    assert signal.strongest_signal(comparison).first().feature == "lag_28"
    test = severe.promotion_test(rows).first()
    assert (test.severe_promotion_pct, test.well_promotion_pct) == (50.0, pytest.approx(100 / 3))


def test_categorical_signal_lists_the_domain(spark, rows):
    domain = spark.createDataFrame([("family", x) for x in "abz"], "feature string, level string")
    got = {r.level: r for r in signal.categorical_signal(rows, ["family"], domain).collect()}
    assert set(got) == {"a", "b", "z"}  # c is in neither population nor in the domain
    assert (got["a"].severe_pct, got["a"].well_pct) == (100, 0)
    assert (got["z"].severe_pct, got["z"].well_pct, got["z"].difference_pct) == (0, 0, 0)
    for name in ("severe_pct", "well_pct"):
        assert sum(r[name] for r in got.values()) == pytest.approx(100)


def test_top_lists_break_ties_by_key(rows, scored):
    errors_listed = [r.error for r in tail.largest_underpredictions(rows).collect()]
    assert errors_listed == sorted(errors_listed)
    worst = errors.worst_predictions(scored, DiagnosticsSpec(worst_list=2)).collect()
    assert [r.absolute_error for r in worst] == [5000.0, 2500.0]
    assert [r.prediction_ratio for r in severe.worst_severe(rows).collect()] == pytest.approx([0.25, 0.49])


def test_bias(scored):
    row = errors.bias_overall(scored).first()
    assert row.direction == "under" and row.mean_error < 0
    values = sorted(t * r - t if t else 7.0 for _, _, _, _, t, r, *_ in CASES)
    assert row.median_error == pytest.approx(values[len(values) // 2])
    medians = {r.horizon: r.median_error for r in errors.bias_by_horizon(scored).collect()}
    assert medians[3] == 7.0


def test_confidence_tiers(scored):
    labelled = confidence.add_confidence(scored).collect()
    tiers = {r.rolling_cv_28: r.prediction_confidence for r in labelled}
    assert tiers == {0.1: "high", 0.2: "high", 0.3: "high", 0.4: "medium", 0.5: "medium", 0.6: "low", 0.7: "low",
                     0.8: "low", None: "unknown"}
    table = {r.confidence_tier: r for r in confidence.confidence_validation(confidence.add_confidence(scored), 1000).collect()}
    assert {t: r["count"] for t, r in table.items()} == {"high": 3, "medium": 2, "low": 3}
    assert table["high"].severe_rate_pct == pytest.approx(200 / 3)
    assert table["medium"].severe_rate_pct == 0
    assert sum(r.tail_volume_pct for r in table.values()) == pytest.approx(100)


def test_empty_input_gives_empty_tables(nothing):
    rows = tail.tail_rows(nothing, 1000)
    for table in (
        tail.tail_by_horizon(rows), tail.spike_severity(rows), tail.largest_underpredictions(rows),
        severe.severe_by_family(rows), severe.severe_by_store(rows), severe.worst_severe(rows),
        severe.series_concentration(rows), errors.error_by_sales_level(nothing), errors.bias_by_horizon(nothing),
        evaluation.by_origin_and_horizon(nothing), signal.categorical_signal(rows, ["family"]),
        confidence.confidence_validation(confidence.add_confidence(nothing), 1000),
    ):
        assert table.count() == 0
    assert severe.severe_overview(rows).first().severe_rate is None
    assert severe.severe_summary(rows, []).first().severe_rows == 0
    assert tail.tail_overall(rows).first().mae is None
    assert tail.coverage_distribution(rows).agg(F.sum("count")).first()[0] == 0
    assert errors.bias_overall(nothing).first().direction is None
    assert severe.history_comparison(rows, ["lag_28"]).first().severe_mean is None


def test_fixed_sample_is_repeatable(scored):
    one = explain.fixed_sample(scored, 4).collect()
    two = explain.fixed_sample(scored.repartition(3), 4).collect()
    assert one == two and len(one) == 4
    assert explain.fixed_sample(scored, 100).count() == len(CASES)
    assert one != explain.fixed_sample(scored, 4, seed=7).collect()


def test_profile(spark):
    df = spark.createDataFrame(
        [(1, 0.0, "x"), (1, 0.0, "x"), (2, -1.0, None), (3, 99.0, None), (3, None, None), (3, None, None)],
        "k int, v double, t string",
    )
    assert profile.duplicate_rows(df).first().duplicate_rows == 2
    assert {r.column_name: r.nulls for r in profile.null_counts(df).collect()} == {"k": 0, "v": 2, "t": 4}
    assert profile.total_nulls(df).first().total_nulls == 6
    assert [(r.data_type, r.non_null) for r in profile.schema_profile(df).collect()] == [("int", 6), ("double", 4), ("string", 2)]
    signs = profile.sign_shares(df, "v").first()
    assert (signs.zeros, signs.negatives, signs.zero_pct) == (2, 1, pytest.approx(100 / 3))
    bars = {r.bin: r["count"] for r in profile.histogram(df, "v", 10).collect()}
    assert len(bars) == 10 and bars[0] == 3 and bars[9] == 1 and sum(bars.values()) == 4
    flat = {r.bin: r["count"] for r in profile.histogram(df.where("v = 0"), "v", 10).collect()}
    assert flat[5] == 2 and sum(flat.values()) == 2
    box = profile.boxplot(df, "v").first()
    assert (box.q1, box.median, box.q3) == (-0.25, 0.0, 24.75)
    assert (box.whisker_low, box.whisker_high, box.outliers) == (-1.0, 0.0, 1)
    summary = profile.numeric_summary(df, "v").first()
    assert (summary["count"], summary["mean"], summary["max"]) == (4, 24.5, 99.0)
