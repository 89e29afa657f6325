"""Reports from three reads against the operator of each name."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.config import DiagnosticsSpec
from panelcast.functions.quantiles import exact_quantiles
from panelcast.operators import confidence, errors, evaluation, reports, severe, signal, tail

SPEC = DiagnosticsSpec(tail_threshold=50.0, spike_edges=(50, 80, 100, float("inf")), spike_labels=("s", "m", "l"), series_list=7, store_list=3)
FEATURES = ["store_nbr", "family", "horizon", "lag_28", "rolling_mean_7", "empty_mean"]
CATEGORICAL = ("store_nbr", "family")
NAMES = [
    "confidence_validation",
    "tail_overall",
    "tail_by_horizon",
    "tail_by_origin",
    "tail_spike_severity",
    "tail_coverage",
    "tail_under_rates",
    "severe_overview",
    "severe_by_family",
    "severe_by_store",
    "severe_by_horizon",
    "severe_by_origin",
    "severe_history_compare",
    "series_concentration",
    "severe_summary",
    "promotion_test",
    "signal_population",
    "signal_numeric",
    "signal_strongest",
    "error_by_horizon",
    "error_by_origin",
    "error_by_sales_level",
    "bias_overall",
    "bias_by_horizon",
    "error_summary",
    "eval_origin_horizon",
    "eval_overall",
    "eval_horizon_average",
]


def rows(spark, n):
    """Made rows with ties, missing predictions, missing stores and families, and targets of zero."""
    i = F.col("id")
    pick = lambda salt, k: F.pmod(F.xxhash64(i, F.lit(salt)), F.lit(k))
    return spark.range(n).select(
        F.when(pick(1, 20) > 0, pick(2, 5)).cast("int").alias("store_nbr"),
        F.when(pick(3, 20) > 0, F.concat(F.lit("f"), pick(4, 3).cast("string"))).alias("family"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), pick(5, 3).cast("int")).alias("date"),
        (pick(6, 4) + 1).cast("int").alias("horizon"),
        pick(7, 120).cast("double").alias("target"),
        F.when(pick(8, 50) > 0, pick(9, 120).cast("double")).alias("prediction"),
        F.when(pick(10, 9) > 0, pick(11, 40) / 7.0).alias("rolling_cv_28"),
        F.when(pick(12, 9) > 0, pick(13, 30).cast("double")).alias("lag_28"),
        (pick(14, 30) / 11.0).alias("rolling_mean_7"),
        F.lit(None).cast("double").alias("empty_mean"),
        pick(15, 3).cast("int").alias("target_onpromotion"),
    )


def by_operator(scored, d=SPEC):
    rest = tail.tail_rows(scored, d.tail_threshold)
    labelled = confidence.add_confidence(scored)
    numeric = signal.split_features(FEATURES, CATEGORICAL)[0]
    comparison = signal.numeric_signal(rest, numeric, d)
    cells = evaluation.by_origin_and_horizon(scored)
    return {
        "confidence_validation": confidence.confidence_validation(labelled, d.tail_threshold, d.severe_ratio),
        "tail_overall": tail.tail_overall(rest),
        "tail_by_horizon": tail.tail_by_horizon(rest),
        "tail_by_origin": tail.tail_by_origin(rest),
        "tail_spike_severity": tail.spike_severity(rest, d),
        "tail_coverage": tail.coverage_distribution(rest, d),
        "tail_under_rates": tail.underprediction_rates(rest, d),
        "severe_overview": severe.severe_overview(rest, d),
        "severe_by_family": severe.severe_by_family(rest, d),
        "severe_by_store": severe.severe_by_store(rest, d),
        "severe_by_horizon": severe.severe_by_horizon(rest, d),
        "severe_by_origin": severe.severe_by_origin(rest, d),
        "severe_history_compare": severe.history_comparison(rest, severe.history_columns(FEATURES), d),
        "series_concentration": severe.series_concentration(rest, d),
        "severe_summary": severe.severe_summary(rest, FEATURES, d),
        "promotion_test": severe.promotion_test(rest, d),
        "signal_population": signal.signal_population(rest, d),
        "signal_numeric": comparison,
        "signal_strongest": signal.strongest_signal(comparison),
        "error_by_horizon": errors.error_by_horizon(scored),
        "error_by_origin": errors.error_by_origin(scored),
        "error_by_sales_level": errors.error_by_sales_level(scored, d),
        "bias_overall": errors.bias_overall(scored),
        "bias_by_horizon": errors.bias_by_horizon(scored),
        "error_summary": errors.error_summary(scored),
        "eval_origin_horizon": cells,
        "eval_overall": evaluation.overall(scored),
        "eval_horizon_average": evaluation.horizon_average(cells),
    }


def values(df):
    plain = lambda v: float(f"{v:.9g}") if isinstance(v, float) else v
    return sorted([tuple(plain(v) for v in row) for row in df.collect()], key=repr)


@pytest.fixture(scope="module")
def scored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("scored"))
    rows(spark, 4000).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def made(scored):
    return reports.sliced_reports(reports.report_tables(scored, FEATURES, CATEGORICAL, SPEC))


@pytest.fixture(scope="module")
def wanted(scored):
    return by_operator(scored)


@pytest.mark.parametrize("name", NAMES)
def test_report_equals_its_operator(made, wanted, name):
    assert made[name].columns == wanted[name].columns
    assert values(made[name]) == values(wanted[name])


def test_same_reports(made, wanted):
    assert set(made) == set(wanted)


def test_no_rows(spark):
    scored = rows(spark, 0)
    made, wanted = reports.sliced_reports(reports.report_tables(scored, FEATURES, CATEGORICAL, SPEC)), by_operator(scored)
    for name, table in made.items():
        assert values(table) == values(wanted[name]), name


def test_given_tiers_are_kept(scored):
    labelled = scored.withColumn("prediction_confidence", F.when(F.col("horizon") == 1, "low").otherwise("unknown"))
    found = reports.sliced_reports(reports.report_tables(labelled, FEATURES, CATEGORICAL, SPEC))["confidence_validation"]
    assert [(r.confidence_tier, r["count"]) for r in found.collect()] == [("low", scored.where("horizon = 1").count())]


def test_three_reads(scored):
    quantiles = reports.report_quantiles(scored, FEATURES, CATEGORICAL, SPEC)
    slices = reports.report_slices(scored, SPEC, F.lit("low"))
    reads = []
    for df in (quantiles, slices):
        df.collect()
        # the final plan lists a reused exchange by its name only
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        reads.append(final.count("FileScan parquet"))
    assert sum(reads) <= 3, reads


def test_wanted_quantiles_and_means(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(101)] + [("b", 7.0)], "g string, v double")
    found = exact_quantiles(df, "v", {"m": 0.5, "q": 0.25}, by=["g"], wanted={"q": F.col("g") == "a"}, mean=True)
    assert sorted(map(tuple, found.select("g", "n", "mean", "m", "q").collect())) == [("a", 101, 50.0, 50.0, 25.0), ("b", 1, 7.0, 7.0, None)]
    one = exact_quantiles(df, "v", {"m": 0.5}, mean=True).first()
    assert (one.n, one["mean"], one.m) == (102, pytest.approx(5057 / 102), 50.0 - 0.5)
