import math

import pytest
from pyspark.sql import functions as F

from panelcast.config import DiagnosticsSpec
from panelcast.functions import (
    contains_text, exact_quantiles, metric_columns, ratio_or_null, right_closed_bins, safe_ratio, series_label,
    to_number,
)

SPEC = DiagnosticsSpec()


def labels(spark, values, edges, names):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    label, order = right_closed_bins(F.col("v"), edges, names)
    return [(r.label, r.order) for r in df.select("i", label.alias("label"), order.alias("order")).orderBy("i").collect()]


def test_sales_level_edges(spark):
    got = labels(spark, [-5.0, 0.0, 0.1, 10.0, 1000.0, 1000.01, None], SPEC.level_edges, SPEC.level_labels)
    assert [x[0] for x in got] == [
        "0", "0", "0 < sales <= 10", "0 < sales <= 10", "200 < sales <= 1000", "> 1000", None,
    ]


def test_spike_edges_are_right_closed(spark):
    got = labels(spark, [1000.0, 1000.01, 2000.0, 20000.0, 20001.0], SPEC.spike_edges, SPEC.spike_labels)
    assert got == [(None, None), ("1000-2000", 0), ("1000-2000", 0), ("10000-20000", 3), (">20000", 4)]


def test_coverage_edges(spark):
    values = [0.25, 0.5, 0.75, 1.0, 1.25, 1.5, 1.51, -1.0]
    got = labels(spark, values, SPEC.coverage_edges, SPEC.coverage_labels)
    assert [x[1] for x in got] == [0, 1, 2, 3, 4, 5, 6, 0]


def test_bins_need_matching_edges():
    with pytest.raises(ValueError):
        right_closed_bins(F.col("v"), [0, 1], ["a", "b"])


def test_ratios(spark):
    row = spark.sql("SELECT 6D AS x, 0D AS y").select(
        safe_ratio(F.col("x"), F.col("y")).alias("eps"), ratio_or_null(F.col("x"), F.col("y")).alias("none")
    ).first()
    assert row.eps == pytest.approx(6e6) and row.none is None


def test_text_helpers(spark):
    df = spark.createDataFrame(
        [(1, "a", "BLACK friday sale", "7.5"), (2, "b", None, "x"), (3, None, "none", "NaN")],
        "store_nbr int, family string, description string, number string",
    )
    rows = df.select(
        series_label("store_nbr", "family").alias("series"),
        contains_text(F.col("description"), "Black Friday").alias("hit"),
        to_number(F.col("number")).alias("n"),
    ).collect()
    assert [r.series for r in rows] == ["1 | a", "2 | b", None]
    assert [r.hit for r in rows] == [True, False, False]
    assert [r.n for r in rows] == [7.5, None, None]


def metric_row(spark, rows, **options):
    df = spark.createDataFrame(rows, "target double, prediction double")
    return df.agg(*metric_columns(**options)).first()


def test_metrics(spark):
    row = metric_row(spark, [(10.0, 7.0), (0.0, 4.0)])
    assert (row.mae, row.rmse, row.wape, row.n_null) == (3.5, math.sqrt(12.5), 0.7, 0)
    assert metric_row(spark, [(0.0, 1.0)]).wape is None


def test_metrics_null_policies(spark):
    rows = [(10.0, 7.0), (5.0, None)]
    poisoned = metric_row(spark, rows)
    assert (poisoned.mae, poisoned.rmse, poisoned.wape, poisoned.n_null) == (None, None, None, 1)
    skipped = metric_row(spark, rows, null_policy="skip")
    assert (skipped.mae, skipped.wape) == (3.0, 0.3)
    with pytest.raises(ValueError):
        metric_columns(null_policy="other")


@pytest.mark.parametrize(
    "expression, accuracy",
    [
        ("id * 1.5", 50), ("id % 7", 50), ("pow(id, 3)", 50), ("if(id < 2900, 0, id)", 50), ("-exp(id % 40)", 50),
        ("5", 50), ("if(id % 3 = 0, null, id)", 50), ("id % 700", 20_000),
    ],
)
def test_quantiles_match_percentile(spark, expression, accuracy):
    df = spark.range(3000).selectExpr(f"CAST({expression} AS DOUBLE) AS v", "id % 2 AS g")
    probs = {"p0": 0.0, "third": 1 / 3, "mid": 0.5, "most": 0.99, "p1": 1.0}
    listed = F.array(*[F.lit(p) for p in probs.values()])
    expected = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", listed).alias("p")).collect()}
    for bounded in (True, False):
        got = exact_quantiles(df, "v", probs, by=["g"], accuracy=accuracy, bounded_groups=bounded)
        got = {r.g: [r[name] for name in probs] for r in got.collect()}
        for g in (0, 1):
            assert got[g] == pytest.approx(expected[g], rel=1e-12)
    whole = exact_quantiles(df, "v", probs, accuracy=accuracy).first()
    assert [whole[name] for name in probs] == pytest.approx(df.agg(F.percentile("v", listed)).first()[0], rel=1e-12)


def test_quantiles_of_nothing(spark):
    row = exact_quantiles(spark.range(5).where("id < 0"), "id", {"m": 0.5}).first()
    assert (row.n, row.m) == (0, None)


@pytest.mark.parametrize("n", [1, 2, 3, 8, 51, 52, 60])
def test_quantiles_of_few_values(spark, n):
    df = spark.range(n).selectExpr("CAST(id * id AS DOUBLE) AS v")
    probs = {"low": 1 / 3, "mid": 0.5, "high": 2 / 3}
    row = exact_quantiles(df, "v", probs, accuracy=50).first()
    expected = df.agg(F.percentile("v", F.array(*[F.lit(p) for p in probs.values()]))).first()[0]
    assert [row[name] for name in probs] == pytest.approx(expected, rel=1e-12)
