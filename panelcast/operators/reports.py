"""All sliced reports of scored rows from three reads of them.

Each report alone is one aggregation, but a full set of them reads the rows some thirty times.
Here one call finds the exact quantiles of all reports (two reads), and then every row is
stretched to the slices it belongs to and one aggregation, combined before its shuffle, holds the
measures of all slices (one read).  Both results are as small as the reports and are written;
each report is a projection of them, with the columns of the operator of its name.

Lists of single rows and the shares of category levels are not sliced reports and stay with
their own operators.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.config import CATEGORICAL_FEATURES, DiagnosticsSpec
from panelcast.functions.columns import ratio_or_null, right_closed_bins, series_label, to_number
from panelcast.functions.metrics import error_columns, metric_columns
from panelcast.functions.quantiles import exact_quantiles
from panelcast.operators.confidence import PLACES, tier_column
from panelcast.operators.severe import history_columns, is_severe, is_well_predicted
from panelcast.operators.signal import split_features, strongest_signal
from panelcast.sources.sinks import materialize

_KEYS = ("origin", "horizon", "family", "store_nbr", "level", "level_order")
_METRICS = ("count", "mae", "rmse", "wape", "n_null")
_TIERS = ("high", "medium", "low")


@dataclass(frozen=True)
class ReportTables:
    """What all reports are projected from.

    ``slices`` has one row per slice and group with all measures, ``quantiles`` one row per
    question, part and population with ``n``, ``mean``, ``median``, ``low`` and ``high``.
    """

    slices: DataFrame
    quantiles: DataFrame
    features: tuple[str, ...]
    categorical: tuple[str, ...]
    spec: DiagnosticsSpec


def _is_tail(spec: DiagnosticsSpec) -> Column:
    return F.coalesce(F.col("target") > F.lit(float(spec.tail_threshold)), F.lit(False))


def _populations(spec: DiagnosticsSpec) -> dict[str, Column]:
    tail = _is_tail(spec)
    return {"tail": tail, "severe": tail & is_severe(spec), "well": tail & is_well_predicted(spec)}


def _compared(features: Sequence[str], categorical: Sequence[str]) -> dict[str, list[str]]:
    """The populations that each feature is compared in."""
    history, numeric = history_columns(features), split_features(features, categorical)[0]
    wanted = {f: [("severe", True), ("tail", f in history), ("well", f in numeric)] for f in features}
    return {f: [p for p, asked in parts if asked] for f, parts in wanted.items() if f in history or f in numeric}


def report_quantiles(
    scored: DataFrame,
    features: Sequence[str],
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
    spec: DiagnosticsSpec = DiagnosticsSpec(),
    volatility: str = "rolling_cv_28",
) -> DataFrame:
    """Exact quantiles of every report: terciles of the volatility, medians of errors and features.

    One row per ``question``, ``part`` and ``population``.  Their number is fixed by the lists of
    features and horizons.
    """
    populations = _populations(spec)

    def entry(question: str, part: Column, population: str, test: Column, value: Column) -> Column:
        names = (F.lit(question).alias("question"), part.alias("part"), F.lit(population).alias("population"))
        return F.when(test & value.isNotNull(), F.struct(*names, value.cast("double").alias("value")))

    every, error = F.lit(True), F.col("error")
    horizon = F.col("horizon").cast("string")
    entries = [
        entry("volatility", F.lit(""), "all", every, F.col(volatility)),
        entry("error", F.lit(""), "all", every, error),
        entry("error", F.lit(""), "tail", populations["tail"], error),
        entry("error_by_horizon", horizon, "all", horizon.isNotNull(), error),
    ]
    for feature, names in _compared(features, categorical).items():
        entries += [entry("feature", F.lit(feature), p, populations[p], to_number(F.col(feature))) for p in names]
    stacked = error_columns(scored).select(F.inline(F.array_compact(F.array(*entries))))
    terciles = F.col("question") == "volatility"
    return exact_quantiles(
        stacked,
        "value",
        {"median": 0.5, "low": 1 / 3, "high": 2 / 3},
        by=["question", "part", "population"],
        bounded_groups=True,
        wanted={"median": ~terciles, "low": terciles, "high": terciles},
        mean=True,
    )


def report_slices(
    scored: DataFrame,
    spec: DiagnosticsSpec = DiagnosticsSpec(),
    tier: Column | None = None,
    promotion: str = "target_onpromotion",
) -> DataFrame:
    """Every measure of every slice and group, in one aggregation.

    A row counts in the slices of all rows, and if it is of the tail in those of the tail too.
    Keys that a slice does not group by are null.  ``tier`` adds the slice by confidence; the
    promotion measures are null without a ``promotion`` column.
    """
    tail, severe, well = _populations(spec).values()
    target, prediction = F.col("target"), F.col("prediction")
    origin, horizon, family, store = (F.col(c) for c in ("date", "horizon", "family", "store_nbr"))

    def classes(value: Column, edges: Sequence[float], labels: Sequence[str]) -> dict[str, Column]:
        label, order = right_closed_bins(value, edges, labels)
        return {"level": label, "level_order": order}

    slices: dict[str, dict[str, Column]] = {
        "all": {},
        "all_by_horizon": {"horizon": horizon},
        "all_by_origin": {"origin": origin},
        "all_by_origin_horizon": {"origin": origin, "horizon": horizon},
        "all_by_level": classes(target, spec.level_edges, spec.level_labels),
        "tail": {},
        "tail_by_horizon": {"horizon": horizon},
        "tail_by_origin": {"origin": origin},
        "tail_by_family": {"family": family},
        "tail_by_store": {"store_nbr": store},
        "tail_by_series": {"store_nbr": store, "family": family},
        "tail_by_level": classes(target, spec.spike_edges, spec.spike_labels),
        "tail_by_coverage": classes(F.col("prediction_ratio"), spec.coverage_edges, spec.coverage_labels),
    }
    if tier is not None:
        listed = F.when(tier.isin(*_TIERS), tier)
        slices["all_by_tier"] = {"level": listed, "level_order": _position(listed, _TIERS)}

    types = {f.name: f.dataType for f in scored.schema}
    kinds = dict(zip(_KEYS, (types["date"], types["horizon"], types["family"], types["store_nbr"], "string", "int")))

    def entry(name: str, keys: Mapping[str, Column]) -> Column:
        test = tail if name.startswith("tail") else F.lit(True)
        if "level" in keys:
            test = test & keys["level"].isNotNull()
        values = [keys.get(k, F.lit(None)).cast(kind).alias(k) for k, kind in kinds.items()]
        return F.when(test, F.struct(F.lit(name).alias("slice"), *values))

    rows = error_columns(scored)
    on = (F.col(promotion) > 0).cast("double") * 100 if promotion in scored.columns else F.lit(None).cast("double")
    flags = {
        "_severe": severe,
        "_well": well,
        "_tail": tail,
        "_under": tail & F.coalesce(prediction < target, F.lit(False)),
        "_severe_under": tail & F.coalesce(prediction < F.lit(spec.severe_ratio) * target, F.lit(False)),
        "_on": on,
    }
    measures = ["target", "prediction", "error", "prediction_ratio"]
    unfolded = rows.select(
        *measures,
        *[column.alias(name) for name, column in flags.items()],
        F.inline(F.array_compact(F.array(*[entry(name, keys) for name, keys in slices.items()]))),
    )
    return unfolded.groupBy("slice", *_KEYS).agg(
        F.count("*").alias("count"),
        *metric_columns(),
        F.avg("error").alias("mean_error"),
        F.avg("prediction_ratio").alias("mean_ratio"),
        F.count_if("_tail").alias("tail_count"),
        F.sum(F.when(F.col("_tail"), target.cast("double"))).alias("tail_volume"),
        F.count_if("_under").alias("under_count"),
        F.count_if("_severe_under").alias("severe_under_count"),
        F.count_if("_severe").alias("severe_count"),
        F.avg(F.when(F.col("_severe"), F.col("prediction_ratio"))).alias("severe_mean_ratio"),
        F.avg(F.when(F.col("_severe"), F.col("error"))).alias("severe_mean_error"),
        F.avg(F.when(F.col("_severe"), F.col("_on"))).alias("severe_promotion_pct"),
        F.count_if("_well").alias("well_count"),
        F.avg(F.when(F.col("_well"), F.col("_on"))).alias("well_promotion_pct"),
    )


def _position(value: Column, names: Sequence[str]) -> Column:
    position = F.when(value == names[0], 0)
    for i, name in enumerate(names[1:], 1):
        position = position.when(value == name, i)
    return position


def report_tables(
    scored: DataFrame,
    features: Sequence[str],
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
    spec: DiagnosticsSpec = DiagnosticsSpec(),
    volatility: str = "rolling_cv_28",
    promotion: str = "target_onpromotion",
) -> ReportTables:
    """Read the scored rows three times and write what all reports are made of.

    Rows that carry ``prediction_confidence`` keep their tiers; others get those of their own terciles.
    """
    found = report_quantiles(scored, features, categorical, spec, volatility)
    quantiles = materialize(found, "report_quantiles")
    if "prediction_confidence" in scored.columns:
        tier = F.col("prediction_confidence")
    else:
        # two numbers, put into the plan as constants
        terciles = quantiles.where("question = 'volatility'").select(F.round("low", PLACES), F.round("high", PLACES)).first()
        tier = tier_column(F.col(volatility), *(terciles or (None, None)))
    slices = materialize(report_slices(scored, spec, tier, promotion), "report_slices")
    return ReportTables(slices, quantiles, tuple(features), tuple(categorical), spec)


# -- projections -------------------------------------------------------------------------------


def _part(tables: ReportTables, name: str) -> DataFrame:
    return tables.slices.where(F.col("slice") == name)


def _single(tables: ReportTables, name: str) -> DataFrame:
    """The one row of a slice without keys; without any scored row counts are 0 and the rest null."""
    kept = [f for f in tables.slices.schema if f.name not in ("slice", *_KEYS)]
    zero = lambda f: F.coalesce(F.max(f.name), F.lit(0)) if f.dataType.typeName() == "long" else F.max(f.name)
    return _part(tables, name).agg(*[zero(f).alias(f.name) for f in kept])


def _percent() -> Column:
    return (F.col("wape") * 100).alias("wape")


def _metrics(rows: DataFrame, keys: Sequence[str | Column] = (), extra: Sequence[str | Column] = (), percent: bool = True) -> DataFrame:
    return rows.select(*keys, *[_percent() if percent and m == "wape" else F.col(m) for m in _METRICS], *extra)


def _severe(rows: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    return rows.where("severe_count > 0").select(
        *keys,
        "severe_count",
        F.col("count").alias("tail_count"),
        (F.col("severe_count") * 100.0 / F.col("count")).alias("severe_rate"),
        F.col("severe_mean_ratio").alias("mean_ratio"),
        F.col("severe_mean_error").alias("mean_error"),
    )


def _quantile(tables: ReportTables, question: str, population: str = "all") -> DataFrame:
    return tables.quantiles.where((F.col("question") == question) & (F.col("population") == population))


def _comparison(tables: ReportTables, features: Sequence[str], first: str, second: str) -> DataFrame:
    """Mean and median of each feature in two populations; a feature without values has nulls."""
    means = {f"{p}_{m}": (p, c) for m, c in (("mean", "mean"), ("median", "median")) for p in (first, second)}
    found = tables.quantiles.where("question = 'feature'").groupBy(F.col("part").alias("feature")).agg(
        *[F.max(F.when(F.col("population") == p, F.col(c))).alias(name) for name, (p, c) in means.items()]
    )
    # the listed features, as one row unfolded
    listed = tables.slices.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, features))).alias("feature"))
    return listed.join(found, "feature", "left")


def confidence_report(tables: ReportTables) -> DataFrame:
    # three rows at most
    volume = F.coalesce(F.col("tail_volume"), F.lit(0.0))
    share = ratio_or_null(volume * 100.0, F.sum(volume).over(Window.partitionBy()))
    rate = ratio_or_null(F.col("severe_under_count") * 100.0, F.col("tail_count").cast("double"))
    keys = [F.col("level").alias("confidence_tier"), F.col("level_order").alias("tier_order")]
    extra = [F.coalesce(rate, F.lit(0.0)).alias("severe_rate_pct"), share.alias("tail_volume_pct")]
    return _metrics(_part(tables, "all_by_tier"), keys, extra)


def coverage_report(tables: ReportTables) -> DataFrame:
    """Classes without rows stay with 0."""
    spec = tables.spec
    labels = [F.struct(F.lit(i).alias("level_order"), F.lit(n).alias("prediction_coverage")) for i, n in enumerate(spec.coverage_labels)]
    listed = tables.slices.sparkSession.range(1).select(F.inline(F.array(*labels)))
    total = _part(tables, "tail").agg(F.max("count")).scalar().cast("double")
    found = _part(tables, "tail_by_coverage").select("level_order", F.col("count").alias("_n"))
    count = F.coalesce(F.col("_n"), F.lit(0))
    return listed.join(found, "level_order", "left").select(
        "level_order", "prediction_coverage", count.alias("count"), ratio_or_null(count * 100.0, total).alias("percentage")
    )


def history_report(tables: ReportTables) -> DataFrame:
    rows = _comparison(tables, history_columns(tables.features), "severe", "tail")
    return rows.select(
        "feature", "severe_mean", "tail_mean", "severe_median", "tail_median",
        (F.col("severe_mean") - F.col("tail_mean")).alias("mean_difference"),
        (F.col("severe_median") - F.col("tail_median")).alias("median_difference"),
    )


def signal_report(tables: ReportTables) -> DataFrame:
    numeric = split_features(tables.features, tables.categorical)[0]
    difference = F.col("severe_mean") - F.col("well_mean")
    return _comparison(tables, numeric, "severe", "well").select(
        "feature", "severe_mean", "well_mean", difference.alias("mean_difference"), "severe_median", "well_median",
        (F.col("severe_median") - F.col("well_median")).alias("median_difference"),
        (ratio_or_null(difference, F.col("well_mean")) * 100).alias("relative_mean_difference_pct"),
    )


def series_report(tables: ReportTables) -> DataFrame:
    """Series that lack a key share the null label, so counts are added up by label."""
    sums = [F.sum("severe_count").alias("severe_count"), F.sum("count").alias("tail_count")]
    found = _part(tables, "tail_by_series").groupBy(series_label("store_nbr", "family").alias("series")).agg(*sums)
    found = found.where("severe_count > 0").withColumn("severe_rate", F.col("severe_count") * 100.0 / F.col("tail_count"))
    return found.orderBy(F.desc("severe_count"), F.desc("severe_rate"), "series").limit(tables.spec.series_list)


def severe_summary_report(tables: ReportTables) -> DataFrame:
    series = _part(tables, "tail_by_series")
    total = lambda name: F.coalesce(F.sum(name), F.lit(0))
    return series.agg(
        total("severe_count").alias("severe_rows"),
        ratio_or_null(F.sum("severe_count") * 100.0, F.sum("count").cast("double")).alias("severe_rate"),
        total("well_count").alias("well_predicted_rows"),
        F.count_if(F.col("severe_count") > 0).alias("severe_series"),
    ).withColumn("history_features", F.lit(len(history_columns(tables.features))))


def sliced_reports(tables: ReportTables) -> dict[str, DataFrame]:
    """Every sliced report by the name of its operator."""
    spec = tables.spec
    single, part = (lambda n: _single(tables, n)), (lambda n: _part(tables, n))
    percent = lambda c: ratio_or_null(F.col(c) * 100.0, F.col("count").cast("double"))
    median = lambda question, population: _quantile(tables, question, population).agg(F.max("median")).scalar()
    mean = F.col("mean_error")
    direction = F.when(mean < 0, "under").when(mean > 0, "over").when(mean == 0, "none").alias("direction")
    medians = _quantile(tables, "error_by_horizon").select(F.col("part").alias("_h"), F.col("median").alias("median_error"))
    by_horizon = part("all_by_horizon").select("horizon", "mean_error", F.col("horizon").cast("string").alias("_h"))
    cells = _metrics(part("all_by_origin_horizon"), ["origin", "horizon"], percent=False)
    classes = [F.col("level").alias("spike_level"), "level_order"]
    levels = [F.col("level").alias("sales_level"), "level_order"]
    strongest = signal_report(tables)
    return {
        "confidence_validation": confidence_report(tables),
        "tail_overall": _metrics(single("tail"), extra=["mean_error"]).withColumn("median_error", median("error", "tail")),
        "tail_by_horizon": _metrics(part("tail_by_horizon"), ["horizon"], ["mean_error", "mean_ratio"]),
        "tail_by_origin": _metrics(part("tail_by_origin"), ["origin"], ["mean_error", "mean_ratio"]),
        "tail_spike_severity": _metrics(part("tail_by_level"), classes, ["mean_error", "mean_ratio"]),
        "tail_coverage": coverage_report(tables),
        "tail_under_rates": single("tail").select(
            percent("under_count").alias("underprediction_rate_pct"),
            percent("severe_count").alias("severe_underprediction_rate_pct"),
        ),
        "severe_overview": single("tail").select(
            F.col("count").alias("tail_rows"), F.col("severe_count").alias("severe_rows"), percent("severe_count").alias("severe_rate")
        ),
        "severe_by_family": _severe(part("tail_by_family"), ["family"]),
        "severe_by_store": _severe(part("tail_by_store"), ["store_nbr"])
        .orderBy(F.desc("severe_count"), "store_nbr")
        .limit(spec.store_list),
        "severe_by_horizon": _severe(part("tail_by_horizon"), ["horizon"]),
        "severe_by_origin": _severe(part("tail_by_origin"), ["origin"]),
        "severe_history_compare": history_report(tables),
        "series_concentration": series_report(tables),
        "severe_summary": severe_summary_report(tables),
        "promotion_test": single("tail").select(
            F.col("severe_count").alias("severe_rows"), F.col("well_count").alias("well_rows"),
            "severe_promotion_pct", "well_promotion_pct",
        ),
        "signal_population": single("tail").select(
            F.col("severe_count").alias("severe_rows"), F.col("well_count").alias("well_rows")
        ),
        "signal_numeric": strongest,
        "signal_strongest": strongest_signal(strongest),
        "error_by_horizon": _metrics(part("all_by_horizon"), ["horizon"], ["mean_error"]),
        "error_by_origin": _metrics(part("all_by_origin"), ["origin"], ["mean_error"]),
        "error_by_sales_level": _metrics(part("all_by_level"), levels, ["mean_error"]),
        "bias_overall": single("all").select("mean_error", direction, median("error", "all").alias("median_error")),
        "bias_by_horizon": by_horizon.join(medians, "_h", "left").drop("_h"),
        "error_summary": _metrics(single("all"), extra=["mean_error"]),
        "eval_origin_horizon": cells,
        "eval_overall": _metrics(single("all"), percent=False),
        "eval_horizon_average": cells.groupBy("horizon").agg(
            F.avg("mae").alias("mae"), F.avg("rmse").alias("rmse"), (F.avg("wape") * 100).alias("wape_pct")
        ),
    }
