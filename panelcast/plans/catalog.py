"""The registered queries: every operator on the panel built from the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast import __version__
from panelcast.config import DirectSpec, model_features
from panelcast.functions.columns import to_number
from panelcast.operators import (
    baselines, confidence, direct, eda, enrich, errors, evaluation, explain, features, model, profile, reports,
    severe, signal, tail as tails,
)
from panelcast.plans import warehouse as w
from panelcast.plans.columns import OUTPUTS, TABLES, spark_select
from panelcast.plans.pipeline import fit_or_load
from panelcast.sources.sinks import input_state, intermediate_path, materialize, parameter_key, shared_folder
from panelcast.sources.tables import narrow_types, parse_dates, read_csv_quarantined

Query = Callable[[SparkSession, str], DataFrame]

MODEL_FEATURES = model_features()
NUMERIC, CATEGORICAL = signal.split_features(MODEL_FEATURES)
HISTORY = severe.history_columns(MODEL_FEATURES)
MODEL = model.ModelSpec(max_trees=5, max_depth=5, learning_rate=0.2, patience=3)
# largest error of an attribution, as a share of the largest contribution
TOLERANCE = 0.05
BASE_ORIGINS = w.SPLIT.baseline_origins
TAIL_THRESHOLD = w.DIAGNOSTICS.tail_threshold


def _flagged(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.enrich(w.panel(spark, folder), w.stores(spark, folder), w.holidays(spark))


def _direct_at(spark: SparkSession, folder: str, horizon: int) -> DataFrame:
    return w.direct(spark, folder, spec=DirectSpec(horizons=(horizon,)))


def _base_rows(spark: SparkSession, folder: str) -> DataFrame:
    return w.direct(spark, folder, days=BASE_ORIGINS)


def _naive(spark: SparkSession, folder: str) -> DataFrame:
    return baselines.persistence_forecast(_base_rows(spark, folder))


def _seasonal(spark: SparkSession, folder: str) -> DataFrame:
    return baselines.weekly_seasonal_naive(w.panel(spark, folder), BASE_ORIGINS)


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return confidence.add_confidence(w.scored_table(spark, folder))


def _slice_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("horizon").agg(
        F.count("*").alias("rows"),
        F.sum("target").alias("target"),
        F.min("date").alias("first_origin"),
        F.max("date").alias("last_origin"),
    )


# -- profiling ---------------------------------------------------------------------------------


def table_shapes(spark, folder):
    return profile.table_shapes({name: w.table(spark, folder, name) for name in TABLES})


def parsed_dates(spark, folder):
    dates = F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")
    orders = parse_dates({"orders": w.table(spark, folder, "orders").select(dates)})["orders"]
    return orders.groupBy(F.year("date").alias("year")).agg(
        F.first(F.typeof("date")).alias("data_type"), F.count("date").alias("rows"),
        F.min("date").alias("first_day"), F.max("date").alias("last_day"),
    )


def narrowed_panel(spark, folder):
    # store numbers grow with the data, and one that does not fit is null
    narrow = narrow_types(w.panel(spark, folder), strict=False)
    return narrow.groupBy("family").agg(
        F.count("store_nbr").alias("stores"), F.sum("onpromotion").alias("onpromotion"),
        F.first(F.typeof("store_nbr")).alias("store_type"), F.first(F.typeof("onpromotion")).alias("onpromotion_type"),
    )


def numeric_readings(spark, folder):
    orders = w.table(spark, folder, "orders")
    rank, price = F.substring("o_orderpriority", 1, 1), F.col("o_totalprice").cast("string")
    return orders.groupBy("o_orderpriority").agg(
        F.count(to_number(F.col("o_orderpriority"))).alias("whole"), F.sum(to_number(rank)).alias("ranks"),
        F.sum(to_number(price)).alias("price"),
    )


def quarantined_orders(spark, folder):
    """Orders written as text, with faults planted by number, and read back: rows read, and refused by reason."""
    key = F.col("o_orderkey")
    lines = w.table(spark, folder, "orders").select(
        key.cast("string").alias("o_orderkey"),
        F.when(key % 89 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"),
        F.when(key % 97 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
    )
    path = intermediate_path(spark, "orders_csv")
    lines.write.option("header", True).csv(path)
    schema = T.StructType().add("o_orderkey", "long").add("o_orderdate", "date").add("o_totalprice", "double")
    good, bad = read_csv_quarantined(spark, path, schema)
    rows = good.select(F.lit("").alias("reason")).unionByName(bad.select("reason"))
    return rows.groupBy("reason").agg(F.count("*").alias("rows"))


def schema_profile(spark, folder):
    return profile.schema_profile(w.table(spark, folder, "orders"))


def null_audit(spark, folder):
    joined = enrich.add_store_attributes(w.panel(spark, folder), w.stores(spark, folder))
    return profile.null_counts(joined)


def total_nulls(spark, folder):
    return profile.total_nulls(w.featured(spark, folder).select("lag_7", "lag_14", "lag_28", "lag_365"))


def duplicate_rows(spark, folder):
    return profile.duplicate_rows(w.table(spark, folder, "lineitem"))


def _sales(spark: SparkSession, folder: str) -> DataFrame:
    """The panel's sales as a written column: exact quantiles read them in several passes."""
    return materialize(w.panel(spark, folder).select("sales"), "sales")


def sales_summary(spark, folder):
    return profile.numeric_summary(_sales(spark, folder), "sales")


def price_summary(spark, folder):
    return profile.numeric_summary(w.table(spark, folder, "lineitem"), "l_extendedprice")


def zero_negative_share(spark, folder):
    return profile.sign_shares(w.panel(spark, folder), "sales")


def sales_median_max(spark, folder):
    return profile.median_and_max(_sales(spark, folder), "sales")


def sales_histogram(spark, folder):
    return profile.histogram(_sales(spark, folder), "sales")


def sales_boxplot(spark, folder):
    return profile.boxplot(_sales(spark, folder), "sales")


# -- exploration -------------------------------------------------------------------------------


def _daily(spark, folder):
    # days without any shipment count as zero, so the total is taken over the dense panel
    return eda.daily_total(w.panel(spark, folder))


def daily_span(spark, folder):
    return eda.daily_span(_daily(spark, folder))


def year_profile(spark, folder):
    return eda.year_profile(_daily(spark, folder))


def year_columns(spark, folder):
    daily = materialize(_daily(spark, folder), "daily")
    years = [r.year for r in daily.select(F.year("date").alias("year")).distinct().orderBy("year").collect()]
    wide = eda.year_columns(daily, years)
    return wide.unpivot("day_of_year", [str(y) for y in years], "year", "sales")


def monthly_seasonality(spark, folder):
    return eda.monthly_seasonality(_daily(spark, folder))


def weekly_seasonality(spark, folder):
    return eda.weekly_seasonality(_daily(spark, folder))


# -- enrichment --------------------------------------------------------------------------------


def store_enriched(spark, folder):
    return enrich.add_store_attributes(w.panel(spark, folder), w.stores(spark, folder))


def holiday_flags(spark, folder):
    return enrich.add_holiday_flag(store_enriched(spark, folder), w.holidays(spark))


def event_flags(spark, folder):
    return enrich.add_event_flags(w.panel(spark, folder), w.holidays(spark))


def calendar_columns(spark, folder):
    return (
        enrich.add_calendar(w.panel(spark, folder))
        .groupBy("day_of_week", "month")
        .agg(F.count("*").alias("rows"), F.sum("sales").alias("sales"))
    )


def flag_audit(spark, folder):
    return profile.flag_audit(_flagged(spark, folder), enrich.CALENDAR_FLAGS)


# -- direct dataset ----------------------------------------------------------------------------


def direct_all_summary(spark, folder):
    return (
        w.direct(spark, folder)
        .groupBy("horizon")
        .agg(
            F.count("*").alias("rows"),
            F.sum("target").alias("target"),
            F.sum("origin_sales").alias("origin_sales"),
            F.count("lag_7").alias("lag_7_rows"),
            F.count("lag_14").alias("lag_14_rows"),
            F.sum("lag_28").alias("lag_28"),
            F.sum("lag_365").alias("lag_365"),
            F.sum("day_of_week").alias("day_of_week"),
            F.sum("month").alias("month"),
            F.min("target_date").alias("first_target"),
            F.max("target_date").alias("last_target"),
        )
    )


def train_slice_counts(spark, folder):
    return _slice_summary(w.training(spark, folder))


def train_purged_counts(spark, folder):
    rows = w.direct(spark, folder, direct.in_training(w.PURGED_SPLIT), span=w.TRAINING_SPAN)
    return _slice_summary(direct.training_rows(rows, w.PURGED_SPLIT))


def tail_slices(spark, folder):
    # rows of other origins count in neither slice
    counted = direct.in_training(w.SPLIT) | direct.at_origins(BASE_ORIGINS)
    return direct.tail_slices(w.direct(spark, folder, counted, span=w.BOTH_SPAN), TAIL_THRESHOLD, w.SPLIT)


def set_sizes(spark, folder):
    valid = direct.at_origins(w.SPLIT.validation_origins)
    sets = {
        "direct": F.lit(True),
        "train": direct.in_training(w.SPLIT),
        "validation": valid,
        "tail": valid & (F.col("target") > TAIL_THRESHOLD),
    }
    return profile.set_sizes(sets, w.direct(spark, folder), MODEL_FEATURES)


def overlap_audit(spark, folder):
    # rows of other origins count in no column
    counted = direct.in_training(w.SPLIT) | direct.at_origins(w.SPLIT.validation_origins)
    return direct.overlap_audit(w.direct(spark, folder, counted, span=w.BOTH_SPAN), w.SPLIT)


# -- baselines ---------------------------------------------------------------------------------


def seasonal_year_scores(spark, folder):
    """The weekly forecast scored at every day of the training year as an origin: one job for all of them."""
    days = (w.SPLIT.train_end - w.SPLIT.train_start).days + 1
    origins = [w.SPLIT.train_start + dt.timedelta(days=i) for i in range(days)]
    return evaluation.overall(baselines.weekly_seasonal_naive(w.panel(spark, folder), origins))


def model_comparison(spark, folder):
    rows = materialize(_base_rows(spark, folder), "origins")
    cells = {
        "persistence": baselines.score_cells(baselines.persistence_forecast(rows), "date"),
        "weekly_seasonal": baselines.score_cells(_seasonal(spark, folder)),
        "stand_in": baselines.score_cells(w.stand_in_forecast(rows), "date"),
    }
    return baselines.compare_models(cells, "weekly_seasonal")


def model_comparison_common(spark, folder):
    forecasts = {
        "persistence": materialize(_naive(spark, folder).withColumnRenamed("date", "origin"), "naive"),
        "weekly_seasonal": materialize(_seasonal(spark, folder), "seasonal"),
    }
    keys = ["store_nbr", "family", "origin", "horizon"]
    common = baselines.on_common_population(forecasts, keys)
    return baselines.compare_models({name: baselines.score_cells(f) for name, f in common.items()})


# -- confidence, tail, severe, signal ----------------------------------------------------------


def confidence_validation(spark, folder):
    return confidence.confidence_validation(
        _labelled(spark, folder), TAIL_THRESHOLD, w.DIAGNOSTICS.severe_ratio
    )


def _on_tail(operator: Callable[..., DataFrame], *args, target_columns=()) -> Query:
    return lambda spark, folder: operator(w.tail(spark, folder, target_columns), *args)


def _on_scored(operator: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, folder: operator(w.scored(spark, folder), *args)


def _on_tail_table(operator: Callable[..., DataFrame], *args) -> Query:
    """For operators that read their input several times."""
    return lambda spark, folder: operator(w.tail_table(spark, folder), *args)


def _on_scored_table(operator: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, folder: operator(w.scored_table(spark, folder), *args)


def signal_categorical(spark, folder):
    # the training rows only list their levels, and the origins are few: both are read from the folded rows, neither is written
    read = w.folded_facts(spark, folder)
    training = direct.training_rows(w.direct(spark, folder, direct.in_training(w.SPLIT), span=w.TRAINING_SPAN, read=read), w.SPLIT)
    domain = signal.category_domain(training, CATEGORICAL)
    at_origins = w.direct(spark, folder, days=w.SPLIT.validation_origins, read=read)
    scored = tails.tail_rows(w.stand_in_forecast(at_origins), TAIL_THRESHOLD)
    return signal.categorical_signal(scored, CATEGORICAL, domain, w.DIAGNOSTICS)


def eval_slices(spark, folder):
    rows = w.scored(spark, folder).select("date", "horizon", "family", "target", "prediction")
    table = evaluation.metrics_by_slices(rows, [["horizon"], ["date"], ["family"], []])
    levels = [F.col(c).cast("string") for c in ("horizon", "date", "family")]
    return table.withColumn("level", F.coalesce(*levels, F.lit("all")))


def _report_tables(spark: SparkSession, folder: str) -> reports.ReportTables:
    rows = materialize(w.scored(spark, folder, ("onpromotion",)), "scored")
    return reports.report_tables(rows, MODEL_FEATURES, spec=w.DIAGNOSTICS)


def report_slices(spark, folder):
    return _report_tables(spark, folder).slices


def report_quantiles(spark, folder):
    return reports.report_quantiles(w.scored_table(spark, folder), MODEL_FEATURES, spec=w.DIAGNOSTICS)


def future_forecast(spark, folder):
    return w.stand_in_forecast(w.future(spark, folder)).withColumnRenamed("date", "origin")


# -- model -------------------------------------------------------------------------------------


def _fitted(spark: SparkSession, folder: str) -> tuple[model.FittedModel, DataFrame]:
    """The model of a data folder, fitted by whichever query comes first and kept in the shared folder."""
    validation = materialize(w.validation(spark, folder), "validation")
    read = {name: w.table(spark, folder, name) for name in ("lineitem", "supplier", "nation", "region")}
    key = parameter_key(input_state(read), w.SPLIT, MODEL, __version__)

    def training() -> DataFrame:
        rows = w.training_table(spark, folder, [*MODEL.features, MODEL.target])
        model.same_features(rows, validation, MODEL)
        return rows

    return fit_or_load(f"{shared_folder(spark)}/panelcast/models/{key}", training, validation, MODEL), validation


def gbt_predictions(spark, folder):
    fitted, validation = _fitted(spark, folder)
    columns = ["store_nbr", "family", "date", "horizon", "target", "prediction"]
    return fitted.score(validation).select(*columns)


def gbt_completeness(spark, folder):
    fitted, validation = _fitted(spark, folder)
    return model.completeness(validation, fitted.score(validation))


def model_checks(spark, folder):
    """What must hold of any fitted model.

    Every validation row is scored, with its target; the importances sum to 1; the contributions
    of a sampled row sum to its prediction less the mean prediction of the background.  A feature
    whose error is missing, or larger than the one asked for while pairs could still be added, counts
    as a violation too.
    """
    fitted, validation = _fitted(spark, folder)
    table, pairs = explain.attribution_within(fitted, validation, TOLERANCE, D.sample_size, seed=D.seed)
    values, errors = explain.row_contributions(pairs), table.agg(F.max("pairs"), F.max("standard_error"), F.max("mean_abs_shapley")).first()
    permutations = errors[0]
    loose = errors[1] is None or (errors[1] > TOLERANCE * errors[2] and permutations < 64)
    totals = values.groupBy("row_key").agg(F.sum("shapley").alias("total"))
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in tails.ROW_KEYS]).alias("row_key")
    sampled = fitted.score(explain.fixed_sample(validation, D.sample_size, D.seed)).select(key, "prediction")
    background = fitted.score(explain.fixed_sample(validation, permutations, D.seed + 1)).agg(F.avg("prediction"))
    gaps = sampled.join(totals, "row_key", "left").withColumn("base", background.scalar())
    gap = F.abs(F.col("total") - F.col("prediction") + F.col("base"))
    off = gaps.select(F.coalesce(gap > 1e-6, F.lit(True)).alias("off"))
    attribution = off.agg(
        F.lit("attribution").alias("check_name"), F.count("*").alias("checked"), (F.count_if("off") + int(loose)).alias("violations"),
        F.lit(None).cast("double").alias("target"),
    )
    scored = fitted.score(validation).agg(
        F.lit("scored").alias("check_name"), F.count_distinct(*tails.ROW_KEYS).alias("checked"),
        F.count_if(F.col("prediction").isNull()).alias("violations"), F.sum("target").alias("target"),
    )
    shares = explain.importance(fitted).agg(
        F.lit("importance").alias("check_name"), F.count("*").alias("checked"),
        F.count_if(F.col("importance") < 0).alias("negative"), F.sum("importance").alias("total"),
    )
    wrong = F.col("negative") + (F.abs(F.col("total") - 1) > 1e-9).cast("long")
    shares = shares.select("check_name", "checked", wrong.alias("violations"))
    return attribution.unionByName(scored).unionByName(shares, allowMissingColumns=True)


def gbt_importance(spark, folder):
    return explain.importance(_fitted(spark, folder)[0])


def shapley_importance(spark, folder):
    fitted, validation = _fitted(spark, folder)
    return explain.attribution_within(fitted, validation, TOLERANCE, D.sample_size, seed=D.seed)[0]


def gbt_report_slices(spark, folder):
    """Every error, tail, severe and confidence measure of the fitted model's rows."""
    fitted, validation = _fitted(spark, folder)
    rows = materialize(fitted.score(validation), "gbt_scored")
    return reports.report_tables(rows, MODEL_FEATURES, spec=D).slices


def gbt_comparison(spark, folder):
    """The fitted model beside both baselines, on the baselines' origins."""
    fitted, validation = _fitted(spark, folder)
    rows = validation.where(direct.at_origins(BASE_ORIGINS))
    cells = {
        "persistence": baselines.score_cells(baselines.persistence_forecast(rows), "date"),
        "weekly_seasonal": baselines.score_cells(_seasonal(spark, folder)),
        "boosted_trees": baselines.score_cells(fitted.score(rows), "date"),
    }
    return baselines.compare_models(cells, "boosted_trees")


def gbt_forecast(spark, folder):
    """The days after the panel's last one, by the fitted model."""
    scored = _fitted(spark, folder)[0].score(w.future(spark, folder))
    return scored.select("store_nbr", "family", F.col("date").alias("origin"), "horizon", "target_date", "prediction")


D = w.DIAGNOSTICS

# queries compared with SQL
CHECKED: dict[str, Query] = {
    "table_shapes": table_shapes,
    "parsed_dates": parsed_dates,
    "narrowed_panel": narrowed_panel,
    "numeric_readings": numeric_readings,
    "quarantined_orders": quarantined_orders,
    "schema_profile": schema_profile,
    "null_audit": null_audit,
    "total_nulls": total_nulls,
    "duplicate_rows": duplicate_rows,
    "sales_summary": sales_summary,
    "price_summary": price_summary,
    "zero_negative_share": zero_negative_share,
    "sales_median_max": sales_median_max,
    "sales_histogram": sales_histogram,
    "sales_boxplot": sales_boxplot,
    "panel": w.panel,
    "panel_total": lambda s, f: w.panel(s, f).agg(F.sum("sales").alias("sales")),
    "daily_total": _daily,
    "daily_span": daily_span,
    "year_profile": year_profile,
    "year_columns": year_columns,
    "monthly_seasonality": monthly_seasonality,
    "weekly_seasonality": weekly_seasonality,
    "transactions_by_day": w.transactions,
    "store_enriched": store_enriched,
    "holiday_flags": holiday_flags,
    "event_flags": event_flags,
    "calendar_columns": calendar_columns,
    "flag_audit": flag_audit,
    "lag_features": lambda s, f: features.add_lags(w.panel(s, f)),
    "rolling_means": lambda s, f: features.add_rolling(w.panel(s, f)),
    "rolling_stds": lambda s, f: features.add_rolling(w.panel(s, f)),
    "trend_features": w.featured,
    "trend_features_ratio": lambda s, f: features.add_features(w.panel(s, f), variant="ratio"),
    "spike_features": w.featured,
    "direct_h1": lambda s, f: _direct_at(s, f, 1),
    "direct_h7": lambda s, f: _direct_at(s, f, 7),
    "direct_h15": lambda s, f: _direct_at(s, f, 15),
    "direct_all_summary": direct_all_summary,
    "train_slice_counts": train_slice_counts,
    "train_purged_counts": train_purged_counts,
    "valid_slice": w.validation,
    "tail_slices": tail_slices,
    "set_sizes": set_sizes,
    "overlap_audit": overlap_audit,
    "naive_forecast": _naive,
    "naive_scores": lambda s, f: baselines.score_cells(_naive(s, f), "date"),
    "seasonal_forecast": _seasonal,
    "seasonal_scores": lambda s, f: baselines.score_cells(_seasonal(s, f)),
    "seasonal_year_scores": seasonal_year_scores,
    "model_comparison": model_comparison,
    "model_comparison_common": model_comparison_common,
    "confidence_thresholds": _on_scored_table(confidence.tier_thresholds),
    "confidence_labels": _labelled,
    "confidence_validation": confidence_validation,
    "tail_rows": w.tail,
    "tail_overall": _on_tail_table(tails.tail_overall),
    "tail_by_horizon": _on_tail(tails.tail_by_horizon),
    "tail_by_origin": _on_tail(tails.tail_by_origin),
    "tail_spike_severity": _on_tail(tails.spike_severity, D),
    "tail_largest_under": _on_tail(tails.largest_underpredictions, D),
    "tail_coverage": _on_tail(tails.coverage_distribution, D),
    "tail_under_rates": _on_tail(tails.underprediction_rates, D),
    "severe_overview": _on_tail(severe.severe_overview, D),
    "severe_by_family": _on_tail(severe.severe_by_family, D),
    "severe_by_store": _on_tail(severe.severe_by_store, D),
    "severe_by_horizon": _on_tail(severe.severe_by_horizon, D),
    "severe_by_origin": _on_tail(severe.severe_by_origin, D),
    "severe_history_compare": _on_tail_table(severe.history_comparison, HISTORY, D),
    "severe_worst": _on_tail(severe.worst_severe, D),
    "well_predicted": _on_tail(severe.well_predicted_rows, D),
    "series_concentration": _on_tail(severe.series_concentration, D),
    "severe_summary": _on_tail(severe.severe_summary, MODEL_FEATURES, D),
    "promotion_test": _on_tail(severe.promotion_test, D, target_columns=("onpromotion",)),
    "signal_population": _on_tail(signal.signal_population, D),
    "signal_numeric": _on_tail_table(signal.numeric_signal, NUMERIC, D),
    "signal_strongest": lambda s, f: signal.strongest_signal(signal.numeric_signal(w.tail_table(s, f), NUMERIC, D)),
    "signal_categorical": signal_categorical,
    "error_by_horizon": _on_scored(errors.error_by_horizon),
    "error_by_origin": _on_scored(errors.error_by_origin),
    "error_by_sales_level": _on_scored(errors.error_by_sales_level, D),
    "bias_overall": _on_scored_table(errors.bias_overall),
    "bias_by_horizon": _on_scored_table(errors.bias_by_horizon),
    "worst_predictions": _on_scored(errors.worst_predictions, D),
    "error_summary": _on_scored(errors.error_summary),
    "eval_origin_horizon": _on_scored(evaluation.by_origin_and_horizon),
    "eval_overall": _on_scored(evaluation.overall),
    "eval_horizon_average": lambda s, f: evaluation.horizon_average(evaluation.by_origin_and_horizon(w.scored(s, f))),
    "eval_slices": eval_slices,
    "report_slices": report_slices,
    "future_forecast": future_forecast,
    "report_quantiles": report_quantiles,
    "category_domains": lambda s, f: model.category_domains(w.training(s, f)),
    "target_encoding": lambda s, f: model.mean_target_encoding(w.training(s, f), "store_nbr"),
    "gbt_completeness": gbt_completeness,
    "model_checks": model_checks,
    "sample_fixed": _on_scored(explain.fixed_sample, D.sample_size, D.seed),
}

# fitted models have no SQL twin
MODELLED: dict[str, Query] = {
    "gbt_predictions": gbt_predictions,
    "gbt_importance": gbt_importance,
    "shapley_importance": shapley_importance,
    "gbt_report_slices": gbt_report_slices,
    "gbt_comparison": gbt_comparison,
    "gbt_forecast": gbt_forecast,
}


def _put_out(name: str, query: Query) -> Query:
    return lambda spark, folder: spark_select(query(spark, folder), OUTPUTS[name])


def queries() -> dict[str, Query]:
    """All registered queries by name."""
    return {name: _put_out(name, query) for name, query in CHECKED.items()} | MODELLED
