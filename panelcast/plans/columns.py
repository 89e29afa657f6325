"""Columns of every registered query and how they are put out for comparison.

``s`` text, ``i`` whole number, ``d`` number rounded to six places, ``r`` rate rounded to
nine, ``e`` large number rounded to two, ``g`` number of any size to nine digits, ``t`` day as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# number of columns of each given table
TABLES = {
    "benchmark": 2, "conversations": 4, "customer": 5, "documents": 5, "embeddings": 3, "events": 6, "labels": 3,
    "lineitem": 11, "nation": 3, "orders": 6, "pages": 3, "part": 6, "region": 2, "supplier": 4,
}

_METRICS = "count:i mae:d rmse:d wape:d n_null:i"
_TAIL_METRICS = f"{_METRICS} mean_error:d mean_ratio:d"
_KEYS = "store_nbr:i family:s date:t"
_ROW = f"{_KEYS} horizon:i"
_SEVERE = "severe_count:i tail_count:i severe_rate:d mean_ratio:d mean_error:d"
_DIRECT = (
    f"{_ROW} store_type:s city:s state:s store_cluster:i origin_sales:d target:d target_date:t day_of_week:i month:i "
    "lag_7:d lag_14:d lag_28:d lag_365:d rolling_mean_7:d rolling_mean_14:d rolling_mean_28:d rolling_std_7:d "
    "rolling_std_14:d rolling_std_28:d rolling_cv_28:d momentum_7_28:d momentum_14_28:d trend_7_28:d yearly_ratio:e "
    "historical_spike_rate:r"
)
_LIST = f"{_ROW} target:d prediction:d error:d prediction_ratio:d"
_SUMMARY = "count:i mean:d std:d min:d q25:d q50:d q75:d max:d"

OUTPUTS: dict[str, str] = {
    "table_shapes": "table_name:s rows:i columns:i",
    "schema_profile": "column_name:s data_type:s non_null:i",
    "null_audit": "column_name:s nulls:i",
    "total_nulls": "total_nulls:i",
    "duplicate_rows": "duplicate_rows:i",
    "parsed_dates": "year:i data_type:s rows:i first_day:t last_day:t",
    "narrowed_panel": "family:s stores:i onpromotion:i store_type:s onpromotion_type:s",
    "quarantined_orders": "reason:s rows:i",
    "seasonal_year_scores": _METRICS,
    "numeric_readings": "o_orderpriority:s whole:i ranks:d price:f",
    "panel_total": "sales:d",
    "category_domains": "feature:s levels:i",
    "target_encoding": "store_nbr:i store_nbr_mean:d",
    "model_checks": "check_name:s checked:i violations:i target:d",
    "gbt_completeness": "scored_rows:i missing:i input_rows:i complete:i",
    "sales_summary": _SUMMARY,
    "price_summary": _SUMMARY,
    "zero_negative_share": "rows:i zeros:i zero_pct:d negatives:i",
    "sales_median_max": "max:d median:d",
    "sales_histogram": "bin:i count:i",
    "sales_boxplot": "q1:d median:d q3:d whisker_low:d whisker_high:d outliers:i",
    "panel": f"{_KEYS} sales:d onpromotion:i",
    "daily_total": "date:t sales:d",
    "daily_span": "first_day:t last_day:t days:i",
    "year_profile": "year:i day_of_year:i sales:d",
    "year_columns": "day_of_year:i year:i sales:d",
    "monthly_seasonality": "month:i mean_sales:d",
    "weekly_seasonality": "weekday:i mean_sales:d",
    "transactions_by_day": "date:t store_nbr:i transactions:i",
    "store_enriched": f"{_KEYS} sales:d city:s state:s store_type:s store_cluster:i",
    "holiday_flags": f"{_KEYS} is_holiday:i",
    "event_flags": f"{_KEYS} is_black_friday:i is_cyber_monday:i is_mothers_day:i",
    "calendar_columns": "day_of_week:i month:i rows:i sales:d",
    "flag_audit": "flag:s data_type:s flag_sum:i lowest:i highest:i not_binary:i",
    "lag_features": f"{_KEYS} lag_7:d lag_14:d lag_28:d lag_365:d",
    "rolling_means": f"{_KEYS} rolling_mean_7:d rolling_mean_14:d rolling_mean_28:d",
    "rolling_stds": f"{_KEYS} rolling_std_7:d rolling_std_14:d rolling_std_28:d rolling_cv_28:d",
    "trend_features": f"{_KEYS} momentum_7_28:d momentum_14_28:d trend_7_28:d yearly_ratio:e",
    "trend_features_ratio": f"{_KEYS} momentum_7_28:d momentum_14_28:d trend_7_28:d yearly_ratio:d",
    "spike_features": f"{_KEYS} is_spike_day:i historical_spike_rate:r",
    "direct_h1": _DIRECT,
    "direct_h7": _DIRECT,
    "direct_h15": _DIRECT,
    "direct_all_summary": (
        "horizon:i rows:i target:d origin_sales:d lag_7_rows:i lag_14_rows:i lag_28:d lag_365:d day_of_week:i month:i "
        "first_target:t last_target:t"
    ),
    "train_slice_counts": "horizon:i rows:i target:d first_origin:t last_origin:t",
    "train_purged_counts": "horizon:i rows:i target:d first_origin:t last_origin:t",
    "valid_slice": _DIRECT,
    "tail_slices": "tail_train_rows:i tail_valid_rows:i",
    "set_sizes": "set_name:s rows:i columns:i",
    "overlap_audit": "train_rows:i validation_rows:i shared_rows:i train_targets_after_split:i",
    "naive_forecast": f"{_ROW} target:d prediction:d",
    "naive_scores": f"origin:t horizon:i {_METRICS}",
    "seasonal_forecast": "origin:t store_nbr:i family:s target_date:t horizon:i target:d prediction:d",
    "seasonal_scores": f"origin:t horizon:i {_METRICS}",
    "model_comparison": "model:s average_wape:d cells:i reduction_pct:d",
    "model_comparison_common": "model:s average_wape:d cells:i",
    "confidence_thresholds": "low:d high:d",
    "confidence_labels": f"{_ROW} prediction_confidence:s abs_error:d",
    "confidence_validation": f"confidence_tier:s tier_order:i {_METRICS} severe_rate_pct:d tail_volume_pct:d",
    "tail_rows": f"{_ROW} target:d prediction:d error:d absolute_error:d prediction_ratio:d",
    "tail_overall": f"{_METRICS} mean_error:d median_error:d",
    "tail_by_horizon": f"horizon:i {_TAIL_METRICS}",
    "tail_by_origin": f"origin:t {_TAIL_METRICS}",
    "tail_spike_severity": f"spike_level:s level_order:i {_TAIL_METRICS}",
    "tail_largest_under": _LIST,
    "tail_coverage": "level_order:i prediction_coverage:s count:i percentage:d",
    "tail_under_rates": "underprediction_rate_pct:d severe_underprediction_rate_pct:d",
    "severe_overview": "tail_rows:i severe_rows:i severe_rate:d",
    "severe_by_family": f"family:s {_SEVERE}",
    "severe_by_store": f"store_nbr:i {_SEVERE}",
    "severe_by_horizon": f"horizon:i {_SEVERE}",
    "severe_by_origin": f"origin:t {_SEVERE}",
    "severe_history_compare": (
        "feature:s severe_mean:d tail_mean:d severe_median:d tail_median:d mean_difference:d median_difference:d"
    ),
    "severe_worst": _LIST,
    "well_predicted": f"{_ROW} target:d prediction:d prediction_ratio:d",
    "series_concentration": "series:s severe_count:i tail_count:i severe_rate:d",
    "severe_summary": "severe_rows:i severe_rate:d well_predicted_rows:i severe_series:i history_features:i",
    "promotion_test": "severe_rows:i well_rows:i severe_promotion_pct:d well_promotion_pct:d",
    "signal_population": "severe_rows:i well_rows:i",
    "signal_numeric": (
        "feature:s severe_mean:e well_mean:e mean_difference:e severe_median:e well_median:e median_difference:e "
        "relative_mean_difference_pct:e"
    ),
    "signal_strongest": "feature:s relative_mean_difference_pct:e",
    "signal_categorical": "feature:s level:s severe_pct:d well_pct:d difference_pct:d",
    "error_by_horizon": f"horizon:i {_METRICS} mean_error:d",
    "error_by_origin": f"origin:t {_METRICS} mean_error:d",
    "error_by_sales_level": f"sales_level:s level_order:i {_METRICS} mean_error:d",
    "bias_overall": "mean_error:d direction:s median_error:d",
    "bias_by_horizon": "horizon:i mean_error:d median_error:d",
    "worst_predictions": f"{_ROW} target:d prediction:d error:d absolute_error:d",
    "error_summary": f"{_METRICS} mean_error:d",
    "eval_origin_horizon": f"origin:t horizon:i {_METRICS}",
    "eval_overall": _METRICS,
    "eval_horizon_average": "horizon:i mae:d rmse:d wape_pct:d",
    "eval_slices": f"slice:s level:s {_METRICS}",
    "report_slices": (
        f"slice:s origin:t horizon:s family:s store_nbr:s level:s level_order:s {_TAIL_METRICS} tail_count:i tail_volume:d "
        "under_count:i severe_under_count:i severe_count:i severe_mean_ratio:d severe_mean_error:d severe_promotion_pct:d "
        "well_count:i well_promotion_pct:d"
    ),
    "future_forecast": "store_nbr:i family:s origin:t horizon:i target_date:t prediction:d",
    "report_quantiles": "question:s part:s population:s n:i mean:g median:g low:d high:d",
    "sample_fixed": f"{_ROW} target:d prediction:d",
}

_PLACES = {"d": 6, "r": 9, "e": 2, "f": 1}


def _pairs(spec: str) -> list[tuple[str, str]]:
    return [tuple(part.split(":")) for part in spec.split()]


def _rounded(value: Column, places: int) -> Column:
    """``round``, whose decimal text is written out only for a value near the middle of two steps, or a large one."""
    steps = value * F.lit(10.0**places)
    plain = (F.abs(steps) < F.lit(1e11)) & (F.abs(steps - F.rint(steps)) < F.lit(0.4999))
    return F.when(plain, F.rint(steps) / F.lit(10.0**places)).otherwise(F.round(value, places))


def spark_select(df: DataFrame, spec: str) -> DataFrame:
    def column(name: str, kind: str) -> Column:
        c = F.col(name)
        if kind == "i":
            c = c.cast("bigint")
        elif kind in _PLACES:
            c = _rounded(c.cast("double"), _PLACES[kind]) + F.lit(0.0)  # no negative zero
        elif kind == "g":
            c = c.cast("double") + F.lit(0.0)
            c = F.when(c.isNotNull(), F.format_string("%.8e", c).cast("double"))
        elif kind == "t":
            # a lambda keeps this step out of the fused code: with it wide rows' one method gets too long to be compiled
            c = F.transform(F.array(c), lambda day: day.cast("string"))[0]
        else:
            c = c.cast("string")
        return c.alias(name)

    return df.select(*[column(name, kind) for name, kind in _pairs(spec)])


def sql_select(spec: str, query: str) -> str:
    def column(name: str, kind: str) -> str:
        if kind == "i":
            return f'CAST("{name}" AS BIGINT) AS "{name}"'
        if kind in _PLACES:
            rounded = f'ROUND(CAST("{name}" AS DOUBLE), {_PLACES[kind]})'
            return f'CASE WHEN {rounded} = 0 THEN CAST(0 AS DOUBLE) ELSE {rounded} END AS "{name}"'
        if kind == "g":
            return f"""CAST(PRINTF('%.8e', CAST("{name}" AS DOUBLE) + 0) AS DOUBLE) AS "{name}\""""
        return f'CAST("{name}" AS VARCHAR) AS "{name}"'

    columns = ",\n  ".join(column(name, kind) for name, kind in _pairs(spec))
    return f"SELECT {columns}\nFROM (\n{query}\n) result"
