from panelcast.functions.columns import (
    contains_text, ratio_or_null, right_closed_bins, safe_ratio, series_label, to_number,
)
from panelcast.functions.metrics import bias_columns, error_columns, metric_columns
from panelcast.functions.quantiles import exact_quantiles
from panelcast.functions.rolling import expanding_mean

__all__ = [
    "bias_columns", "contains_text", "error_columns", "exact_quantiles", "expanding_mean", "metric_columns",
    "ratio_or_null", "right_closed_bins", "safe_ratio", "series_label", "to_number",
]
