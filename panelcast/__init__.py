"""Panel forecasting analytics on Spark DataFrames.

A *panel* is a set of daily series: one row per (series keys, date) with a
numeric measure.  Every function here takes DataFrames or Columns and returns
DataFrames or Columns; nothing is collected unless a docstring says so.
"""

from panelcast.config import DiagnosticsSpec, DirectSpec, FeatureSpec, PanelSpec, RunConfig, SplitSpec

__version__ = "0.2.0"

__all__ = ["DiagnosticsSpec", "DirectSpec", "FeatureSpec", "PanelSpec", "RunConfig", "SplitSpec"]
