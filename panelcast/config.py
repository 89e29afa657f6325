"""Parameters of a run, with the retail case's values as defaults."""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass, field

INF = float("inf")


@dataclass(frozen=True)
class PanelSpec:
    """Names of the series keys, the day column and the measure."""

    keys: tuple[str, ...] = ("store_nbr", "family")
    date: str = "date"
    value: str = "sales"


@dataclass(frozen=True)
class FeatureSpec:
    """Lags and windows are counted in rows of one series (days on a dense panel)."""

    lags: tuple[int, ...] = (7, 14, 28, 365)
    windows: tuple[int, ...] = (7, 14, 28)
    spike_sigmas: float = 2.0
    spike_min_days: int = 30
    epsilon: float = 1e-6

    @property
    def long_window(self) -> int:
        return max(self.windows)

    @property
    def rolling_columns(self) -> list[str]:
        return (
            [f"rolling_mean_{n}" for n in self.windows]
            + [f"rolling_std_{n}" for n in self.windows]
            + [f"rolling_cv_{self.long_window}"]
        )

    @property
    def trend_columns(self) -> list[str]:
        long = self.long_window
        shorter = [n for n in self.windows if n != long]
        return (
            [f"momentum_{n}_{long}" for n in shorter]
            + [f"trend_{n}_{long}" for n in shorter[:1]]
            + ["yearly_ratio"]
        )

    @property
    def spike_columns(self) -> list[str]:
        return ["historical_spike_rate"]

    @property
    def origin_columns(self) -> list[str]:
        """Features known at the forecast origin, in model order."""
        return self.rolling_columns + self.trend_columns + self.spike_columns


@dataclass(frozen=True)
class DirectSpec:
    """Horizons of the direct dataset and the lags aligned to the target day."""

    horizons: tuple[int, ...] = tuple(range(1, 16))
    aligned_lags: tuple[int, ...] = (7, 14, 28, 365)
    # store attributes carried next to the series keys
    static_columns: tuple[str, ...] = ("store_type", "city", "state", "store_cluster")


# The retail case's split date and forecast origins.
@dataclass(frozen=True)
class SplitSpec:
    split_date: dt.date = dt.date(2017, 7, 1)
    history_years: int = 1
    baseline_origins: tuple[dt.date, ...] = (
        dt.date(2017, 6, 30),
        dt.date(2017, 7, 15),
        dt.date(2017, 7, 30),
    )
    extra_origins: tuple[dt.date, ...] = (dt.date(2017, 7, 10),)
    # require target_date <= train_end, so that no training target lies in the validation period
    purge_horizon: bool = False

    @property
    def validation_origins(self) -> tuple[dt.date, ...]:
        return self.baseline_origins + self.extra_origins

    @property
    def train_start(self) -> dt.date:
        year = self.split_date.year - self.history_years
        try:
            return self.split_date.replace(year=year)
        except ValueError:  # 29 February
            return self.split_date.replace(year=year, day=28)

    @property
    def train_end(self) -> dt.date:
        return self.split_date - dt.timedelta(days=1)


# Thresholds, bin edges and list lengths of the diagnostics.
@dataclass(frozen=True)
class DiagnosticsSpec:
    tail_threshold: float = 1000.0
    severe_ratio: float = 0.5
    well_low: float = 0.75
    well_high: float = 1.25
    spike_edges: tuple[float, ...] = (1000, 2000, 5000, 10000, 20000, INF)
    spike_labels: tuple[str, ...] = ("1000-2000", "2000-5000", "5000-10000", "10000-20000", ">20000")
    coverage_edges: tuple[float, ...] = (-INF, 0.25, 0.50, 0.75, 1.00, 1.25, 1.50, INF)
    coverage_labels: tuple[str, ...] = (
        "<25%", "25%-50%", "50%-75%", "75%-100%", "100%-125%", "125%-150%", ">150%",
    )
    level_edges: tuple[float, ...] = (-INF, 0, 10, 50, 200, 1000, INF)
    level_labels: tuple[str, ...] = (
        "0", "0 < sales <= 10", "10 < sales <= 50", "50 < sales <= 200", "200 < sales <= 1000", "> 1000",
    )
    tail_list: int = 30
    severe_list: int = 30
    store_list: int = 10
    series_list: int = 30
    worst_list: int = 20
    sample_size: int = 3000
    seed: int = 42


# The words that mark a model column as a history feature.
HISTORY_WORDS = ("lag", "rolling", "ma_", "mean", "max", "min", "std")

CATEGORICAL_FEATURES = ("store_nbr", "family", "store_type", "city", "state", "store_cluster")


def model_features(features: FeatureSpec = FeatureSpec(), lags: tuple[int, ...] = (28, 365)) -> list[str]:
    """The model's input columns: categoricals, target calendar, lags, origin features, horizon."""
    return (
        list(CATEGORICAL_FEATURES)
        + ["day_of_week", "month"]
        + [f"lag_{k}" for k in lags]
        + features.rolling_columns
        + ["horizon"]
        + features.trend_columns
        + features.spike_columns
    )


@dataclass(frozen=True)
class RunConfig:
    """Where a run writes.  Paths are plain strings, so any Hadoop file system works."""

    output_dir: str = field(default_factory=lambda: os.environ.get("PANELCAST_OUTPUT_DIR", "outputs"))
    run_tag: str = "1yr_h15"

    def path(self, kind: str, name: str) -> str:
        return "/".join([self.output_dir.rstrip("/"), self.run_tag, kind, name])

    def dataset(self, name: str) -> str:
        return self.path("datasets", name)

    def model(self, name: str) -> str:
        return self.path("models", name)

    def predictions(self, name: str) -> str:
        return self.path("predictions", name)

    def report(self, name: str) -> str:
        return self.path("reports", name)
