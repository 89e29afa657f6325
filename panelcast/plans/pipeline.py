"""The whole case: six tables in, datasets, model, scored rows and report tables out.

Every dataset is written once and read back, so each later step starts from Parquet: the
reports never recompute the features, and a lost executor costs a re-read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast import __version__
from panelcast.config import DiagnosticsSpec, DirectSpec, FeatureSpec, PanelSpec, RunConfig, SplitSpec
from panelcast.operators import baselines, confidence, eda, enrich, errors, explain, profile, severe, signal
from panelcast.operators import model as models
from panelcast.operators import reports as sliced
from panelcast.operators import tail as tails
from panelcast.operators.direct import (
    at_origins, build_direct, in_training, split_overlap, training_rows, validation_rows,
)
from panelcast.operators.features import add_features
from panelcast.operators.forecast import answer, future_rows
from panelcast.operators.panel import by_series, daily_panel, densify_calendar
from panelcast.sources.sinks import input_state, materialize, parameter_key, read_or_build, write_report
from panelcast.sources.tables import TableSet

# Decimals of the report columns.
REPORT_DECIMALS = {
    "mae": 3, "rmse": 3, "wape": 4, "mean_error": 3, "median_error": 3, "mean_ratio": 3, "severe_rate": 2,
    "severe_rate_pct": 2, "percentage": 2, "severe_pct": 2, "well_pct": 2, "difference_pct": 2,
}

# Row order of the report tables; "-" is descending.
REPORT_ORDER = {
    "daily_total": ("date",),
    "monthly_seasonality": ("month",),
    "weekly_seasonality": ("weekday",),
    "baseline_persistence": ("origin", "horizon"),
    "baseline_weekly": ("origin", "horizon"),
    "confidence_validation": ("tier_order",),
    "tail_by_horizon": ("horizon",),
    "tail_by_origin": ("origin",),
    "tail_spike_severity": ("level_order",),
    "tail_largest_under": ("error",),
    "tail_coverage": ("level_order",),
    "severe_by_family": ("-severe_count", "family"),
    "severe_by_store": ("-severe_count", "store_nbr"),
    "severe_by_horizon": ("horizon",),
    "severe_by_origin": ("origin",),
    "severe_history_compare": ("-abs(mean_difference)", "feature"),
    "severe_worst": ("prediction_ratio",),
    "series_concentration": ("-severe_count", "-severe_rate", "series"),
    "signal_numeric": ("-abs(relative_mean_difference_pct)", "feature"),
    "signal_categorical": ("feature", "-abs(difference_pct)", "level"),
    "error_by_horizon": ("horizon",),
    "error_by_origin": ("origin",),
    "error_by_sales_level": ("level_order",),
    "bias_by_horizon": ("horizon",),
    "worst_predictions": ("-absolute_error",),
    "eval_origin_horizon": ("origin", "horizon"),
    "eval_horizon_average": ("horizon",),
    "model_comparison": ("-average_wape",),
    "importance": ("-importance", "feature"),
    "attribution": ("-mean_abs_shapley", "feature"),
}


@dataclass(frozen=True)
class Specs:
    panel: PanelSpec = PanelSpec()
    features: FeatureSpec = FeatureSpec()
    direct: DirectSpec = DirectSpec()
    split: SplitSpec = SplitSpec()
    diagnostics: DiagnosticsSpec = DiagnosticsSpec()
    model: models.ModelSpec = models.ModelSpec()
    # add up rows of the same series and day first; off takes the days of a series to be unique
    fold: bool = False
    # fill missing days with zeros, so that a row step is a day step; off keeps the rows as given
    densify: bool = False


@dataclass
class RunResult:
    train: DataFrame
    validation: DataFrame
    model: models.FittedModel
    scored: DataFrame
    tail: DataFrame
    reports: dict[str, DataFrame] = field(default_factory=dict)
    # the rows of the ``test`` table with their predictions, if there is such a table
    forecast: DataFrame | None = None


def placed_panel(tables: TableSet, specs: Specs) -> DataFrame:
    """The fact table with one row per series and day, placed by series: what baselines and model both see."""
    measures = ("sales", "onpromotion")
    train = tables["train"].select(*specs.panel.keys, "date", *measures)
    if specs.fold:
        keys = {k: F.col(k) for k in specs.panel.keys}
        train = daily_panel(train, keys, F.col("date"), {m: F.sum(m) for m in measures}, specs.panel)
    if specs.densify:
        ends = train.agg(F.min("date"), F.max("date")).first()
        return densify_calendar(train, ends[0], ends[1], measures, specs.panel)
    return by_series(train, specs.panel)


def prepared_panel(tables: TableSet, specs: Specs, placed: DataFrame | None = None) -> DataFrame:
    """The placed panel, built or as given, with its features."""
    return add_features(placed_panel(tables, specs) if placed is None else placed, specs.features, specs.panel)


def enriched_panel(tables: TableSet) -> DataFrame:
    """The fact table with store attributes, calendar flags, weekday and month."""
    return enrich.enrich(tables["train"], tables["stores"], tables["holidays"])


def direct_rows(tables: TableSet, specs: Specs, origins, placed: DataFrame | None = None) -> DataFrame:
    return build_direct(
        prepared_panel(tables, specs, placed),
        specs.direct,
        specs.features,
        specs.panel,
        origins=origins,
        target_columns=("onpromotion",),
        stores=tables["stores"],
        series=tables["train"] if placed is None else placed,
    )


def baseline_reports(placed: DataFrame, specs: Specs, origin_rows: DataFrame) -> dict[str, DataFrame]:
    """Scores of persistence and weekly seasonal naive on the main origins of the placed panel."""
    origins = specs.split.baseline_origins
    at_main = origin_rows.where(at_origins(origins, specs.panel))
    seasonal = baselines.weekly_seasonal_naive(placed, origins, specs.direct, specs.panel)
    return {
        "baseline_persistence": baselines.score_cells(baselines.persistence_forecast(at_main), "date"),
        "baseline_weekly": baselines.score_cells(seasonal),
    }


def exploration_reports(tables: TableSet) -> dict[str, DataFrame]:
    daily = eda.daily_total(tables["train"])
    return {
        "daily_total": daily,
        "flag_audit": profile.flag_audit(enriched_panel(tables), enrich.CALENDAR_FLAGS),
        "monthly_seasonality": eda.monthly_seasonality(daily),
        "weekly_seasonality": eda.weekly_seasonality(daily),
    }


def diagnostic_reports(
    scored: DataFrame, tail: DataFrame, training: DataFrame, specs: Specs
) -> dict[str, DataFrame]:
    """All error tables of the scored rows and of their tail.

    The sliced ones come from three reads of the scored rows; lists and category shares are read apart.
    """
    d = specs.diagnostics
    names = list(specs.model.features)
    categorical = signal.split_features(names, specs.model.categorical)[1]
    domain = signal.category_domain(training, categorical)
    tables = sliced.report_tables(scored, names, specs.model.categorical, d)
    return sliced.sliced_reports(tables) | {
        "tail_largest_under": tails.largest_underpredictions(tail, d),
        "severe_worst": severe.worst_severe(tail, d),
        "signal_categorical": signal.categorical_signal(tail, categorical, domain, d),
        "worst_predictions": errors.worst_predictions(scored, d),
    }


def fit_or_load(path: str, training: DataFrame | Callable[[], DataFrame], validation: DataFrame, spec: models.ModelSpec) -> models.FittedModel:
    """Reuse the model saved under ``path``, else fit it, from the trees that a broken run left there, and save it."""
    try:
        return models.FittedModel.load(path)
    except (AnalysisException, models.IncompleteModel):
        # a fit reads its rows many times: a function builds and writes them only if they are needed
        rows = training() if callable(training) else training
        fitted = models.fit(rows, validation, spec, path)
        fitted.save(path)
        return fitted


def run(
    spark: SparkSession,
    tables: TableSet,
    inputs: Sequence[object],
    config: RunConfig = RunConfig(),
    specs: Specs = Specs(),
    sample_size: int | None = None,
    permutations: int = 4,
) -> RunResult:
    """Build or reuse every artifact of a run and return the scored rows and all reports.

    ``inputs`` identifies the input data (paths, versions); with the state of the tables' files,
    the package's version and the parameters it keys the artifacts, so a changed input is never
    answered from old ones.
    """
    split, d = specs.split, specs.diagnostics
    origin = (*inputs, input_state(tables), __version__)
    key = parameter_key(*origin, specs.panel, specs.features, specs.direct, split, specs.fold, specs.densify)

    # folded and filled once, for model and baselines; a table read back has to be placed again
    written = materialize(placed_panel(tables, specs), "placed")
    placed = by_series(written, specs.panel)

    # features and horizons are computed once, for the training period and the origins together
    wanted = in_training(split, specs.panel) | at_origins(split.validation_origins, specs.panel)
    direct = read_or_build(
        spark,
        config.dataset("direct"),
        key,
        lambda: direct_rows(tables, specs, wanted, placed),
        partition_by=("horizon",),
    )
    training = training_rows(direct, split, specs.panel)
    validation = read_or_build(
        spark, config.dataset("validation"), key, lambda: validation_rows(direct, split, specs.panel)
    )
    models.same_features(training, validation, specs.model)

    model_key = parameter_key(key, specs.model)
    fitted = fit_or_load(f"{config.model('boosted_trees')}/{model_key}", training, validation, specs.model)

    def score():
        return confidence.add_confidence(fitted.score(validation))

    scored = read_or_build(spark, config.predictions("scored"), parameter_key(model_key, d), score)
    tail = read_or_build(
        spark,
        config.predictions("tail"),
        parameter_key(model_key, d),
        lambda: tails.tail_rows(scored, d.tail_threshold),
    )
    forecast = None
    if "test" in tables:

        def ahead():
            last = written.agg(F.max("date")).first()[0]
            rows = future_rows(
                prepared_panel(tables, specs, placed), last, specs.direct, specs.features, specs.panel, tables["stores"], written
            )
            return answer(tables["test"], fitted.score(rows), specs.panel)

        forecast = read_or_build(spark, config.predictions("forecast"), model_key, ahead)
    result = RunResult(training, validation, fitted, scored, tail, forecast=forecast)
    reports = result.reports
    reports |= exploration_reports(tables)
    reports |= baseline_reports(written, specs, validation)
    reports["completeness"] = models.completeness(validation, scored)
    reports["overlap_audit"] = split_overlap(training, validation, split, specs.panel)
    reports |= diagnostic_reports(scored, tail, training, specs)
    reports["model_comparison"] = baselines.compare_models(
        {
            "persistence": reports["baseline_persistence"],
            "weekly_seasonal": reports["baseline_weekly"],
            "boosted_trees": reports["eval_origin_horizon"].where(F.col("origin").isin(list(split.baseline_origins))),
        },
        "boosted_trees",
    )
    reports["importance"] = explain.importance(fitted)
    values = explain.shapley_values(fitted, validation, sample_size or d.sample_size, permutations, d.seed)
    reports["attribution"] = explain.global_attribution(values)
    return result


def write_reports(result: RunResult, config: RunConfig, fmt: str = "csv") -> None:
    """Write every report table below the run's ``reports`` folder."""
    for name, table in result.reports.items():
        write_report(table, config.report(name), REPORT_DECIMALS, REPORT_ORDER.get(name, ()), fmt)
