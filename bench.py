"""Time the headline jobs: one JSON line on standard output.

``BENCH_SF_DIR`` names the data folder and ``BENCH_CPUS`` the local cores.  Each job runs
whole, from the Parquet scan to its last row, after a short warm-up of the session.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelcast.operators import reports  # noqa: E402
from panelcast.plans import catalog  # noqa: E402
from panelcast.plans import warehouse as w  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
DIAGNOSTICS = (
    "confidence_validation", "error_by_horizon", "error_by_sales_level", "bias_by_horizon", "tail_overall", "tail_spike_severity",
    "severe_by_family", "series_concentration", "signal_numeric",
)


def session() -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def diagnostics(spark: SparkSession) -> None:
    """Score once into a table, then the error reports from three reads of it."""
    tables = reports.report_tables(w.scored_table(spark, FOLDER), catalog.MODEL_FEATURES, spec=w.DIAGNOSTICS)
    made = reports.sliced_reports(tables)
    for name in DIAGNOSTICS:
        run(made[name])


def jobs(spark: SparkSession) -> dict:
    query = lambda name: lambda: run(catalog.CHECKED[name](spark, FOLDER))
    return {
        "panel_build": query("panel"),
        "daily_total": query("daily_total"),
        "holiday_flags": query("holiday_flags"),
        "feature_build": lambda: run(w.featured(spark, FOLDER)),
        "direct_all_horizons": lambda: run(w.direct(spark, FOLDER)),
        "valid_slice": query("valid_slice"),
        "naive_scores": query("naive_scores"),
        "seasonal_scores": query("seasonal_scores"),
        "model_comparison": query("model_comparison"),
        "sales_summary": query("sales_summary"),
        "eval_horizon_average": query("eval_horizon_average"),
        "all_diagnostics": lambda: diagnostics(spark),
    }


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    run(w.featured(spark, FOLDER))  # start the JVM's compilers and the file cache
    seconds = {}
    for name, job in jobs(spark).items():
        started = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - started, 3)
    scale = os.path.basename(FOLDER.rstrip("/"))
    print(
        json.dumps(
            {
                "metric": "headline_jobs_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": scale.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
