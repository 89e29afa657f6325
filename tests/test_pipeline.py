import datetime as dt

import numpy as np
import pytest

from panelcast.config import DiagnosticsSpec, RunConfig, SplitSpec
from panelcast.operators.model import ModelSpec
from panelcast.plans import pipeline
from panelcast.sources import read_tables

START, DAYS = dt.date(2016, 1, 1), 580
SPECS = pipeline.Specs(
    split=SplitSpec(
        split_date=dt.date(2017, 7, 1),
        baseline_origins=(dt.date(2017, 6, 30), dt.date(2017, 7, 10)),
        extra_origins=(dt.date(2017, 7, 5),),
    ),
    diagnostics=DiagnosticsSpec(tail_threshold=60, sample_size=10),
    model=ModelSpec(max_trees=3, max_depth=4, learning_rate=0.5, patience=2),
)


@pytest.fixture(scope="module")
def csv_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    rng = np.random.default_rng(5)
    lines = []
    for store in (1, 2):
        for family in ("BREAD", "CLEANING"):
            level = 20 * store + (25 if family == "BREAD" else 0)
            for i in range(DAYS):
                day = START + dt.timedelta(days=i)
                sales = max(0, level + 15 * (day.weekday() >= 5) + rng.normal(0, 5 * store))
                lines.append(f"{len(lines)},{day},{store},{family},{sales:.2f},{i % 3}")
    (folder / "train.csv").write_text("id,date,store_nbr,family,sales,onpromotion\n" + "\n".join(lines) + "\n")
    (folder / "test.csv").write_text("id,date,store_nbr,family,onpromotion\n0,2017-08-16,1,BREAD,0\n")
    (folder / "stores.csv").write_text("store_nbr,city,state,type,cluster\n1,Quito,Pichincha,A,3\n2,Ambato,Tungurahua,C,5\n")
    (folder / "oil.csv").write_text("date,dcoilwtico\n2016-01-01,\n2016-01-04,36.81\n")
    (folder / "holidays_events.csv").write_text(
        "date,type,locale,locale_name,description,transferred\n"
        "2016-12-25,Holiday,National,Ecuador,Navidad,False\n2017-05-14,Event,National,Ecuador,Dia de la Madre,False\n"
    )
    (folder / "transactions.csv").write_text("date,store_nbr,transactions\n2016-01-02,1,770\n")
    return str(folder)


def test_whole_run(spark, csv_folder, tmp_path):
    tables = read_tables(spark, csv_folder)
    assert {n: t.count() for n, t in tables.items() if n != "train"} == {
        "test": 1, "stores": 2, "oil": 2, "holidays": 2, "transactions": 1,
    }
    flags = pipeline.enriched_panel(tables)
    assert flags.where("is_holiday = 1").count() == 4 and flags.where("is_mothers_day = 1").count() == 4

    config = RunConfig(output_dir=str(tmp_path), run_tag="t")
    result = pipeline.run(spark, tables, [csv_folder], config, SPECS, permutations=2)
    assert result.validation.count() == 3 * 4 * 15
    assert result.train.where("date > '2017-06-30'").count() == 0
    assert result.reports["completeness"].first().complete
    assert result.tail.where("target <= 60").count() == 0 and result.tail.count() > 0
    assert set(result.scored.columns) >= {"prediction", "prediction_confidence", "abs_error"}

    # the table of days to come, fourteen of them after the last known one
    ahead = result.forecast.collect()
    assert [(r.store_nbr, r.family, r.horizon) for r in ahead] == [(1, "BREAD", 14)] and ahead[0].prediction > 0

    small = {"error_by_horizon": 15, "error_by_origin": 3, "confidence_validation": 3, "tail_coverage": 7,
             "signal_numeric": 17, "importance": 23, "attribution": 23, "model_comparison": 3,
             "baseline_persistence": 30, "baseline_weekly": 30, "eval_origin_horizon": 45}
    for name, rows in small.items():
        assert result.reports[name].count() == rows, name
    models = {r.model: r.average_wape for r in result.reports["model_comparison"].collect()}
    assert models["boosted_trees"] < models["persistence"]

    # a second run answers from the artifacts: same files, same scores
    again = pipeline.run(spark, tables, [csv_folder], config, SPECS, permutations=2)
    assert sorted(again.scored.inputFiles()) == sorted(result.scored.inputFiles())
    # other inputs get artifacts of their own
    other = pipeline.parameter_key("other", SPECS.panel)
    assert other != pipeline.parameter_key(csv_folder, SPECS.panel)

    chosen = {n: result.reports[n] for n in ("eval_overall", "severe_by_family")}
    pipeline.write_reports(pipeline.RunResult(*[None] * 5, reports=chosen), config)
    assert spark.read.option("header", True).csv(config.report("eval_overall")).count() == 1


def test_densified_run_equals_dense_input(spark, csv_folder):
    tables = read_tables(spark, csv_folder)
    dense = pipeline.prepared_panel(tables, SPECS)
    holes = dict(tables, train=tables["train"].where("date <> '2016-05-05' or sales = 0"))
    filled = pipeline.prepared_panel(holes, pipeline.Specs(densify=True))
    assert dense.count() == filled.count()
    day = filled.where("date = '2016-05-05'").select("sales").distinct().collect()
    assert [r.sales for r in day] == [0.0]


def test_folded_run_adds_up_rows_of_a_day(spark, csv_folder):
    tables = read_tables(spark, csv_folder)
    twice = dict(tables, train=tables["train"].union(tables["train"]))
    folded = pipeline.prepared_panel(twice, pipeline.Specs(fold=True))
    assert folded.count() == tables["train"].count()
    sums = [t.selectExpr("sum(sales)").first()[0] for t in (folded, twice["train"])]
    assert sums[0] == pytest.approx(sums[1])
