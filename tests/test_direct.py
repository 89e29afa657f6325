import datetime as dt
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.config import DirectSpec, SplitSpec
from panelcast.operators.direct import (
    at_origins, build_direct, in_training, overlap_audit, split_overlap, tail_slices, training_rows, validation_rows,
)
from panelcast.operators.features import add_features

RNG = np.random.default_rng(3)
START = dt.date(2020, 1, 1)
VALUES = {(1, "a"): list(RNG.integers(1, 90, 430)), (2, "b"): list(RNG.integers(0, 20, 430))}


@pytest.fixture(scope="module")
def direct(spark):
    rows = [
        (s, f, START + dt.timedelta(days=i), float(v), i) for (s, f), vs in VALUES.items() for i, v in enumerate(vs)
    ]
    panel = spark.createDataFrame(rows, "store_nbr int, family string, date date, sales double, mark int")
    return build_direct(add_features(panel), target_columns=("mark",), extra_columns=("mark",)).cache()


def test_values_sit_at_their_distance(direct):
    for row in direct.collect():
        values = VALUES[(row.store_nbr, row.family)]
        i = (row.date - START).days
        h = row.horizon
        assert row.origin_sales == values[i] and row.target == values[i + h]
        assert row.target_date == row.date + dt.timedelta(days=h)
        assert row.day_of_week == row.target_date.weekday() and row.month == row.target_date.month
        assert row.target_mark == i + h and row.mark == i
        for k in (7, 14, 28, 365):
            assert row[f"lag_{k}"] == (values[i + h - k] if h <= k else None)


def test_rows_need_history_and_target(direct):
    first, last, n = direct.agg(F.min("date"), F.max("date"), F.count("*")).first()
    # 365 earlier rows for the yearly lag of the origin, one later row for the shortest horizon
    assert (first - START).days == 365 and (last - START).days == 430 - 1 - 1
    per_horizon = {r.horizon: r["count"] for r in direct.groupBy("horizon").count().collect()}
    assert per_horizon == {h: 2 * (430 - 365 - h) for h in range(1, 16)}
    assert n == sum(per_horizon.values())


def test_one_horizon_equals_its_slice(make_series, direct):
    panel = add_features(make_series(VALUES))
    one = build_direct(panel, DirectSpec(horizons=(9,)))
    kept = direct.where("horizon = 9").select(one.columns)
    assert one.exceptAll(kept).count() == 0 and kept.exceptAll(one).count() == 0


def test_gaps_shift_by_row_not_by_day(make_series):
    dense = make_series({(1, "a"): range(430)})
    gappy = dense.where("date <> '2021-01-20'")
    row = build_direct(add_features(gappy)).where("date = '2021-01-19' and horizon = 1").first()
    assert row.target == (dt.date(2021, 1, 21) - START).days and row.target_date == dt.date(2021, 1, 20)


def test_slices(direct):
    split = SplitSpec(
        split_date=dt.date(2021, 2, 1),
        baseline_origins=(dt.date(2021, 1, 31), dt.date(2021, 2, 10)),
        extra_origins=(dt.date(2021, 2, 5),),
    )
    assert (split.train_start, split.train_end) == (dt.date(2020, 2, 1), dt.date(2021, 1, 31))
    train = training_rows(direct, split)
    purged = training_rows(direct, replace(split, purge_horizon=True))
    valid = validation_rows(direct, split)
    assert train.agg(F.max("date")).first()[0] == split.train_end
    assert purged.agg(F.max("target_date")).first()[0] == split.train_end
    assert valid.count() == 2 * 15 * 3
    audit = overlap_audit(direct, split).first()
    assert audit.shared_rows == 2 * 15
    assert (audit.train_rows, audit.validation_rows) == (train.count(), valid.count())
    assert audit.train_targets_after_split == train.count() - purged.count()
    same = split_overlap(train, valid, split).first()
    assert same.asDict() == audit.asDict()
    counts = tail_slices(direct, 40, split).first()
    assert counts.tail_train_rows == train.where("target > 40").count()
    assert counts.tail_valid_rows == direct.where(at_origins(split.baseline_origins)).where("target > 40").count()
    assert direct.where(in_training(split)).count() == train.count()


def test_leap_day_split():
    assert SplitSpec(split_date=dt.date(2020, 2, 29)).train_start == dt.date(2019, 2, 28)


def test_origin_filter_equals_later_filter(make_series, direct):
    origins = (dt.date(2021, 1, 10), dt.date(2021, 1, 20))
    early = build_direct(add_features(make_series(VALUES)), origins=at_origins(origins))
    late = direct.where(at_origins(origins)).select(early.columns)
    assert early.count() == late.count() == 2 * 2 * 15
    assert early.exceptAll(late).count() == 0


def test_store_attributes_join_the_series(spark, make_series):
    stores = spark.createDataFrame([(1, "Quito", "P", "A", 3)], "store_nbr int, city string, state string, type string, cluster int")
    rows = build_direct(add_features(make_series(VALUES)), stores=stores)
    cities = {(r.store_nbr, r.city, r.store_type) for r in rows.select("store_nbr", "city", "store_type").distinct().collect()}
    assert cities == {(1, "Quito", "A"), (2, None, None)}


def exchanges(df, column):
    """Shuffles of a physical plan: (all, those that carry ``column``), and the scanned files' names."""
    found, files = [], []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.inputPlan())
        if name == "Exchange":
            output = node.output()
            found.append({output.apply(i).name() for i in range(output.size())})
        if name.startswith("Scan"):
            files.append(node.toString())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return len(found), sum(column in names for names in found), files


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_plan_moves_rows_once(spark, data, broadcast):
    from panelcast.plans import warehouse

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        rows = warehouse.direct(spark, data, target_columns=("onpromotion",))
        plan = rows._jdf.queryExecution().executedPlan().toString()
        moves, with_measures, files = exchanges(rows, "sales")
        # measures are placed by series once; the series' table, the stores and their regions move on their own
        assert with_measures == 1
        assert moves <= 4 or broadcast == "-1"
        # the panel is read once, and the other read is that of the series' keys; the shipments were read when they were folded
        folded = [f for f in files if "ReadSchema: struct<store_nbr" in f]
        assert len(folded) == 2 and sum("sales" in f for f in folded) == 1
        assert not any("lineitem" in f for f in files)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        values = rows.groupBy("horizon").agg(F.count("*"), F.sum("target"), F.sum("target_onpromotion"), F.count("city")).orderBy("horizon").collect()
        assert len(values) == 15 and all(r[1] == r[4] for r in values)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["promotion_test", "direct_all_summary"])
def test_shipments_are_read_once(spark, data, name, monkeypatch):
    """One scan of the shipments, when they are folded, whatever the query reads of them."""
    from panelcast.plans import catalog, warehouse

    reads = []
    read = warehouse.table
    monkeypatch.setattr(warehouse, "table", lambda s, folder, table: reads.append(table) or read(s, folder, table))
    result = catalog.queries()[name](spark, data)
    assert reads.count("lineitem") == 1
    _, _, files = exchanges(result, "sales")
    assert not any("lineitem" in f for f in files) and result.count() > 0


def test_rows_without_series_key_and_unknown_stores(spark, make_series):
    panel = add_features(make_series({(1, "a"): range(430), (None, "b"): range(430), (3, None): range(430)}))
    stores = spark.createDataFrame([(1, "Q", "P", "A", 3), (1, "Q", "P", "A", 3)], "store_nbr int, city string, state string, type string, cluster int")
    rows = build_direct(panel, DirectSpec(horizons=(1,)), stores=stores.distinct())
    assert {(r.store_nbr, r.city) for r in rows.collect()} == {(1, "Q")}
    assert build_direct(panel, DirectSpec(horizons=(1,)), stores=stores.limit(0)).where("city IS NULL AND store_nbr = 1").count() == rows.count()
