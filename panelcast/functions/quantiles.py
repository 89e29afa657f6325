"""Exact, linearly interpolated quantiles without one big value map.

Spark's ``percentile`` and ``median`` merge a map of all distinct values in one
task.  Here a bounded sketch brackets each wanted rank, a second pass counts the
rows below the bracket and the distinct values inside it (about ``8 / accuracy``
of the rows), and a histogram of the bracket picks the one cell that holds the
rank, so that only that cell's values are ever put in order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CELLS = 1024


def exact_quantiles(
    df: DataFrame,
    value: str | Column,
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    accuracy: int = 20_000,
    bounded_groups: bool = False,
    wanted: Mapping[str, Column] | None = None,
    mean: bool = False,
) -> DataFrame:
    """One row per group with ``n`` (non-null values) and one column per entry of ``probs``.

    Without ``by`` the result is one row, with nulls for empty input.  The ``by``
    columns must not be null.  Set ``bounded_groups`` only when the number of groups is
    fixed by the caller (a list of features, a list of horizons): the brackets are then
    broadcast.  Otherwise Spark picks the join, so any number of groups works and adaptive
    execution splits a hot one.

    ``wanted`` holds conditions on the ``by`` columns for entries of ``probs`` that only some
    groups need; they are null elsewhere.  ``mean`` adds the mean of the values.
    """
    names = list(probs)
    asked = {name: (wanted or {}).get(name, F.lit(True)) for name in names}
    means = [F.avg("_v").alias("mean")] if mean else []
    carried = ["n", "mean"] if mean else ["n"]
    by = list(by)
    margin = 4.0 / accuracy
    column = F.col(value) if isinstance(value, str) else value
    values = df.select(*by, column.cast("double").alias("_v")).where(F.col("_v").isNotNull())

    ends: list[float] = []
    for name in names:
        ends += [max(probs[name] - margin, 0.0), min(probs[name] + margin, 1.0)]
    # a group of at most `accuracy` values is its own bracket: there the margin could be less than a rank
    whole = F.array(*[F.min("_v"), F.max("_v")] * len(names))
    sketch = values.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.when(F.count("*") <= accuracy, whole)
        .otherwise(F.percentile_approx("_v", ends, accuracy))
        .alias("ends"),
        *means,
    )
    if by:
        marked = values.join(F.broadcast(sketch) if bounded_groups else sketch, by)
    else:
        # one-row aggregate: a scalar subquery, evaluated once
        bracket = sketch.select(F.struct("ends", *carried)).scalar()
        marked = values.select("_v", bracket.alias("b")).select("_v", "b.*")

    # one struct per wanted rank; a null value stands for every value below the bracket,
    # and values above it do not matter
    low_end = [F.col("ends").getItem(2 * i) for i in range(len(names))]
    high_end = [F.col("ends").getItem(2 * i + 1) for i in range(len(names))]
    per_rank = [
        F.struct(
            F.lit(i).alias("q"),
            F.when(F.col("_v") >= low_end[i], F.col("_v")).alias("v"),
            ((F.col("_v") <= high_end[i]) & asked[names[i]]).alias("keep"),
            low_end[i].alias("low"),
            (high_end[i] - low_end[i]).alias("width"),
            (F.lit(float(probs[name])) * (F.col("n") - 1)).alias("place"),
        )
        for i, name in enumerate(names)
    ]
    cell = (
        F.when(F.col("v").isNull(), -1)
        .when(F.max("width") > 0, F.floor((F.col("v") - F.max("low")) / F.max("width") * _CELLS))
        .otherwise(0)
    )
    counted = (
        marked.select(*by, *carried, F.inline(F.array(*per_rank)))
        .where("keep")
        # what belongs to the group and rank is part of the key: both uses below then need the same
        # columns, and Spark makes this exchange once for both
        .groupBy(*by, "q", "v", "place", *carried)
        .agg(F.count("*").alias("m"), cell.alias("cell"))
    )

    # ranks covered by each cell (at most _CELLS + 2 of them per rank), then by each value of the cells kept
    cells = counted.groupBy(*by, "q", "cell").agg(F.sum("m").alias("size"), F.max("place").alias("place"))
    in_order = Window.partitionBy(*by, "q").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn("upto", F.sum("size").over(in_order)).select(
        *by, "q", "cell", (F.col("upto") - F.col("size")).alias("start"), "upto", "place"
    )
    covers = lambda rank: (rank < F.col("upto")) & (rank >= F.col("start"))
    low_rank, high_rank = F.floor("place"), F.ceil("place")
    wanted = cells.where(covers(low_rank) | covers(high_rank)).drop("upto", "place")
    in_cell = Window.partitionBy(*by, "q", "cell").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.join(wanted, [*by, "q", "cell"]).withColumn(
        "upto", F.col("start") + F.sum("m").over(in_cell)
    ).withColumn("start", F.col("upto") - F.col("m"))

    outputs = [F.coalesce(F.max("n"), F.lit(0)).alias("n")] + [F.max("mean").alias("mean")] * len(means)
    for i, name in enumerate(names):
        this = F.col("q") == i
        low = F.max(F.when(this & covers(low_rank), F.col("v")))
        high = F.max(F.when(this & covers(high_rank), F.col("v")))
        share = F.max(F.when(this, F.col("place") - low_rank))
        missed = F.raise_error(F.lit(f"rank of quantile {name} outside its bracket")).cast("double")
        outputs.append(
            F.when(F.max("n").isNull() | ~asked[name], F.lit(None).cast("double"))
            .when(low.isNull() | high.isNull(), missed)
            .otherwise(low + (high - low) * share)
            .alias(name)
        )
    return ranked.groupBy(*by).agg(*outputs)
