"""Profiling of any table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.columns import ratio_or_null
from panelcast.functions.quantiles import exact_quantiles


def table_shapes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""
    stacked = None
    for name, df in tables.items():
        part = df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked


def _per_column(df: DataFrame, aggregate, name: str, extra=None) -> DataFrame:
    """One aggregation with one expression per column, turned into one row per column."""
    values = df.agg(*[aggregate(F.col(c)).alias(f"_{i}") for i, c in enumerate(df.columns)])
    rows = [
        F.struct(F.lit(c).alias("column_name"), *(extra(c) if extra else []), F.col(f"_{i}").alias(name))
        for i, c in enumerate(df.columns)
    ]
    return values.select(F.inline(F.array(*rows)))


def schema_profile(df: DataFrame) -> DataFrame:
    """Type and non-null count of each column."""
    return _per_column(
        df, F.count, "non_null", lambda c: [F.lit(df.schema[c].dataType.simpleString()).alias("data_type")]
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Null count of each column."""
    return _per_column(df, lambda c: F.count_if(c.isNull()), "nulls")


def total_nulls(df: DataFrame) -> DataFrame:
    return null_counts(df).agg(F.sum("nulls").alias("total_nulls"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows equal to an earlier row; nulls count as equal."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def numeric_summary(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles, maximum: one row."""
    quartiles = exact_quantiles(df, column, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    pack = quartiles.select(F.struct("q25", "q50", "q75")).scalar()
    value = F.col(column)
    moments = df.agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    return moments.withColumn("_q", pack).select("count", "mean", "std", "min", "_q.*", "max")


def sign_shares(df: DataFrame, column: str) -> DataFrame:
    """Zero count and percent, negative count: one row."""
    value = F.col(column)
    zeros = F.count_if(value == 0)
    return df.agg(
        F.count("*").alias("rows"),
        zeros.alias("zeros"),
        ratio_or_null(zeros * 100.0, F.count("*").cast("double")).alias("zero_pct"),
        F.count_if(value < 0).alias("negatives"),
    )


def median_and_max(df: DataFrame, column: str) -> DataFrame:
    median = exact_quantiles(df, column, {"m": 0.5}).select("m").scalar()
    return df.agg(F.max(column).alias("max")).withColumn("median", median)


def histogram(df: DataFrame, column: str, bins: int = 100) -> DataFrame:
    """Counts of equal-width bins between minimum and maximum; the last bin is closed.

    Empty bins are listed.  The ends come from a one-row aggregate used as a scalar
    subquery, so the histogram itself is one aggregation to at most ``bins`` rows.
    """
    value = F.col(column).cast("double")
    ends = df.agg(F.min(value).alias("low"), F.max(value).alias("high")).select(F.struct("low", "high")).scalar()
    width = (F.col("e.high") - F.col("e.low")) / bins
    place = F.when(
        F.col("e.high") > F.col("e.low"),
        F.least(F.floor((F.col("v") - F.col("e.low")) / width), F.lit(bins - 1)),
    ).otherwise(F.lit(bins // 2))
    counts = (
        df.where(value.isNotNull())
        .select(value.alias("v"), ends.alias("e"))
        .groupBy(place.cast("int").alias("bin"))
        .agg(F.count("*").alias("count"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select("bin", F.coalesce("count", F.lit(0)).alias("count"))


def boxplot(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (the outermost values within ``reach`` spreads) and outlier count: one row."""
    quartiles = exact_quantiles(df, column, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    pack = quartiles.select(F.struct("q1", "median", "q3")).scalar()
    spread = (F.col("q.q3") - F.col("q.q1")) * reach
    low, high = F.col("q.q1") - spread, F.col("q.q3") + spread
    inside = F.col("v").between(low, high)
    return (
        df.select(F.col(column).cast("double").alias("v"), pack.alias("q"))
        .groupBy("q")
        .agg(
            F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
        .select("q.*", "whisker_low", "whisker_high", "outliers")
    )


def flag_audit(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Sum, type and distinct values of each 0/1 flag, in one aggregation."""
    # a flag's distinct values are few by nature; min and max keep the audit bounded if one is not
    values = []
    for i, flag in enumerate(flags):
        column = F.col(flag)
        values += [
            F.sum(column).alias(f"_s{i}"),
            F.min(column).alias(f"_l{i}"),
            F.max(column).alias(f"_h{i}"),
            F.count_if(~column.isin(0, 1) | column.isNull()).alias(f"_o{i}"),
        ]
    rows = [
        F.struct(
            F.lit(flag).alias("flag"),
            F.lit(df.schema[flag].dataType.simpleString()).alias("data_type"),
            F.col(f"_s{i}").alias("flag_sum"),
            F.col(f"_l{i}").alias("lowest"),
            F.col(f"_h{i}").alias("highest"),
            F.col(f"_o{i}").alias("not_binary"),
        )
        for i, flag in enumerate(flags)
    ]
    return df.agg(*values).select(F.inline(F.array(*rows)))


def set_sizes(sets: Mapping[str, Column], rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows and columns of several subsets of one table in one scan; ``sets`` maps a name to its condition.

    ``columns`` are those that the subsets keep, all by default; a name the table lacks fails.
    """
    width = len(rows.columns if columns is None else rows.select(*columns).columns)
    counts = rows.agg(*[F.count_if(test).alias(f"_{i}") for i, test in enumerate(sets.values())])
    listed = [
        F.struct(F.lit(n).alias("set_name"), F.col(f"_{i}").alias("rows"), F.lit(width).alias("columns"))
        for i, n in enumerate(sets)
    ]
    return counts.select(F.inline(F.array(*listed)))
