"""Reading the six input tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.sources.sinks import materialize

TableSet = dict[str, DataFrame]


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Declared types stand for inference: no extra pass over the files, and a bad value fails the read.
SCHEMAS: dict[str, T.StructType] = {
    "train": _schema(
        id=T.LongType(), date=T.DateType(), store_nbr=T.IntegerType(), family=T.StringType(),
        sales=T.DoubleType(), onpromotion=T.IntegerType(),
    ),
    "test": _schema(
        id=T.LongType(), date=T.DateType(), store_nbr=T.IntegerType(), family=T.StringType(),
        onpromotion=T.IntegerType(),
    ),
    "stores": _schema(
        store_nbr=T.IntegerType(), city=T.StringType(), state=T.StringType(), type=T.StringType(),
        cluster=T.IntegerType(),
    ),
    "oil": _schema(date=T.DateType(), dcoilwtico=T.DoubleType()),
    "holidays": _schema(
        date=T.DateType(), type=T.StringType(), locale=T.StringType(), locale_name=T.StringType(),
        description=T.StringType(), transferred=T.BooleanType(),
    ),
    "transactions": _schema(date=T.DateType(), store_nbr=T.IntegerType(), transactions=T.LongType()),
}

# File name of each table.
FILES = {
    "train": "train.csv",
    "test": "test.csv",
    "stores": "stores.csv",
    "oil": "oil.csv",
    "holidays": "holidays_events.csv",
    "transactions": "transactions.csv",
}

# The narrow types the panel columns fit in.
NARROW_TYPES = {"store_nbr": "smallint", "onpromotion": "smallint"}


def read_csv_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, mode: str = "FAILFAST"
) -> DataFrame:
    """One comma-separated table with a header.

    With a schema a value of the wrong type fails the read, as does a header that names
    other columns.  Without one the types are inferred, at the price of a pass over the files.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.option("enforceSchema", False).schema(schema).csv(path, mode=mode)


def read_csv_quarantined(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that fit ``schema``, and those that do not: ``file``, ``line``, ``reason``.

    The files are parsed once into a written table that both read.  The reason lists the columns
    whose text is no value of their type, or says that the number of fields is wrong.
    """
    refused = "_refused"
    reader = spark.read.option("header", True).option("enforceSchema", False).option("columnNameOfCorruptRecord", refused)
    parsed = reader.schema(T.StructType([*schema.fields, T.StructField(refused, T.StringType())])).csv(path, mode="PERMISSIVE")
    columns = schema.names
    rows = materialize(parsed.select(*columns, refused, F.col("_metadata.file_path").alias("_file")), "csv")
    # the line again, every field as text
    texts = F.from_csv(refused, ", ".join(f"`{c}` string" for c in columns))
    wrong = [
        F.when(
            (F.col("_text").getField(f.name) != "") & F.col("_text").getField(f.name).try_cast(f.dataType).isNull(), F.lit(f.name)
        )
        for f in schema
    ]
    reasons = F.array_join(F.array_compact(F.array(*wrong)), ", ")
    fields = F.size(F.split(refused, ","))
    reason = F.when(reasons != "", reasons).when(fields != len(columns), F.lit("number of fields")).otherwise(F.lit("format"))
    bad = rows.where(F.col(refused).isNotNull()).withColumn("_text", texts)
    return rows.where(F.col(refused).isNull()).select(*columns), bad.select(
        F.col("_file").alias("file"), F.col(refused).alias("line"), reason.alias("reason")
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers are null everywhere: NaN compares as larger than any number in Spark."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def read_tables(
    spark: SparkSession,
    data_dir: str,
    files: Mapping[str, str] = FILES,
    schemas: Mapping[str, T.StructType] = SCHEMAS,
    views: bool = False,
) -> TableSet:
    """All tables by name, optionally also as temporary views; ``.parquet`` names are read as Parquet."""
    tables: TableSet = {}
    for name, file in files.items():
        path = f"{data_dir.rstrip('/')}/{file}"
        if file.endswith(".parquet"):
            df = spark.read.parquet(path)
        else:
            df = read_csv_table(spark, path, schemas.get(name))
        tables[name] = nan_to_null(df)
        if views:
            tables[name].createOrReplaceTempView(name)
    return tables


def parse_dates(tables: TableSet, column: str = "date") -> TableSet:
    """Every table that has ``date`` gets it as a date."""
    return {
        name: df.withColumn(column, F.to_date(column)) if column in df.columns else df
        for name, df in tables.items()
    }


def narrow_types(df: DataFrame, types: Mapping[str, str] = NARROW_TYPES, strict: bool = True) -> DataFrame:
    """Cast the listed columns that exist; a value that does not fit fails, or is null if not ``strict``."""
    present = {c: t for c, t in types.items() if c in df.columns}
    return df.withColumns(
        {c: F.col(c).cast(t) if strict else F.col(c).try_cast(t) for c, t in present.items()}
    )
