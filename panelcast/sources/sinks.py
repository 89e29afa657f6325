"""Writing datasets and reports, and reusing what an earlier run wrote."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_dataset(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet, replacing what is there.

    With partition columns the rows are rebalanced on them first: adaptive execution then
    writes files of even size and splits a value that holds much of the data.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_report(
    df: DataFrame,
    path: str,
    decimals: Mapping[str, int] | None = None,
    order: Sequence[str] = (),
    fmt: str = "csv",
) -> None:
    """A report table, rounded for reading and sorted.

    ``order`` lists SQL expressions, descending with a leading ``-``.  The sort is
    distributed: a short report ends up in one file, a long one in several.
    """
    rounded = df.withColumns({c: F.round(c, n) for c, n in (decimals or {}).items() if c in df.columns})
    keys = [F.expr(o[1:]).desc_nulls_last() if o.startswith("-") else F.expr(o).asc() for o in order]
    ordered = rounded.orderBy(*keys) if keys else rounded
    ordered.write.mode("overwrite").option("header", True).format(fmt).save(path)


def parameter_key(*parts: object) -> str:
    """Short hash of everything a dataset depends on."""
    return hashlib.sha256(json.dumps([repr(p) for p in parts]).encode()).hexdigest()[:16]


def content_state(df: DataFrame) -> str:
    """Hash of a table's rows, whatever their order: their number and two sums of row hashes.

    One pass, combined before anything moves.  Repeated rows count as often as they occur.
    """
    # maps have no hash of their own
    columns = [F.to_json(c) if f.dataType.typeName() == "map" else F.col(f"`{f.name}`") for f in df.schema for c in [f"`{f.name}`"]]
    one, two = (F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)") for seed in (1, 2))
    return parameter_key(df.schema.simpleString(), *df.agg(F.count("*"), F.sum(one), F.sum(two)).first())


def input_state(tables: Mapping[str, DataFrame]) -> str:
    """Hash of path, length and modification time of all files that the tables read.

    The files are listed, not opened.  A table that no file holds counts by its rows (``content_state``).
    """
    files = {name: sorted(df.inputFiles()) for name, df in tables.items()}
    state = []
    for name in sorted(files):
        if not files[name]:
            state.append((name, content_state(tables[name])))
            continue
        # recursive look-up keeps folder names from being read as partition columns
        listed = tables[name].sparkSession.read.format("binaryFile").option("recursiveFileLookup", True).load(files[name])
        row = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
        state.append((name, *listed.agg(F.count("*"), F.sum(row)).first()))
    return parameter_key(*state)


def _published(spark: SparkSession, path: str) -> list[str]:
    """Names of the whole builds below ``path``, the oldest first."""
    try:
        rows = spark.read.text(f"{path}/published/*").collect()
    except AnalysisException:
        return []
    return sorted(r.value for r in rows)


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write a build of its own below ``path`` and then name it: its folder.

    Nothing that exists is touched, so whoever reads an earlier build goes on reading it whole, a
    build that fails leaves no name behind, and builders at the same time do not meet.  The name is
    a row in a file of its own, which is there whole or not at all.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    write_dataset(df, f"{path}/builds/{name}", partition_by)
    spark.createDataFrame([(name,)], "name string").coalesce(1).write.text(f"{path}/published/{name}")
    return f"{path}/builds/{name}"


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The latest build that was published below ``path``."""
    found = _published(spark, path.rstrip("/"))
    if not found:
        raise FileNotFoundError(f"nothing is published below {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/builds/{found[-1]}")


def read_or_build(
    spark: SparkSession,
    path: str,
    key: str,
    build: Callable[[], DataFrame],
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Read the copy published below ``path/key`` if there is one, else build, publish and read it.

    ``key`` names the inputs, their state and the parameters (``parameter_key``, ``input_state``),
    so changed data is never answered from an old copy.  Of several builders at once the first to
    finish is read by all that come later; every copy is whole.
    """
    target = f"{path.rstrip('/')}/{key}"
    found = _published(spark, target)
    return spark.read.parquet(f"{target}/builds/{found[0]}" if found else publish(build(), target, partition_by))


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that every executor sees.

    It is the session's ``spark.checkpoint.dir``; a session that sets none (as in tests) uses a
    folder of its own below the warehouse, which Spark's own tables share in the same way.  On a
    cluster whose warehouse is a machine's own folder the setting is required.
    """
    master = spark.conf.get("spark.master", "local")
    return _shared_folder(spark.conf.get("spark.checkpoint.dir", None), spark.conf.get("spark.sql.warehouse.dir"), master)


def _shared_folder(checkpoint: str | None, warehouse: str, master: str) -> str:
    if checkpoint:
        return checkpoint.rstrip("/")
    if not master.startswith("local") and warehouse.startswith(("/", "file:")):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share: {warehouse} is local to one machine")
    return f"{warehouse.rstrip('/')}/_intermediate"


def intermediate_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/panelcast/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a frame that several passes read, and return it as read back.

    The passes then prune columns on Parquet instead of recomputing the frame, and losing
    executors costs no more than a re-read.  The folder's own retention rule removes the files.
    """
    spark = df.sparkSession
    path = intermediate_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
