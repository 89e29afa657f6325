"""A training-data pipeline: language ID, near-duplicates, decontamination, mixing, sharding.

Each stage takes ``documents`` rows and returns the rows that it leaves, with their columns
unchanged; the last one returns the shard manifest.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import decontaminate, language, mixing, sharding, simhash
from panelcast.sources.sinks import materialize


def _packed(docs: DataFrame) -> DataFrame:
    """The row as one column beside its text, so that no column can clash with those of an operator."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "text")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without any letter go.

    The machines are fitted on the documents that ``language.held_out`` leaves for fitting.
    """
    found = language.identify(_packed(docs), language.fit_documents(docs), ["doc"])
    return found.where(F.col("lang_pred") != language.UNDETERMINED).select("doc.*")


def _placed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``doc`` (the row) beside ``__file`` and ``__row``, which tell rows apart whatever their ids.

    Rows that are read from Parquet have a place; others are written first.
    """
    packed = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "doc_id", "text"]
    place = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")]
    try:
        return docs.select(*packed, *place)
    except AnalysisException:
        return materialize(docs, "placed").select(*packed, *place)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates the first row by id; rows without id come last.

    Groups are those of ``simhash.near_duplicates``: fingerprints of three-word shingles that
    differ in at most three bits are linked, and links chain.
    """
    rows = _placed(docs)
    found = simhash.near_duplicates(rows, keep=["__file", "__row"])
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__file", "__row"))
    kept = found.groupBy("root").agg(first.alias("first")).select("first.__file", "first.__row")
    # the side without texts is the one to hash, so that texts are not sorted
    return rows.join(kept.hint("shuffle_hash"), ["__file", "__row"], "left_semi").select("doc.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    found = decontaminate.find_windows(_packed(docs), benchmark, ("doc",))
    return found.where(F.size("spans") == 0).select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: the words taken over the words, rounded, 0 to 2 times.

    Documents without words have no share in a mix of words and go.
    """
    mixed, _ = mixing.mix(docs)
    copies = mixed.groupBy("doc_id").agg((F.sum("taken") / F.sum("size")).alias("times"))
    copies = copies.select(F.col("doc_id").alias("__id"), F.round("times").cast("int").alias("__copies")).where("__copies > 0")
    taken = docs.join(copies.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(F.col("__id")))
    return taken.withColumn("__nth", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every document."""
    return sharding.shard_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# support vector machines and a hash that DuckDB lacks are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
