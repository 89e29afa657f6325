"""Words and shared column expressions of the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the words that operators 5, 7 and 8 count.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8_length(text: Column) -> Column:
    """UTF-8 bytes of a text; null has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def utf8_words(text: str | None) -> list[bytes]:
    """The words of ``WORD`` in UTF-8: bytes are split at exactly these six white-space bytes."""
    return [] if text is None else text.encode().split()


def map_texts(
    rows: DataFrame, text: str, keep: list[str], schema: str, function: Callable[[list], list[list]]
) -> DataFrame:
    """Apply ``function`` to the texts of each Arrow batch and append its result columns.

    ``keep`` are the columns to carry along; ``schema`` declares the appended ones, and
    ``function`` returns their values, one list per column.  No shuffle, no per-row calls.
    """
    carried = rows.select(*[F.col(c) for c in keep], F.col(text).alias("__text"))
    declared = rows.sparkSession.createDataFrame([], schema).schema
    out = carried.select(*keep).schema
    for field in declared:
        out = out.add(field)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(out)
        for batch in batches:
            columns = function(batch.column(batch.num_columns - 1).to_pylist())
            arrays = [batch.column(i).cast(target.field(i).type) for i in range(len(keep))]
            arrays += [pa.array(c, target.field(len(keep) + i).type) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return carried.mapInArrow(apply, out)
