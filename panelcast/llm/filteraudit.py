"""What each filter removes, whatever the order they are applied in.

A document is a row of the mask matrix: which filters it fails.  An order is a row of the
position matrix: the place of each filter, the inverse of the permutation.  Their min-plus product
(a failed filter costs its place, a passed one costs infinity) is the step at which each order
removes each document.  Weighted counts are scattered by that step; what a filter would have
removed but finds gone already is redundant.

Documents that fail the same filters are removed at the same steps, so equal masks are added up
before the shuffle and the product runs over at most two to the number of filters rows of a part,
however many documents a part holds.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.text import WORD
from panelcast.sources.sinks import materialize

# The limits of the text filters.
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT, SYMBOLS = 50, 65, 5, "[#$%&*|]"
DUPLICATE = "E"
WEIGHTS = ("docs", "good", "toxic")
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
AUDIT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS)


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions that a text alone decides; ``words`` are its words as an array."""
    n = F.size(words).cast("long")
    return {
        "A": n < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < LEAST_DISTINCT_PERCENT * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > MOST_CAPITALS_PERCENT * F.length(text).cast("long"),
        "D": text.rlike(SYMBOLS),
    }


def _bits(failures: Mapping[str, Column]) -> Column:
    total = F.lit(0)
    for i, failed in enumerate(failures.values()):
        total = total + F.when(failed, 1 << i).otherwise(0)
    return total


def failure_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``part``, ``mask``, ``good``, ``toxic`` of every row of ``docs``: bit i is set if filter i of ABCDE fails.

    The part is the source, empty if null; a null text is empty.  A row is a duplicate if some row
    with a smaller ``doc_id`` has the same text; a null id is smaller than none and has none
    smaller, and rows of equal ids are not each other's duplicates.  A document is good or toxic if
    any of its labels says so; without a label it is neither.  Rows are kept as they are, and
    other columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    read = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"))
    split = read.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    failed = _bits(text_filters(F.col("text"), F.col("words"))).alias("mask")
    # texts are read once; what follows moves digests
    rows = materialize(split.select("doc_id", "part", failed, F.sha2("text", 256).alias("digest")), "filter_masks")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    noted = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        *[F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]
    )
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    found = rows.join(first, "digest", "left").select("doc_id", "part", (F.col("mask") + F.when(later, 1 << 4).otherwise(0)).alias("mask"))
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    return found.join(noted, "doc_id", "left").select("doc_id", "part", "mask", *flags)


def removal_steps(masks: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Min-plus product: the step (from 0) at which each order removes each mask, the number of filters if it never does.

    ``positions`` holds the place of each filter (columns) in each order (rows).
    """
    n = positions.shape[1]
    cost = np.where(masks[:, None] >> np.arange(n) & 1, 0, n)
    return np.minimum(n, (cost[:, None, :] + positions[None, :, :]).min(axis=2))


def inverse_positions(orders: Sequence[Sequence[int]]) -> np.ndarray:
    """The place of each filter in each order."""
    return np.argsort(np.array(orders), axis=1)


def audit_masks(masks: np.ndarray, weights: np.ndarray, orders: Sequence[Sequence[int]]) -> dict[str, np.ndarray]:
    """Counts by (order, step) from masks and their weights (columns: all, good, toxic documents)."""
    orders = np.array(orders)
    shape = orders.shape
    steps = removal_steps(masks, inverse_positions(orders))
    scattered = np.zeros((shape[0], shape[1] + 1, weights.shape[1]), np.int64)
    place = np.broadcast_to(np.arange(shape[0]), steps.shape)
    np.add.at(scattered, (place, steps), np.broadcast_to(weights[:, None, :], (*steps.shape, weights.shape[1])))
    lost = scattered[:, :-1]
    removed = lost[:, :, 0]
    bits = masks[:, None] >> np.arange(shape[1]) & 1
    fails, alone = weights[:, 0] @ bits, weights[:, 0] @ (bits * (bits.sum(axis=1) == 1)[:, None])
    shapley = np.zeros(shape[1], np.int64)
    np.add.at(shapley, orders, removed)
    return {
        "kept": weights[:, 0].sum() - removed.cumsum(axis=1),
        "removed": removed,
        # whatever fails the filter is gone after its step, here or before
        "redundant": fails[orders] - removed,
        "unique_fails": alone[orders],
        "good_lost": lost[:, :, 1],
        "toxic_lost": lost[:, :, 2],
        "shapley": shapley[orders],
    }


def audit(masks: DataFrame, letters: str = "ABCDE", orders: Sequence[Sequence[int]] | None = None) -> DataFrame:
    """One row per part, order and step, zeros included; ``masks`` as from ``failure_masks``.

    ``orders`` are permutations of the filters' places, all of them by default; ``shapley`` is the
    filter's removals added up over the orders.  A table without rows has no parts.
    """
    orders = list(itertools.permutations(range(len(letters)))) if orders is None else [tuple(o) for o in orders]
    names = ["".join(letters[i] for i in o) for o in orders]
    counted = masks.groupBy("part", "mask").agg(
        F.count("*").alias("docs"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )

    def rank(pdf: pd.DataFrame) -> pd.DataFrame:
        found = audit_masks(pdf["mask"].to_numpy(np.int64), pdf[list(WEIGHTS)].to_numpy(np.int64), orders)
        out = {
            "part": pdf["part"].iloc[0],
            "filter_order": np.repeat(names, len(letters)),
            "step": np.tile(np.arange(1, len(letters) + 1, dtype=np.int32), len(orders)),
        }
        return pd.DataFrame(out | {c: found[c].ravel() for c in _COUNTS})

    return counted.groupBy("part").applyInPandas(rank, AUDIT)


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over ``docs``, for every order of them."""
    return audit(failure_masks(docs, labels))
