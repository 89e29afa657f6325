"""Shards of near-equal bytes from sampled splitters.

The records have one total order: key, then a tie-breaking number.  Size-weighted samples of
that order give quantile boundaries; the boundaries cut it into many ranges; a range that turns
out overfull gets more boundaries from a denser sample of its own.  Running sums of the range
totals and, within each range, of the records place every record, and a shard is an equal share
of the placed bytes.  Only the sample (bounded by a parameter) and the range totals reach the
driver, no task holds more than a range, and the shards do not depend on which keys were sampled.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.sources.sinks import materialize

_ROUNDS = 6


def _range_of(boundaries: list[tuple]) -> Column:
    """Number of boundaries at or below a record's (key, tie)."""
    if not boundaries:
        return F.lit(0)
    inner = F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.lit(t).cast("long").alias("t")) for k, t in boundaries])
    here = F.struct(F.col("k").cast("long").alias("k"), F.col("t").cast("long").alias("t"))
    return F.size(F.filter(inner, lambda b: b <= here))


def _sample(rows: DataFrame, step: float, salt: int) -> list[tuple]:
    """(key, tie, weight) drawn with a probability proportional to size, about one for ``step`` bytes.

    The draw is a hash of the record, so a retried task draws the same records.
    """
    u = F.pmod(F.xxhash64(F.lit(salt), "k", "t"), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.where(u * step < F.col("size")).select("k", "t", F.greatest("size", F.lit(step)).alias("w"))
    return sorted((r.k, r.t, r.w) for r in drawn.toLocalIterator())


def _quantiles(sample: list[tuple], parts: int) -> list[tuple]:
    """Keys that cut the sample's weight into ``parts`` equal shares."""
    total, run, at, out = sum(w for _, _, w in sample), 0.0, 1, []
    for k, t, w in sample:
        run += w
        if at < parts and run >= total * at / parts:
            out.append((k, t))
            at = int(run * parts / total) + 1
    return out


def splitters(rows: DataFrame, total: int, ranges: int, per_range: int) -> tuple[list[tuple], list]:
    """Boundaries and exact (bytes, records) of each range, none above twice the mean if a record allows it."""
    boundaries = _quantiles(_sample(rows, total / (ranges * per_range), 0), ranges)
    for attempt in range(1, _ROUNDS + 1):
        found = rows.groupBy(_range_of(boundaries).alias("r")).agg(
            F.sum("size").alias("bytes"), F.count("*").alias("n"), F.max("size").alias("largest")
        )
        totals = {x.r: x for x in found.collect()}
        overfull = [r for r, x in totals.items() if x.bytes > 2 * max(total / ranges, x.largest)]
        if not overfull or attempt == _ROUNDS:
            break
        excess = sum(totals[r].bytes for r in overfull)
        part = rows.where(_range_of(boundaries).isin(overfull))
        parts = max(2, -(-excess * ranges // total))
        more = _sample(part, excess / (2 * parts * per_range), attempt)
        by_range: dict[int, list] = {}
        for x in more:
            by_range.setdefault(bisect.bisect_right(boundaries, x[:2]), []).append(x)
        new = {b for r, s in by_range.items() for b in _quantiles(s, max(2, -(-totals[r].bytes * ranges // total)))}
        if new <= set(boundaries):
            break
        boundaries = sorted(set(boundaries) | new)
    return boundaries, [(r, totals[r].bytes, totals[r].n) for r in sorted(totals)]


def shard_by_bytes(
    rows: DataFrame, key: Column, size: Column, keep: list[Column], shards: int = 8, ranges: int = 256, per_range: int = 32
) -> DataFrame:
    """``keep``, ``size``, ``shard`` and ``slot`` (gapless from 0 in each shard) of every row.

    ``key`` is a whole number that orders the records (a text key: its hash) and ``size`` a
    positive number.  The sizes of two shards differ by at most two records.  Null keys come
    first; equal keys and repeated rows are separate records in the order they are stored, so one
    key may hold any share of the rows.  An empty table has no rows in the result.
    ``ranges * per_range`` bounds the expected sample.
    """
    # the null key takes the lowest place, and the tie-breaker becomes part of the written rows
    keyed = rows.select(
        F.coalesce(key.cast("long"), F.lit(-(1 << 63))).alias("k"),
        F.monotonically_increasing_id().alias("t"),
        size.cast("long").alias("size"),
        F.struct(*keep).alias("kept"),
    )
    keyed = materialize(keyed, "shard_keys")
    total = keyed.agg(F.sum("size")).first()[0]
    if total is None:
        totals, boundaries = [], []
    else:
        boundaries, totals = splitters(keyed.select("k", "t", "size"), total, ranges, per_range)
    starts, run, rank = {}, 0, 0
    for r, n_bytes, n in totals:
        starts[r] = (run, rank)
        run, rank = run + n_bytes, rank + n
    offsets = F.array(*[
        F.struct(F.lit(starts.get(r, (0, 0))[0]).cast("long").alias("bytes"), F.lit(starts.get(r, (0, 0))[1]).cast("long").alias("n"))
        for r in range(len(boundaries) + 1)
    ])
    order = Window.partitionBy("r").orderBy("k", "t")
    placed = (
        keyed.withColumn("r", _range_of(boundaries))
        .withColumn("before", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("nth", F.row_number().over(order) - 1)
        .withColumn("start", offsets[F.col("r")])
        .withColumn("at", F.coalesce("before", F.lit(0)) + F.col("start.bytes"))
        .withColumn("rank", F.col("nth") + F.col("start.n"))
        # whole-number arithmetic: at * shards stays below 2^63 up to an exabyte and eight shards
        .withColumn("shard", F.expr(f"CAST(at * {shards} DIV {total or 1} AS INT)"))
        .select("kept", "size", "shard", "rank")
    )
    placed = materialize(placed, "shard_places")
    # one row per shard: bounded by the number of shards
    first = F.broadcast(placed.groupBy("shard").agg(F.min("rank").alias("first")))
    return placed.join(first, "shard").select("kept.*", "size", "shard", (F.col("rank") - F.col("first")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 8, **options) -> DataFrame:
    """Every document's shard under the law ``bytes``: UTF-8 bytes of the text plus 1, near-equal sums.

    A null or empty text has size 1 and checksum 0.  ``doc_id`` orders the records; rows with a
    null or repeated ``doc_id`` are records of their own.  Other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keep = [F.col("doc_id"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")]
    sharded = shard_by_bytes(docs, F.col("doc_id"), F.octet_length(text) + 1, keep, shards, **options)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
