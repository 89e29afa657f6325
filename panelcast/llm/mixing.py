"""Mixing sources to target weights with a low-discrepancy schedule.

The documents of a source are shuffled by a hash and laid end to end; the resulting line of words
is cut into blocks of equal length.  Slot ``t`` of the mix gets the golden-ratio point
``frac((t + 1/2) * phi)``, which the cumulative target shares map to a source, and the slots of a
source are ranked: the n-th takes the source's n-th block, going round again after the last.
Every stretch of the schedule thus holds each source in its share, up to a few blocks.

Tables that grow with the data are joined by sorting, as told: numbers in order compress so well
that the size of their files says little about a broadcast.  All ranks and running sums go through buckets of bounded size, so no source is ordered in one
task, however much of the data it holds.  Only one row per source is ever gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.text import n_words
from panelcast.sources.sinks import materialize

WEIGHTS = (5, 2, 1)
# Whole-number form of the golden ratio's fraction: the points are exact, so reruns and machines agree.
_PHI, _POINT_BITS = 2654435769, 32
# Interchangeable documents are told apart in runs of so many.
_RUN = 4096


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = 1.5, ceiling: float = 2.0) -> DataFrame:
    """Add ``weight`` and ``target`` to one row per source (``source``, ``source_size``).

    Sources are ordered by code point, null last, and take the weights in turn.  They share
    ``budget`` times all words by weight; what exceeds ``ceiling`` times a source's own size is
    shared again among the others.  A source is capped if its cap per weight does not exceed the
    level that the rest would then get, which one pass over the sources in that order decides.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    picks = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sizes.withColumn("weight", picks[((F.row_number().over(by_name) - 1) % len(weights)).cast("int")])
    by_cap = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    return (
        weighed.withColumn("cap", ceiling * F.col("source_size"))
        .withColumn("left", budget * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("rest", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("capped", F.col("cap") * F.col("rest") <= F.col("left") * F.col("weight"))
        # the first source that is not capped sets the level for all later ones
        .withColumn("level", F.max(F.when(~F.col("capped"), F.struct(-F.col("cap") / F.col("weight"), F.col("left"), F.col("rest")))).over(everything))
        .withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * F.col("level.left") / F.col("level.rest")))
        .select("source", "source_size", "weight", "target")
    )


def _running(rows: DataFrame, by: Sequence[str], group: Column, order: Sequence[str], value: str) -> DataFrame:
    """Add ``before``: the sum of ``value`` over the earlier rows of equal ``by``, which may be null.

    ``group`` grows with ``order``.  Sums over the groups and sums within a group add up to the running
    sum, so that no task orders more than one group, or one row per group.
    """
    grouped = rows.withColumn("__group", group)
    names = [f"__{c}" for c in by]
    totals = grouped.groupBy(*[F.col(c).alias(n) for c, n in zip(by, names)], F.col("__group").alias("__at")).agg(F.sum(value).alias("__sum"))
    ahead = Window.partitionBy(*names).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("__ahead", F.coalesce(F.sum("__sum").over(ahead), F.lit(0)))
    within = Window.partitionBy(*by, "__group").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = grouped.withColumn("__inside", F.coalesce(F.sum(value).over(within), F.lit(0)))
    met = F.col("__group") == F.col("__at")
    for c, n in zip(by, names):
        met = met & F.col(c).eqNullSafe(F.col(n))
    found = inside.join(totals.drop("__sum").hint("merge"), met)
    return found.withColumn("before", F.col("__ahead") + F.col("__inside")).drop("__group", "__at", "__ahead", "__inside", *names)


def _line(rows: DataFrame, bits: int) -> DataFrame:
    """Place the documents of each source on a line of words in hash order: add ``start``.

    The leading ``bits`` of the hash are the bucket.  Rows of one source, id and size are
    interchangeable: they are counted before anything is ordered, stand together on the line, and
    are told apart again in runs of bounded length, which adaptive execution deals out by bytes.
    """
    same = rows.groupBy("source", "doc_id", "size").agg(F.count("*").alias("n")).withColumn("words", F.col("size") * F.col("n"))
    hashed = same.withColumn("h", F.xxhash64(F.lit(7), "doc_id", "size"))
    placed = _running(hashed, ["source"], F.shiftrightunsigned("h", 64 - bits), ["h", "doc_id", "size"], "words")
    runs = placed.withColumn("run", F.explode(F.expr(f"sequence(0L, (n - 1) DIV {_RUN})"))).hint("rebalance")
    each = runs.withColumn("i", F.explode(F.expr(f"sequence(run * {_RUN}, least((run + 1) * {_RUN}, n) - 1)")))
    return each.select("source", "doc_id", "size", (F.col("before") + F.col("i") * F.col("size")).alias("start"))


def _slots(targets: DataFrame, chunk: int) -> DataFrame:
    """``sid``, ``nth``: for every slot of the schedule its source and rank among the source's slots."""
    # slots that a source needs: its target over the length of its blocks
    shares = targets.where("target > 0").withColumn("need", F.col("target") * F.col("blocks") / F.col("source_size"))
    by_sid = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy()
    unit = float(1 << _POINT_BITS)
    edges = shares.withColumn("high", F.round(F.sum("need").over(by_sid) / F.sum("need").over(everything) * unit)).select("sid", "high")
    # one row per source; the array is what cumulative weights take
    found = edges.agg(F.array_sort(F.collect_list(F.struct(F.col("high").cast("long").alias("high"), "sid"))).alias("edges"))
    n = F.round(shares.agg(F.sum("need")).scalar())
    first = found.withColumn("n", F.coalesce(n, F.lit(0)).cast("long"))
    # a given number of partitions: by bytes the chunk numbers are nothing, but each makes many slots
    parts = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = first.withColumn("chunk", F.explode(F.expr(f"sequence(0L, greatest(n - 1, 0L) DIV {chunk})"))).repartition(parts, "chunk")
    points = chunks.withColumn("t", F.explode(F.expr(f"sequence(chunk * {chunk}, least((chunk + 1) * {chunk}, n) - 1)"))).where("t >= 0 AND t < n")
    # t * phi modulo 2^32 in two halves of t, so that no product overflows
    mask = (1 << _POINT_BITS) - 1
    u = F.expr(f"((t % 65536) * {_PHI} + (t DIV 65536 % 65536) * {(_PHI << 16) & mask} + {_PHI // 2}) & {mask}")
    placed = points.select("chunk", "t", F.element_at(F.filter("edges", lambda e: e["high"] > u), 1)["sid"].alias("sid"))
    # written, so that Spark plans the joins below by the real number of slots, not by that of sources
    placed = materialize(placed, "mix_slots")
    counts = placed.groupBy("sid", "chunk").agg(F.count("*").alias("n"))
    offsets = _running(counts, ["sid"], F.expr(f"chunk DIV {chunk}"), ["chunk"], "n").select("sid", "chunk", F.col("before").alias("offset"))
    within = Window.partitionBy("chunk", "sid").orderBy("t")
    ranked = placed.withColumn("inside", F.row_number().over(within) - 1).join(offsets.hint("merge"), ["sid", "chunk"])
    return ranked.select("sid", "t", (F.col("offset") + F.col("inside")).alias("nth"))


def mix(
    docs: DataFrame, size: Column | None = None, weights: Sequence[float] = WEIGHTS, budget: float = 1.5,
    ceiling: int = 2, block: int = 64, chunk: int = 4096, least_bits: int = 10, bucket_rows: int = 1 << 16,
) -> tuple[DataFrame, DataFrame]:
    """The mix: (documents with ``taken``, schedule).

    Documents: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``start`` (place on
    the source's line), ``taken`` (words the mix takes, repeats counted).  Schedule: ``t``,
    ``source``, ``round`` and the stretch ``first`` to ``last`` of the source's line that slot
    ``t`` takes.  A block is taken at most ``ceiling`` times, so no document exceeds that many
    times its size; a slot past a source's last allowed round stays empty (the schedule exceeds a
    target by a few blocks at most).  Texts without words have size 0 and nothing taken; a null
    source is a source of its own; without any words all targets are 0.
    """
    rows = docs.select("doc_id", "source", (n_words(F.col("text")) if size is None else size).alias("size"))
    rows = materialize(rows, "mix_sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, budget, ceiling)
    targets = targets.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    targets = materialize(targets.withColumn("blocks", F.ceil(F.col("source_size") / block)), "mix_targets")
    # buckets grow with the documents, of which Parquet keeps the number
    line = _line(rows, max(least_bits, (rows.count() // bucket_rows).bit_length()))

    # block k of a source covers words k*size/blocks up to (k+1)*size/blocks
    schedule = (
        _slots(targets, chunk).join(targets.select("sid", "source", "source_size", "blocks"), "sid")
        .withColumn("round", F.expr("nth DIV blocks"))
        .where(F.col("round") < ceiling)
        .withColumn("k", F.expr("nth % blocks"))
        .select(
            "t", "sid", "source", "round", "k",
            F.expr("k * source_size DIV blocks").alias("first"), F.expr("(k + 1) * source_size DIV blocks").alias("last"),
        )
    )
    schedule = materialize(schedule, "mix_schedule")
    # a block's number of uses, then the documents that overlap it
    uses = schedule.groupBy("sid", "k").agg(F.count("*").alias("uses"))
    # eqNullSafe keeps the null source; one row per source, a size that Spark checks before it broadcasts
    located = line.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    located = materialize(located.drop("weight").withColumn("row", F.monotonically_increasing_id()), "mix_line")
    # the first block that ends after a word x is (x + 1) * blocks - 1 DIV source_size
    pieces = (
        located.where("size > 0")
        .withColumn("low", F.expr("((start + 1) * blocks - 1) DIV source_size"))
        .withColumn("high", F.expr("((start + size) * blocks - 1) DIV source_size"))
        .withColumn("k", F.explode(F.sequence("low", "high")))
        .select(
            "row", "sid", "k",
            (
                F.least(F.col("start") + F.col("size"), F.expr("(k + 1) * source_size DIV blocks"))
                - F.greatest(F.col("start"), F.expr("k * source_size DIV blocks"))
            ).alias("words"),
        )
    )
    taken = pieces.join(uses.hint("merge"), ["sid", "k"]).groupBy("row").agg(F.sum(F.col("words") * F.col("uses")).alias("taken"))
    mixed = located.join(taken.hint("merge"), "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
    columns = ["doc_id", "source", "size", "source_size", "target", "start", "taken"]
    return mixed.select(*columns), schedule.select("t", "source", "round", "first", "last")
