"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints that differ in at most three of 64 bits agree in one of four 16-bit blocks.  The
fingerprints are therefore filed four times, each time rotated so that another block leads, and
the leading block is the top node of the index.  Within it they are sorted by Gray rank, so that
neighbours differ in few bits; runs of neighbours form nodes that hold the bits all their members
share (a mask and a pattern), and nodes of nodes hold the bits shared further up.  A search adds
up the differences between a fingerprint and the patterns on the way down and leaves a whole
group as soon as they exceed the limit.

Only distinct fingerprints are filed.  A block with very many of them is dealt into runs, and
pairs of runs are searched separately, so no block has to fit one task.  Every search returns a spanning forest of the links found, never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.components import components
from panelcast.llm.text import map_texts
from panelcast.sources.sinks import materialize

BITS, BLOCKS = 64, 4
FANOUT = 8
# Fingerprints of a block beyond which it is dealt into runs; two runs make the largest search of one.
RUN = 8192
# Fingerprints of small blocks that are searched together, about.
GATHERED = 50_000
_QUERIES = 256
_U = np.uint64


def fingerprint(text: str | None, words: int = 3) -> int:
    """SimHash of the word shingles of a text, repeats included.

    A-Z is lower-cased; a text of fewer than ``words`` words is one shingle of all of them, and a
    text without words has fingerprint 0.  A bit is set if it is set in over half the hashes.
    """
    import xxhash

    if text is None:
        return 0
    found = text.encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    # ends of the words in the joined text; a shingle is one stretch of it
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    if len(found) <= words:
        starts, stops = [0], [len(joined)]
    else:
        starts = [0, *(ends[:-words] + 1).tolist()]
        stops = ends[words - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops)], dtype=_U)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``fp`` (the fingerprint's 64 bits as a signed long) of every row."""

    def add(texts: list) -> list[list]:
        values = np.array([fingerprint(t, words) for t in texts], dtype=_U)
        return [values.view(np.int64)]

    return map_texts(docs, "text", list(keep), "fp long", add)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code word in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> _U(shift)
    return rank


def _gray_order(fp: np.ndarray, rotation: int) -> np.ndarray:
    shift = rotation * (BITS // BLOCKS)
    turned = fp if not shift else (fp << _U(shift)) | (fp >> _U(BITS - shift))
    return gray_rank(turned)


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of the pairs (a, b): ``labels`` point to the smallest place of each class."""
    while len(a):
        la, lb = labels[a], labels[b]
        open_ = la != lb
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        if not len(a):
            break
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels[:] = up


class GrayIndex:
    """Nodes over fingerprints in Gray order: level 0 are the fingerprints, each level above groups ``FANOUT``.

    ``cells`` are the top nodes: members of different cells are never compared.
    """

    def __init__(self, fp: np.ndarray, cell_starts: np.ndarray):
        self.levels = []
        pattern, shared = fp, np.full(len(fp), ~_U(0), _U)
        starts = cell_starts
        while True:
            # ``first`` and ``last`` child of each node one level up; groups do not cross cells
            self.levels.append((pattern, shared))
            sizes = np.diff(np.append(starts, len(pattern)))
            if not len(sizes) or sizes.max() <= 1:
                self.cells = starts
                break
            groups = -(-sizes // FANOUT)
            offsets = np.repeat(np.cumsum(groups) - groups, groups)
            within = np.arange(groups.sum()) - offsets
            first = np.repeat(starts, groups) + within * FANOUT
            last = np.minimum(first + FANOUT, np.repeat(starts + sizes, groups))
            ones = np.bitwise_and.reduceat(pattern, first)
            zeros = ~np.bitwise_or.reduceat(pattern, first)
            all_shared = (ones | zeros) & np.bitwise_and.reduceat(shared, first)
            self.levels[-1] = (pattern, shared, first, last)
            starts = np.cumsum(groups) - groups
            pattern, shared = ones & all_shared, all_shared

    def search(self, query: np.ndarray, node: np.ndarray, limit: int):
        """Pairs (place in ``query``, place of a fingerprint) within ``limit`` bits, below the given top nodes."""
        depth = len(self.levels) - 1
        which = np.arange(len(query))
        pattern, shared = self.levels[depth][:2]
        above = shared[node]
        spent = np.bitwise_count((query ^ pattern[node]) & above).astype(np.int64)
        while True:
            keep = spent <= limit
            which, node, spent, above = which[keep], node[keep], spent[keep], above[keep]
            if depth == 0:
                return which, node
            depth -= 1
            pattern, shared, first, last = self.levels[depth]
            n = last[node] - first[node]
            offsets = np.cumsum(n) - n
            child = np.repeat(first[node] - offsets, n) + np.arange(n.sum())
            which, spent, above = (np.repeat(x, n) for x in (which, spent, above))
            node = child
            # bits counted further up are not counted again
            residual = shared[node] & ~above
            spent = spent + np.bitwise_count((query[which] ^ pattern[node]) & residual)
            above = above | residual


def _forest(fp: np.ndarray, cell: np.ndarray, limit: int, across: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links among fingerprints of the same cell as (member, smallest member) places.

    The arrays are in order of cell and Gray rank.  With ``across`` only pairs of a true and a
    false member are searched.
    """
    indexed = np.flatnonzero(across) if across is not None else np.arange(len(fp))
    queries = np.flatnonzero(~across) if across is not None else indexed
    labels = np.arange(len(fp))
    if len(indexed) and len(queries):
        inside = cell[indexed]
        starts = np.flatnonzero(np.append(True, inside[1:] != inside[:-1]))
        index = GrayIndex(fp[indexed], starts)
        top = np.searchsorted(inside[starts], cell[queries])
        for i in range(0, len(queries), _QUERIES):
            q = queries[i : i + _QUERIES]
            a, b = index.search(fp[q], top[i : i + _QUERIES], limit)
            _merge(labels, q[a], indexed[b])
    member = np.flatnonzero(labels != np.arange(len(fp)))
    return member, labels[member]


def link_forest(distinct: DataFrame, limit: int = 3) -> DataFrame:
    """Edges ``a``, ``b`` that connect exactly the fingerprints (``fp``) linked by at most ``limit`` differing bits."""
    if limit >= BLOCKS:
        raise ValueError("blocks guarantee at most three differing bits")
    width = BITS // BLOCKS
    filed = distinct.select(
        "fp",
        F.explode(F.array(*[
            F.struct(F.lit(r).alias("rotation"), F.expr(f"CAST(shiftrightunsigned(fp, {BITS - width * (r + 1)}) & {(1 << width) - 1} AS INT)").alias("block"))
            for r in range(BLOCKS)
        ])).alias("cell"),
    ).select("fp", "cell.rotation", "cell.block")
    # blocks with more fingerprints than a run holds: few, and only their sizes are looked at
    big = filed.groupBy("rotation", "block").agg(F.count("*").alias("n")).where(F.col("n") > RUN)
    big = materialize(big.withColumn("runs", F.ceil(F.col("n") / RUN).cast("int")), "simhash_big")
    small = filed.join(big, ["rotation", "block"], "left_anti")
    # whole blocks share a search, so that the index of many small blocks is one set of arrays
    searches = min(BLOCKS << width, -(-BLOCKS * distinct.count() // GATHERED) + 1)
    search = F.pmod(F.xxhash64("rotation", "block"), F.lit(searches))
    edges = small.groupBy(search.alias("search")).applyInPandas(
        lambda pdf: _edges(pdf, limit), "a long, b long"
    )
    if big.isEmpty():
        return edges
    # a big block is dealt into runs of equal size, whose pairs are searched separately
    runs = F.col("runs")
    dealt = filed.join(big.drop("n"), ["rotation", "block"]).withColumn("run", F.pmod(F.xxhash64("fp"), runs).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), runs - 1))).select(
        "fp", "rotation", "block", "run", F.least("run", "other").alias("low"), F.greatest("run", "other").alias("high")
    )

    def search_pair(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return _edges(pdf, limit, pdf["run"].to_numpy() == key[2] if key[2] != key[3] else None)

    hot = pairs.groupBy("rotation", "block", "low", "high").applyInPandas(search_pair, "a long, b long")
    return edges.unionByName(hot)


def _edges(pdf: pd.DataFrame, limit: int, across: np.ndarray | None = None) -> pd.DataFrame:
    fp = pdf["fp"].to_numpy(np.int64).view(_U)
    rotation = pdf["rotation"].to_numpy(np.int64)
    rank = np.empty(len(fp), _U)
    for r in np.unique(rotation):
        at = rotation == r
        rank[at] = _gray_order(fp[at], int(r))
    # the leading 16 bits of the rank follow from the leading block, so blocks stay together
    cell = rotation * (1 << 16) + pdf["block"].to_numpy(np.int64)
    order = np.lexsort((rank, cell))
    a, b = _forest(fp[order], cell[order], limit, None if across is None else across[order])
    signed = fp[order].view(np.int64)
    return pd.DataFrame({"a": signed[a], "b": signed[b]})


def near_duplicates(docs: DataFrame, limit: int = 3, words: int = 3, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, the columns ``keep``, ``fingerprint`` (16 hex digits), ``component_id``, ``root`` of every row.

    Documents whose fingerprints differ in at most ``limit`` bits are linked, equal ones and empty
    texts (fingerprint 0) included; a component is named by its smallest ``doc_id``, null if none
    of its rows has one.  ``root`` tells components apart even then.  Repeated rows stay rows.
    """
    filed = materialize(fingerprints(docs, words, ["doc_id", *keep]), "simhash_fp")
    distinct = materialize(filed.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash_distinct")
    roots = components(link_forest(distinct.select("fp"), limit)).withColumnRenamed("node", "fp")
    named = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = materialize(named, "simhash_roots")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = named.select("fp", "root").join(smallest, "root")
    return filed.join(by_fp, "fp").select(
        "doc_id", *keep, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root"
    )
