"""Exact near-duplicate vectors by a metric range join.

Cosine similarity ``s`` of two vectors means a distance of ``sqrt(2 - 2s)`` between their unit
vectors.  Pivots, drawn from the vectors, divide space into cells of nearest pivot.  By the
triangle inequality a unit vector ``y`` can lie within ``r`` of a member ``x`` of the cell of
pivot ``p`` only if ``d(y, p) - d(y, own pivot) <= 2r``; in Euclidean space the bisector of two
pivots gives the sharper ``(d(y, p)^2 - d(y, own)^2) / (2 d(p, own)) <= r``.  ``y`` is copied to
the cells that pass, and the cells are then joined independently.  Every vector has one home cell,
where all its links are found.

Equal vectors are one point with a count.  A cell is cut into squares of bounded size, so a hot
cell takes more tasks, not a larger one.  A square returns a count per vector and a spanning
forest of its links, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.components import components
from panelcast.llm.simhash import _merge
from panelcast.sources.sinks import materialize

HOME, MEMBERS = 4096, 16384
_STEP = 1024


def _matrix(values: pd.Series, width: int) -> np.ndarray:
    """Rows of doubles, shorter vectors filled with zeros (which change no inner product)."""
    out = np.zeros((len(values), width))
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out


def _unit(matrix: np.ndarray) -> np.ndarray:
    # scaled first, so that neither tiny nor huge components lose the norm
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _pivots(points: DataFrame, n: int, width: int, pool: int) -> np.ndarray:
    """Unit vectors far from each other, picked one after the other from a bounded hash sample."""
    drawn = points.orderBy(F.xxhash64("point"), "point").limit(pool).select("vector").toPandas()
    units = _unit(_matrix(drawn["vector"], width))
    picked, nearest = [0], units @ units[0]
    while len(picked) < min(n, len(units)):
        picked.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, units @ units[picked[-1]])
    return units[np.array(picked)]


def _cells(units: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each vector and, per vector and cell, whether it must be copied there."""
    squared = np.maximum(2.0 - 2.0 * (units @ pivots.T), 0.0)
    home = squared.argmin(axis=1)
    own = squared[np.arange(len(units)), home]
    gap = np.sqrt(np.maximum(2.0 - 2.0 * (pivots @ pivots.T), 0.0))[home]
    # a margin for rounding only ever adds copies; pivots in one place cannot be told apart
    near = (np.sqrt(squared) - np.sqrt(own)[:, None] <= 2 * radius + 1e-7) & (
        squared - own[:, None] <= 2 * gap * (radius + 1e-7) + 1e-7
    )
    near[np.arange(len(units)), home] = True
    return home, near


def _square(home: pd.DataFrame, members: pd.DataFrame, width: int, threshold: float) -> pd.DataFrame:
    """Links between two sets of points: counts for the first, a forest over both."""
    x, y = (_unit(_matrix(p["vector"], width)) for p in (home, members))
    x_id, y_id = home["point"].to_numpy(), members["point"].to_numpy()
    x_len, y_len = (p["vector"].map(len).to_numpy() for p in (home, members))
    copies = members["copies"].to_numpy(np.int64)
    ids, place = np.unique(np.concatenate([x_id, y_id]), return_inverse=True)
    x_at, y_at = place[: len(x)], place[len(x) :]
    counts, labels = np.zeros(len(x), np.int64), np.arange(len(ids))
    for i in range(0, len(x), _STEP):
        for j in range(0, len(y), _STEP):
            s = slice(i, i + _STEP), slice(j, j + _STEP)
            linked = x[s[0]] @ y[s[1]].T >= threshold
            linked &= (x_len[s[0], None] == y_len[None, s[1]]) & (x_id[s[0], None] != y_id[None, s[1]])
            a, b = np.nonzero(linked)
            if len(a):
                counts[s[0]] += linked @ copies[s[1]]
                _merge(labels, x_at[s[0]][a], y_at[s[1]][b])
    found = counts > 0
    tied = np.flatnonzero(labels != np.arange(len(ids)))
    return pd.DataFrame(
        {
            "point": np.concatenate([x_id[found], ids[tied]]),
            "other": np.concatenate([np.full(found.sum(), -1), ids[labels[tied]]]),
            "n": np.concatenate([counts[found], np.zeros(len(tied), np.int64)]),
        }
    )


def vector_points(vectors: DataFrame) -> DataFrame:
    """``point`` (a number), ``vector``, ``copies``, ``first`` of the distinct vectors that can link."""
    usable = vectors.where(
        "size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) "
        "AND abs(x) < double('infinity')) AND exists(embedding, x -> x <> 0)"
    )
    points = usable.groupBy("embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    numbered = points.select(F.monotonically_increasing_id().alias("point"), F.col("embedding").alias("vector"), "copies", "first")
    # written once: from here on a point's number is data
    return materialize(numbered, "points")


def near_vectors(vectors: DataFrame, threshold: float = 0.95, home: int = HOME, members: int = MEMBERS, pool: int = 4096) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of every row of ``vectors`` (``vec_id``, ``embedding``).

    Rows are linked if the cosine of their embeddings, in doubles, is at least ``threshold``;
    embeddings of different lengths never are, and null, empty and zero ones and ones with null or
    non-finite components link with nothing.  Repeated rows are vectors of their own and link with
    each other.  A component is named by its smallest ``vec_id`` (null if none has one);
    a row that links with nothing is a component by itself.
    """
    points = vector_points(vectors.select("vec_id", "embedding"))
    facts = points.agg(F.count("*"), F.max(F.size("vector"))).first()
    n, width = facts[0], facts[1] or 1
    radius = float(np.sqrt(2.0 - 2.0 * threshold))
    if n:
        # read twice, for counts and for components
        linked = materialize(_links(points, n, width, radius, threshold, home, members, pool), "vector_links")
    else:
        linked = vectors.sparkSession.createDataFrame([], "point long, other long, n long")
    counts = linked.where("n > 0").groupBy("point").agg(F.sum("n").alias("links"))
    roots = components(linked.where("n = 0").select(F.col("point").alias("a"), F.col("other").alias("b")))
    named = (
        points.drop("vector").join(counts, "point", "left").join(roots.withColumnRenamed("node", "point"), "point", "left")
        .withColumn("root", F.coalesce("root", "point"))
    )
    named = materialize(named, "vector_roots")
    smallest = named.groupBy("root").agg(F.min("first").alias("smallest"))
    by_point = named.join(smallest, "root").select("point", "links", "copies", "smallest")
    keyed = points.select("point", "vector").join(by_point, "point").drop("point")
    rows = vectors.select("vec_id", "embedding").join(keyed, F.col("embedding") == F.col("vector"), "left")
    own = F.col("vector").isNotNull()
    component = F.when(own, F.col("smallest")).otherwise(F.col("vec_id"))
    return rows.select(
        "vec_id",
        F.when(own, F.coalesce("links", F.lit(0)) + F.col("copies") - 1).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _links(points: DataFrame, n: int, width: int, radius: float, threshold: float, home: int, members: int, pool: int) -> DataFrame:
    """Counts (``point``, -1, n) and forest edges (``point``, ``other``, 0) of all cells."""
    pivots = _pivots(points, min(-(-n // home), pool), width, pool)

    def assign(batches):
        for pdf in batches:
            where, near = _cells(_unit(_matrix(pdf["vector"], width)), pivots, radius)
            yield pdf[["point", "vector", "copies"]].assign(home=where, cells=[np.flatnonzero(m) for m in near])

    kind = points.schema["vector"].dataType.simpleString()
    placed = points.mapInPandas(assign, f"point long, vector {kind}, copies long, home int, cells array<int>")
    placed = materialize(placed, "vector_cells")
    # sizes of the cells: one row per pivot, joined as a table
    members_of = placed.select(F.explode("cells").alias("cell"), "home")
    sizes = members_of.groupBy("cell").agg(F.count("*").alias("m"), F.count_if(F.col("home") == F.col("cell")).alias("h"))
    sizes = sizes.select("cell", F.ceil(F.col("h") / home).cast("int").alias("rows"), F.ceil(F.col("m") / members).cast("int").alias("columns"))
    spread = placed.select("point", "vector", "copies", "home", F.explode("cells").alias("cell")).join(sizes, "cell").where("rows > 0")
    row = F.pmod(F.xxhash64("point"), F.col("rows")).cast("int")
    column = F.pmod(F.xxhash64(F.lit(1), "point"), F.col("columns")).cast("int")
    every = lambda name: F.sequence(F.lit(0), F.col(name) - 1)
    as_member = F.transform(every("rows"), lambda i: F.struct(i.alias("i"), column.alias("j"), F.lit(False).alias("is_home")))
    as_home = F.when(
        F.col("home") == F.col("cell"),
        F.transform(every("columns"), lambda j: F.struct(row.alias("i"), j.alias("j"), F.lit(True).alias("is_home"))),
    ).otherwise(F.expr("CAST(array() AS array<struct<i: int, j: int, is_home: boolean>>)"))
    squares = spread.withColumn("at", F.explode(F.concat(as_home, as_member))).select(
        "cell", "at.i", "at.j", "at.is_home", "point", "vector", "copies"
    )

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        return _square(pdf[pdf["is_home"]], pdf[~pdf["is_home"]], width, threshold)

    return squares.groupBy("cell", "i", "j").applyInPandas(join, "point long, other long, n long")
