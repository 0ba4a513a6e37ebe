"""Centroid clustering over a VA-file: few-bit cells first, full vectors only where intervals overlap.

Every vector is kept twice on shared storage: whole, and as an approximation of
``bits`` bits per dimension (the cell its component falls in). For a round of
centroids, two lookup tables per dimension give the least and the greatest share of
the squared distance between a cell and each centroid. Their sums bound the distance
of a vector from every centroid without the vector. A centroid whose interval lies
above another's cannot be the nearest; if one is left, the vector is assigned
from its approximation alone. What a distance owes to the vector alone, its square
around the centroids' mean, is the same for all centroids and left out; that makes
the intervals several times narrower (on the test vectors, three of four are assigned
from 6 bits per dimension, without this almost none).

A round reads the approximations only, and joins the whole vectors of two kinds
of rows: those whose intervals overlap, and those that change their centroid,
since the sums of the centroids are kept and corrected by what moves. The first
round, in which every row moves, and the last, which returns exact distances,
read the whole vectors in place, without a join; there too only the centroids
left by the intervals are measured.

All distances and sums are exact integers. The driver holds the centroids, the
cell edges and a sum per centroid and dimension, whose sizes do not depend on the
number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestlift.llm.common import stage

COMPONENTS = 64
CENTROIDS = 40
ROUNDS = 5
SEED = 2
BITS = 6
SCALE = 256
EDGE_ROWS = 4_096       # vectors that place the cells' edges; any edges give the same result
TAIL = 0.002            # share of the sample beyond the equal steps, on either side
# components are held to this size, so that a squared distance fits a long
MOST = 1 << 27


@dataclass(frozen=True)
class Cells:
    """Cell edges per dimension: cell c of dimension j holds integers from edges[j, c] to edges[j, c + 1] - 1."""

    edges: np.ndarray

    def of(self, whole: np.ndarray) -> np.ndarray:
        """The cells of a (rows, dimensions) array of integers."""
        out = np.empty(whole.shape, np.uint8)
        for j, e in enumerate(self.edges):
            out[:, j] = np.searchsorted(e[1:-1], whole[:, j], "right")
        return out

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, greatest) share of the distance, indexed by dimension, cell, centroid.

        With o the rounded mean of the centroids, (x - c)^2 - (x - o)^2 is linear in x, so the cell's ends bound it.
        """
        o = np.rint(centroids.mean(axis=0)).astype(np.int64)
        low, high = (e - o[:, None] for e in (self.edges[:, :-1], self.edges[:, 1:] - 1))
        q = (centroids - o).T[:, None, :]
        ends = q * q - 2 * q * low[:, :, None], q * q - 2 * q * high[:, :, None]
        return np.minimum(*ends), np.maximum(*ends)


def bounds(cells: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bound for each row and centroid of the squared distance less the row's own part."""
    low, high = tables
    out = np.zeros((2, len(cells), low.shape[2]), np.int64)
    for j in range(cells.shape[1]):
        out[0] += low[j][cells[:, j]]
        out[1] += high[j][cells[:, j]]
    return out[0], out[1]


def left(cells: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """True for each row and centroid that may be the nearest (ties included)."""
    lower, upper = bounds(cells, tables)
    return lower <= upper.min(axis=1, keepdims=True)


def nearest(whole: np.ndarray, centroids: np.ndarray, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(centroid, squared distance) among the open ones of each row; ties go to the smaller number."""
    row, c = np.nonzero(open_)                              # by row, then centroid
    distance = np.empty(len(row), np.int64)
    for i in range(0, len(row), 1 << 15):
        part = slice(i, i + (1 << 15))
        distance[part] = ((whole[row[part]] - centroids[c[part]]) ** 2).sum(axis=1)
    order = np.lexsort((c, distance, row))
    first = order[np.searchsorted(row, np.arange(len(whole)), "left")]  # rows are contiguous in both orders
    return c[first], distance[first]


def _matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), width)


def _packed(cells: np.ndarray, bits: int) -> pa.Array:
    """``bits`` bits a cell, a row padded to whole bytes."""
    flags = (cells[:, :, None] >> np.arange(bits - 1, -1, -1, dtype=np.uint8)) & 1
    return pa.array([r.tobytes() for r in np.packbits(flags.reshape(len(cells), -1), axis=1)], pa.binary())


def _unpacked(column: pa.Array, width: int, bits: int) -> np.ndarray:
    size = -(-width * bits // 8)
    flags = np.unpackbits(np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), size), axis=1)
    flags = flags[:, :width * bits].reshape(len(column), width, bits)
    return (flags << np.arange(bits - 1, -1, -1, dtype=np.uint8)).sum(axis=2, dtype=np.uint8)


def whole_vectors(embeddings: DataFrame, width: int = COMPONENTS) -> DataFrame:
    """rid, vec_id, x: the vectors of ``width`` finite components, as integers floor(256 * component)."""
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    held = F.transform("embedding", lambda v: F.floor(F.greatest(
        F.least(v.cast("double") * SCALE, F.lit(float(MOST))), F.lit(-float(MOST)))).cast("long"))
    return (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
            .where(F.col("embedding").isNotNull() & (F.size("embedding") == width) & finite)
            .select(F.monotonically_increasing_id().alias("rid"), "vec_id", held.alias("x")))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The components of the ``k`` vectors of least sha256 of ``seed:vec_id``; a NULL id starts no centroid."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(key.alias("key"), "x").where(F.col("key").isNotNull()).orderBy("key", "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64)


def cell_edges(vectors: DataFrame, width: int, bits: int) -> Cells:
    """Equal steps over all but the tails of a sample of EDGE_ROWS vectors; the outer cells reach the extremes of all vectors."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            x = _matrix(batch.column(0), np.int64, width)
            if len(x):
                part = x.min(axis=0), x.max(axis=0)
                low, high = part if low is None else (np.minimum(low, part[0]), np.maximum(high, part[1]))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(low), pa.array(high)], names=["j", "low", "high"])

    rows = (vectors.select("x").mapInArrow(spread, "j long, low long, high long")
            .groupBy("j").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("j").collect())
    sample = np.array([r["x"] for r in vectors.orderBy(F.xxhash64("rid")).select("x").limit(EDGE_ROWS).collect()], np.int64)
    inner = np.ceil(np.linspace(*np.quantile(sample, (TAIL, 1 - TAIL), axis=0), (1 << bits) - 1)).astype(np.int64)
    return Cells(np.array([[r["low"], *np.clip(inner[:, j], r["low"], r["high"] + 1), r["high"] + 1] for j, r in enumerate(rows)], np.int64))


def _centroid_sums(moves: DataFrame, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums, counts) that moves add to each centroid. ``moves``: was, best, x; -1 for none."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            x = _matrix(batch.column("x"), np.int64, width)
            for name, sign in (("was", -1), ("best", 1)):
                c = batch.column(name).to_numpy()
                for i in np.unique(c[c >= 0]):
                    total[i] += sign * x[c == i].sum(axis=0)
                    n[i] += sign * np.count_nonzero(c == i)
        at = np.arange(k * (width + 1))
        value = np.concatenate([total, n[:, None]], axis=1).ravel()
        keep = value != 0
        yield pa.RecordBatch.from_arrays([pa.array(at[keep]), pa.array(value[keep])], names=["at", "value"])

    rows = (moves.select("was", "best", "x").mapInArrow(add, "at long, value long")
            .groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect())
    out = np.zeros((k, width + 1), object)
    for at, value in rows:
        out[at // (width + 1), at % (width + 1)] = int(value)
    return out[:, :width], out[:, width]


def _moved(centroids: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The floor of the mean of every centroid that has vectors; the others stay."""
    out = centroids.copy()
    for i, n in enumerate(counts):
        if n:
            out[i] = [int(s) // int(n) for s in sums[i]]
    return out


def cluster(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, width: int = COMPONENTS,
            bits: int = BITS, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: one row per kept vector.

    Vectors that are NULL, of another length, or hold a NULL or non-finite component
    are left out. Rows that repeat an id are vectors of their own; a NULL id is kept
    but starts no centroid (equal ids start centroids in the order of their
    components). Components beyond 2^27 / 256 are held to that. Fewer kept vectors
    than ``k`` make fewer centroids; no kept vector (or none with an id) gives no rows.
    Other columns are ignored. An inertia that no long can hold is NULL.
    """
    spark = embeddings.sparkSession
    vectors = stage(whole_vectors(embeddings, width), "vectors")
    out = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    centroids = first_centroids(vectors, k, seed)
    k = len(centroids)
    if not k:
        return spark.createDataFrame([], out)
    cells = cell_edges(vectors, width, bits)

    def judge(centroids: np.ndarray, name: str):
        """Assign whole vectors among the centroids that their cells leave open."""
        tables = cells.tables(centroids)

        @F.arrow_udf(T.StructType([T.StructField("cells", T.BinaryType()), T.StructField("best", T.IntegerType()),
                                   T.StructField("distance", T.LongType())]))
        def run(x: pa.Array) -> pa.Array:
            whole = _matrix(x, np.int64, width)
            own = cells.of(whole)
            best, distance = nearest(whole, centroids, left(own, tables))
            return pa.StructArray.from_arrays([_packed(own, bits), pa.array(best.astype(np.int32)), pa.array(distance)],
                                              ["cells", "best", "distance"])

        return run(F.col("x")).alias(name)

    def intervals(centroids: np.ndarray, name: str):
        """The centroids that the approximations leave open."""
        tables = cells.tables(centroids)

        @F.arrow_udf(T.ArrayType(T.IntegerType()))
        def run(packed: pa.Array) -> pa.Array:
            open_ = left(_unpacked(packed, width, bits), tables)
            row, c = np.nonzero(open_)
            ends = np.concatenate([[0], np.cumsum(open_.sum(axis=1))])
            return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(c.astype(np.int32)))

        return run(F.col("cells")).alias(name)

    def among(centroids: np.ndarray, name: str):
        """The nearest of the listed centroids, from the whole vector."""
        @F.arrow_udf(T.IntegerType())
        def run(x: pa.Array, listed: pa.Array) -> pa.Array:
            open_ = np.zeros((len(x), k), bool)
            lengths = listed.value_lengths().to_numpy(zero_copy_only=False)
            open_[np.repeat(np.arange(len(x)), lengths), listed.flatten().to_numpy(zero_copy_only=False)] = True
            return pa.array(nearest(_matrix(x, np.int64, width), centroids, open_)[0].astype(np.int32))

        return run(F.col("x"), F.col("open")).alias(name)

    sums, counts = np.zeros((k, width), object), np.zeros(k, object)
    near = None                                             # rid, cells, best: the approximations and their centroids
    for i in range(rounds):
        if i == 0:
            state = stage(vectors.select("rid", judge(centroids, "j")).select("rid", "j.cells", "j.best"), "approximations")
            moves = vectors.select(F.lit(-1).alias("was"), "x", judge(centroids, "j")).select("was", "j.best", "x")
        else:
            seen = stage(near.select("rid", "cells", F.col("best").alias("was"), intervals(centroids, "open")), "intervals")
            sure = (F.size("open") == 1) & (F.get("open", F.lit(0)) == F.col("was"))
            fetched = stage(seen.where(~sure).join(vectors.select("rid", "x"), "rid")
                            .select("rid", "cells", "was", "x", among(centroids, "best")), "fetched")
            moves = fetched.where("was <> best")
            state = seen.where(sure).select("rid", "cells", F.col("was").alias("best")).unionByName(
                fetched.select("rid", "cells", "best"))
        near = state
        more, n = _centroid_sums(moves, k, width)
        sums, counts = sums + more, counts + n
        centroids = _moved(centroids, sums, counts)

    last = stage(vectors.select("vec_id", judge(centroids, "j")).select("vec_id", F.col("j.best").alias("cluster"), "j.distance"),
                 "assigned")
    own = {r["cluster"]: int(r["s"]) for r in last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = sum(own.values())
    fits = lambda v: v if v < 1 << 63 else None
    names = spark.createDataFrame(                          # k rows
        [(c, fits(own.get(c, 0)), fits(total), hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
         for c, row in enumerate(centroids.tolist())],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return last.join(F.broadcast(names), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
