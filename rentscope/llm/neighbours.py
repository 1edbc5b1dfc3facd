"""Approximate nearest neighbours by collision counting.

Each projection is one number per vector, kept as a sorted array. Around a query's own
projection a window opens in every array; widening all windows by a factor stands for
hashing anew at a larger radius, without building anything again. A vector whose
projections fall into enough windows is verified by its distance on the original
components. A query is done once its k-th verified distance lies within the radius that
the windows stand for, at which a nearer vector would have been met almost surely.

Vectors are indexed in blocks of bounded size and queries come in blocks too, so no task
holds more than one block of each; the nearest of all blocks are merged per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from rentscope.llm.common import pick

NEIGHBOURS = 10
PROJECTIONS = 32
#: Half the width of a window in radii, and the share of the windows a vector must fall into to be verified:
#: one at the radius falls into 38 per cent of them, so it is missed in one case of thirty.
HALF_WIDTH, THRESHOLD = 0.5, 0.25
#: The first radius, as a share of the estimated distance to the nearest of some vectors spread over the block, and its growth.
FIRST_SHARE, PROBED, GROWTH = 0.7, 64, 1.15
#: Rows of a block of vectors, and of a block of queries.
BLOCK_ROWS = 8192
QUERY_ROWS = 2048


class CollisionIndex:
    """Sorted projections of one block of vectors; ``n_verified`` counts the distances taken."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, n_projections: int = PROJECTIONS, seed: int = 11):
        self.ids, self.vectors = ids, vectors
        self.directions = np.random.default_rng(seed).standard_normal((vectors.shape[1], n_projections))
        with np.errstate(over="ignore", invalid="ignore"):
            projected = vectors @ self.directions
            self.in_range = bool(np.isfinite(projected**2).all())
        self.order = list(np.argsort(projected, axis=0, kind="stable").T.copy())
        self.sorted = list(np.sort(projected, axis=0).T.copy())
        self.needed = int(np.ceil(THRESHOLD * n_projections))
        self.spread = float(np.abs(projected).max())
        self.probe = projected[np.linspace(0, len(ids) - 1, min(len(ids), PROBED)).astype(np.int64)]
        self.n_verified = 0

    def _distances(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Distances on the original components; those whose squares leave the numbers' range are scaled first."""
        self.n_verified += len(rows)
        with np.errstate(over="ignore"):
            apart = self.vectors[rows] - query
            found = np.sqrt((apart**2).sum(axis=1))
        far = ~np.isfinite(found)
        if far.any():
            largest = np.abs(apart[far]).max(axis=1, keepdims=True)
            scaled = np.where(np.isfinite(largest), apart[far] / largest, 1.0)
            found[far] = largest[:, 0] * np.sqrt((scaled**2).sum(axis=1))
        return found

    def _met(self, query: np.ndarray, others: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows that enough windows have met, and their distances, once ``k`` of them lie within the windows' radius."""
        n = len(self.ids)
        with np.errstate(over="ignore", invalid="ignore"):
            centre = query @ self.directions
            # The projections' spread around the query estimates distances; the nearest of some is where windows begin.
            guess = float(np.sqrt(((self.probe - centre) ** 2).mean(axis=1)).min())
        if not (self.in_range and np.isfinite(guess)):
            rows = np.flatnonzero(others)
            return rows, self._distances(rows, query)
        radius = max(FIRST_SHARE * guess, 1e-6 * self.spread, 1e-300)
        hits, waiting = np.zeros(n, np.int64), others.copy()
        near, distance = np.zeros(0, np.int64), np.zeros(0)
        low = high = None
        while True:
            reach = HALF_WIDTH * radius
            begin = [v.searchsorted(c - reach, "left") for v, c in zip(self.sorted, centre, strict=True)]
            end = [v.searchsorted(c + reach, "right") for v, c in zip(self.sorted, centre, strict=True)]
            if low is None:
                met = [o[a:b] for o, a, b in zip(self.order, begin, end, strict=True)]
            else:
                met = [o[a:b] for o, a, b in zip(self.order, begin, low, strict=True)] + [o[a:b] for o, a, b in zip(self.order, high, end, strict=True)]
            low, high = begin, end
            hits += np.bincount(np.concatenate(met), minlength=n)
            new = np.flatnonzero((hits >= self.needed) & waiting)
            waiting[new] = False
            near, distance = np.concatenate([near, new]), np.concatenate([distance, self._distances(new, query)])
            limit = np.partition(distance, k - 1)[k - 1] if len(near) >= k else np.inf
            if limit <= radius or (sum(high) - sum(low)) == n * len(high):
                return near, distance
            radius *= GROWTH

    def search(self, query_id: int, query: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the nearest found, nearest first, ties to the smaller id."""
        near, distance = self._met(query, self.ids != query_id, k)
        best = np.lexsort((self.ids[near], distance))[:k]
        return self.ids[near[best]], distance[best]


def usable(vector: Column) -> Column:
    """Not null, not zero, and all components present and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    return np.concatenate([np.asarray(c.flatten(), np.float64) for c in column.chunks] or [np.zeros(0)]).reshape(rows, -1)


def _distinct(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors, one per id: rows that repeat an id count once, the smallest vector."""
    ids, vectors = np.asarray(table.column("vec_id"), np.int64), _matrix(table.column("vector"), table.num_rows)
    if len(np.unique(ids)) < len(ids):
        order = np.lexsort([*vectors.T[::-1], ids])
        first = order[np.r_[True, ids[order][1:] != ids[order][:-1]]]
        ids, vectors = ids[first], vectors[first]
    return ids, vectors


def nearest(vectors: DataFrame, is_query: Column, k: int = NEIGHBOURS, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The ``k`` nearest vectors of each query by Euclidean distance: ``query_id, rank, vec_id, score``.

    ``vectors`` has ``vec_id`` and ``embedding``; queries are its rows for which ``is_query`` holds, and
    a query's own id is no candidate. Vectors that are null, zero or hold null or non-finite
    components take no part, nor do rows without id; vectors of different lengths never meet. Fewer
    than ``k`` other vectors give as many rows. All vectors are indexed.
    """
    rows = pick(vectors, "vec_id", "embedding").withColumn("is_query", F.coalesce(is_query, F.lit(False)))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), F.size("embedding").alias("width"), "is_query")
    n_rows, n_queries = rows.agg(F.count("*"), F.count(F.when(F.col("is_query"), 1))).first()
    n_blocks, n_query_blocks = max(1, -(-n_rows // block_rows)), max(1, -(-n_queries // query_rows))
    spread = F.xxhash64("vec_id")
    blocks = (
        rows.drop("is_query").withColumn("block", F.pmod(spread, F.lit(n_blocks)).cast("int"))
        .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(n_query_blocks - 1))))
    )
    queries = (
        rows.filter("is_query").drop("is_query").withColumn("query_block", F.pmod(F.shiftright(spread, 20), F.lit(n_query_blocks)).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    )
    schema = StructType([StructField("query_id", LongType()), StructField("vec_id", LongType()), StructField("score", DoubleType())])

    def search(block: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if block.num_rows and asked.num_rows:
            index = CollisionIndex(*_distinct(block))
            for query_id, query in zip(*_distinct(asked), strict=True):
                ids, distances = index.search(int(query_id), query, k)
                out[0] += [int(query_id)] * len(ids)
                out[1] += ids.tolist()
                out[2] += distances.tolist()
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=schema.names)

    keys = ["width", "block", "query_block"]
    found = blocks.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(search, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank.cast(IntegerType())).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
