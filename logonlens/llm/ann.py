"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square test.

**Measure.** Largest inner product. A coordinate ``sqrt(M - |x|^2)`` is added to every candidate
(``M``: the largest squared norm) and a zero to every query; then the squared distance is
``M + |q|^2 - 2 q.x``, so the largest product is the smallest distance.

**Index.** Vectors are projected to ``PROJECTED`` dimensions by random normal (2-stable)
directions; the squared projected distance of two points over their squared distance follows
a chi-square law. A kd-tree's upper levels, set by a bounded sample (``SAMPLE`` vectors of
smallest hash), cut the projected space into cells; every vector is put in its cell, and a cell's
box is that of the vectors in it. Cells with more than ``CELL_ROWS`` vectors are dealt over several
shards. Within a shard the kd-tree goes on down to leaves of ``LEAF_ROWS``.

**Search.** A query takes leaves by increasing projected distance and, in each, its projected
neighbours: a vector is verified with the true product only if its own projected distance is
small enough. Both stop where a vector as near as the worst of the ``k`` best would already have
been met with probability ``SURE``: when the projected distance squared exceeds the ``SURE``
quantile of the chi-square law times the squared distance of that vector. So a neighbour is
missed with probability ``1 - SURE`` at most. The first round searches the query's own cell; with
the bound found there, the second round goes only to the other cells that the same test leaves open.
A cell's candidates are read once for every ``QUERY_ROWS`` queries that go to that cell. The queries
of a cell go on side by side, ``LEAVES_AT_ONCE`` of each one's own next leaves at a time.

Nothing is capped: every vector is indexed, and a query goes to as many cells as the test asks.
Nulls: vectors that are NULL, zero, of another length than most, or that hold NULL or non-finite
components take no part, nor do rows with a NULL id. Rows of one id each take part. Ties go to
the smaller id. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache
from math import ceil, exp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logonlens.llm.common import cut

PROJECTED = 16                # even, for the closed form of the law
SURE = 0.96
SAMPLE = 8192
CELL_ROWS = 4096
LEAF_ROWS = 64
LEAVES_AT_ONCE = 8
QUERY_ROWS = 50_000           # queries that one task holds, about
SEARCHED_AT_ONCE = 1 << 19    # products of queries and vectors that are made at once, about
SEED = 11


def chi_square_cdf(x: float, dimensions: int = PROJECTED) -> float:
    """For an even number of dimensions."""
    term = total = 1.0
    for i in range(1, dimensions // 2):
        term *= x / 2 / i
        total += term
    return 1 - exp(-x / 2) * total


@lru_cache
def chi_square_quantile(p: float, dimensions: int = PROJECTED) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, dimensions) < p else (low, middle)
    return high


# ---------------------------------------------------------------- kd-tree

class Tree:
    """A kd-tree of ``depth`` levels in heap order: the box of every cell, and points' cells."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        self.axis = np.zeros((1 << depth) - 1, np.int64)
        self.split = np.zeros((1 << depth) - 1)
        groups = {0: points}
        for node in range((1 << depth) - 1):
            own = groups.pop(node)
            if len(own):
                axis = int(np.argmax(own.max(0) - own.min(0)))
                self.axis[node], self.split[node] = axis, np.median(own[:, axis])
            below = own[:, self.axis[node]] < self.split[node]
            groups[2 * node + 1], groups[2 * node + 2] = own[below], own[~below]

    def cells(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] >= self.split[node])
        return node - ((1 << self.depth) - 1)


def leaves_of(points: np.ndarray, rows: int) -> list[np.ndarray]:
    """Row numbers of the leaves: halves at the median of the widest axis down to ``rows``."""
    todo, out = [np.arange(len(points))], []
    while todo:
        own = todo.pop()
        if len(own) <= rows:
            out.append(own)
            continue
        at = points[own]
        axis = int(np.argmax(at.max(0) - at.min(0)))
        order = np.argpartition(at[:, axis], len(own) // 2)
        todo += [own[order[:len(own) // 2]], own[order[len(own) // 2:]]]
    return out


def distance_to_boxes(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every box."""
    out = np.zeros((len(points), len(low)))
    for k in range(points.shape[1]):
        x = points[:, k, None]
        gap = np.maximum(0, np.maximum(low[None, :, k] - x, x - high[None, :, k]))
        out += gap * gap
    return out


class Index:
    """What every task needs: projection, the largest squared norm, and the cells' tree."""

    def __init__(self, sample: np.ndarray, dimensions: int, largest: float, depth: int):
        rng = np.random.default_rng(SEED)
        self.directions = rng.normal(size=(dimensions + 1, PROJECTED))
        self.largest = largest
        self.tree = Tree(self.project(sample), depth)

    def project(self, vectors: np.ndarray, queries: bool = False) -> np.ndarray:
        extra = np.zeros(len(vectors)) if queries else np.sqrt(
            np.maximum(0, self.largest - (vectors * vectors).sum(1)))
        return vectors @ self.directions[:-1] + extra[:, None] * self.directions[-1]

    def squared_distance(self, norm: np.ndarray, product: np.ndarray) -> np.ndarray:
        return np.maximum(0, self.largest + norm - 2 * product)


def search(index: Index, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
           bounds: np.ndarray, k: int, sure: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The ``k`` best of a shard for every query, as far as they beat ``bounds`` (products that
    a result must reach): numbers of the queries, ids, products; and how many vectors were verified."""
    points, asked = index.project(vectors), index.project(queries, queries=True)
    leaves = leaves_of(points, LEAF_ROWS)
    by_leaf = np.concatenate(leaves)
    ids, vectors, points = ids[by_leaf], vectors[by_leaf], points[by_leaf]
    ends = np.cumsum([len(x) for x in leaves])
    starts = np.r_[0, ends[:-1]]
    low, high = np.minimum.reduceat(points, starts), np.maximum.reduceat(points, starts)
    # rows of every leaf, filled up with one more row that is never near
    rows_of = np.full((len(leaves), max(map(len, leaves))), len(ids))
    for leaf, (first, end) in enumerate(zip(starts, ends, strict=True)):
        rows_of[leaf, :end - first] = np.arange(first, end)
    ids = np.append(ids, 0)
    sizes, asked_sizes, norms = (points * points).sum(1), (asked * asked).sum(1), (queries * queries).sum(1)
    # room for the rounding of distances that are made from products
    slack = 1e-9 * (sizes.max(initial=0.0) + asked_sizes.max(initial=0.0))
    quantile, verified, out = chi_square_quantile(sure), 0, []
    together = max(1, SEARCHED_AT_ONCE // len(ids))
    for begin in range(0, len(queries), together):
        block = slice(begin, begin + together)
        products = np.hstack([queries[block] @ vectors.T, np.full((len(queries[block]), 1), -np.inf)])
        apart = np.hstack([asked_sizes[block, None] + sizes - 2 * (asked[block] @ points.T),
                           np.full((len(products), 1), np.inf)])
        gaps = distance_to_boxes(asked[block], low, high)
        order = np.argsort(gaps, axis=1, kind="stable")
        bound, on = bounds[block].copy(), np.arange(len(products))
        best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)       # query, id, product
        for at in range(0, len(leaves), LEAVES_AT_ONCE):
            bounded = np.isfinite(bound)
            with np.errstate(invalid="ignore"):
                reach = np.where(bounded, quantile * index.squared_distance(norms[block], bound), np.inf)
            on = on[~(gaps[on, order[on, at]] > reach[on])]
            if not len(on):
                break
            rows = rows_of[order[on, at:at + LEAVES_AT_ONCE]].reshape(len(on), -1)
            near = ((apart[on[:, None], rows] <= reach[on, None] + slack) | ~bounded[on, None]) & (rows < len(ids) - 1)
            verified += int(near.sum())
            found = products[on[:, None], rows]
            q, k_th = np.nonzero(near & (found >= bound[on, None]))
            rows, found, q = rows[q, k_th], found[q, k_th], on[q]
            other = ids[rows] != query_ids[block][q]
            best = tuple(np.r_[x, y[other]] for x, y in zip(best, (q, ids[rows], found), strict=True))
            keep = np.lexsort((best[1], -best[2], best[0]))
            best = tuple(x[keep] for x in best)
            number = np.bincount(best[0], minlength=len(products))
            first = np.cumsum(number) - number
            keep = np.arange(len(best[0])) - first[best[0]] < k
            full = np.nonzero(number >= k)[0]
            bound[full] = np.maximum(bound[full], best[2][first[full] + k - 1])
            best = tuple(x[keep] for x in best)
        out.append((best[0] + begin, *best[1:]))
    return (*(np.concatenate(x) if x else np.zeros(0) for x in (zip(*out, strict=True) if out else ((), (), ()))), verified)


# ---------------------------------------------------------------- on Spark

def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array | pa.ChunkedArray, dimensions: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def nearest(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            sure: float = SURE, cell_rows: int = CELL_ROWS, sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank`` (from 1), ``vec_id, score``: the ``k`` nearest rows found for every row
    of ``df`` where ``is_query`` (a condition on the id, named ``vec_id``) holds; equal query rows
    are asked once."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], schema)
    dimensions, n = lengths
    rows = rows.where(F.size("v") == dimensions)
    largest = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()[0]
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").collect()   # bounded by ``sample``
    depth = max(0, min(ceil(np.log2(max(1, n / cell_rows))), int(np.log2(max(1, len(some) / 32)))))
    index = spark.sparkContext.broadcast(Index(np.array([r["v"] for r in some]), dimensions, largest, depth))

    def put(batches):
        for batch in batches:
            v = _matrix(batch.column(1), dimensions)
            at, asked = (index.value.project(v, q) for q in (False, True))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(index.value.tree.cells(at)), pa.array(index.value.tree.cells(asked)),
                 pa.array(list(at))], ["vec_id", "v", "cell", "own_cell", "at"])

    placed = cut(rows.mapInArrow(put, "vec_id long, v array<double>, cell long, own_cell long, at array<double>"), "ann-cells")
    # equal query rows are one query; rows of one id with other vectors are queries of their own, by ``q``
    queries = cut(placed.where(is_query).select("vec_id", "v", "own_cell").dropDuplicates(["vec_id", "v"])
                  .withColumn("q", F.monotonically_increasing_id()), "ann-queries")
    # a row per cell, and at most sample / 16 cells
    boxes = placed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.min(F.get("at", i)) for i in range(PROJECTED)]).alias("low"),
        F.array(*[F.max(F.get("at", i)) for i in range(PROJECTED)]).alias("high")).orderBy("cell").collect()
    shards = {r["cell"]: ceil(r["n"] / cell_rows) for r in boxes}
    number = F.create_map(*[F.lit(x) for pair in shards.items() for x in pair])
    candidates = placed.select("vec_id", "v", "cell", F.pmod(F.xxhash64("vec_id"), number[F.col("cell")]).alias("shard"))

    def find(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"q": pa.array([], pa.int64()), "query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        asked = right.column("vec_id").to_numpy()
        which, ids, products, _ = search(index.value, left.column("vec_id").to_numpy(), _matrix(left.column("v"), dimensions),
                                      asked, _matrix(right.column("v"), dimensions),
                                      right.column("bound").to_numpy(), k, sure)
        which = which.astype(np.int64)
        return pa.table({"q": pa.array(right.column("q").to_numpy()[which]), "query_id": pa.array(asked[which]), "vec_id": pa.array(ids.astype(np.int64)),
                         "score": pa.array(products.astype(np.float64))})

    def searched(asked: DataFrame) -> DataFrame:
        """``asked`` (written): queries and the cells that they go to."""
        keys = ["cell", "shard", "block"]
        going = {r["cell"]: ceil(r["count"] / QUERY_ROWS) for r in asked.groupBy("cell").count().collect()}
        blocks = F.create_map(*[F.lit(x) for pair in (going or {-1: 1}).items() for x in pair])
        to = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), blocks[F.col("cell")]).cast("int")) \
            .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), (number[F.col("cell")] - 1).cast("long"))))
        own = candidates.where(F.col("cell").isin(list(going))) \
            .withColumn("block", F.explode(F.sequence(F.lit(0), blocks[F.col("cell")] - 1)))
        return own.groupBy(*keys).cogroup(to.groupBy(*keys)).applyInArrow(
            find, "q long, query_id long, vec_id long, score double")

    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")

    def top(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    none = F.lit(float("-inf"))
    # a query's own cell may hold no candidate: it then goes on without a bound
    first = cut(top(searched(queries.select("q", "vec_id", "v", F.col("own_cell").alias("cell"), none.alias("bound"))
                             .where(F.col("cell").isin(list(shards))))), "ann-first")
    bounds = first.where(F.col("rank") == k).select("q", F.col("score").alias("bound"))
    known = queries.join(bounds, "q", "left").select("vec_id", "v", "own_cell", F.coalesce("bound", none).alias("bound"), "q")

    def go_on(batches):
        ix, quantile = index.value, chi_square_quantile(sure)
        cells, low, high = (np.array([r[name] for r in boxes]) for name in ("cell", "low", "high"))
        for batch in batches:
            v, own = _matrix(batch.column(1), dimensions), batch.column(2).to_numpy()
            bound = batch.column(3).to_numpy()
            gaps = distance_to_boxes(ix.project(v, True), low, high)
            norms = (v * v).sum(1)
            with np.errstate(invalid="ignore"):
                reach = np.where(np.isfinite(bound), quantile * ix.squared_distance(norms, bound), np.inf)
            q, c = np.nonzero((gaps <= reach[:, None]) & (cells[None, :] != own[:, None]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(q)), batch.column(1).take(pa.array(q)), pa.array(cells[c]),
                 batch.column(3).take(pa.array(q)), batch.column(4).take(pa.array(q))], ["vec_id", "v", "cell", "bound", "q"])

    asked = cut(known.mapInArrow(go_on, "vec_id long, v array<double>, cell long, bound double, q long"), "ann-asked")
    every = searched(asked).unionByName(first.select("q", "query_id", "vec_id", "score"))
    return top(every).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
