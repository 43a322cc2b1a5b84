"""Approximate nearest neighbours by stable projections and kd-trees.

Vectors are projected on a few Gaussian directions (2-stable, so a projected distance divided by the
true one follows a chi distribution).  Projected space is cut by a kd-tree whose top levels, fitted on a
bounded sample, deal the rows into cells; every row is indexed, in the tree of its cell's shard.  A search
pulls projected neighbours in ascending order of their tree boxes, verifies them on the original vectors,
and stops when the chi-square test says that a nearer vector further out is unlikely: when
``projected distance^2 > quantile * (distance of the k-th found)^2``.

Two rounds: a query first searches its own cell; then only the cells whose box passes the same test.
Cells with many rows are salted into shards and cells with many queries into blocks, so a task holds a
bounded part of either.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import bounded_batches, materialize

DIMS, CONFIDENCE = 16, 0.95
#: Rows of a cell aimed at, rows of a shard and queries of a block at most (on average), sample for the cuts.
CELL_ROWS, SHARD_ROWS, BLOCK_QUERIES, SAMPLE_ROWS = 4096, 8192, 1024, 20_000
MAX_DEPTH, LEAF = 12, 24


def valid_vector(v):  # noqa: ANN001, ANN201 - Column to Column
    """Not null, no null or non-finite component, not all zero."""
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, ok) & F.exists(v, lambda x: x != 0)


def chi_square_cdf(x: float, dims: int) -> float:
    """CDF for an even number of degrees of freedom."""
    term = total = 1.0
    for i in range(1, dims // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - math.exp(-x / 2) * total


def chi_square_quantile(p: float, dims: int) -> float:
    lo, hi = 0.0, 10.0 * dims + 100
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square_cdf(mid, dims) < p else (lo, mid)
    return hi


def directions(size: int, dims: int, seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((size, dims))


class Cuts:
    """Top of the kd-tree over projected space: a heap-ordered tree of splits."""

    def __init__(self, sample: np.ndarray, depth: int, dims: int):
        self.depth = depth
        self.axis = np.zeros(2**depth, np.int64)
        self.at = np.zeros(2**depth)
        parts = {1: sample}
        for node in range(1, 2**depth):
            x = parts.pop(node)
            if len(x):
                self.axis[node] = int(np.argmax(x.max(0) - x.min(0)))
                self.at[node] = float(np.median(x[:, self.axis[node]]))
            below = x[:, self.axis[node]] <= self.at[node]
            parts[2 * node], parts[2 * node + 1] = x[below], x[~below]
        lo, hi = np.full((2 ** (depth + 1), dims), -np.inf), np.full((2 ** (depth + 1), dims), np.inf)
        for node in range(1, 2**depth):
            for child, side in ((2 * node, hi), (2 * node + 1, lo)):
                lo[child], hi[child] = lo[node], hi[node]
                side[child, self.axis[node]] = self.at[node]
        self.lo, self.hi = lo[2**depth :], hi[2**depth :]

    def cell(self, p: np.ndarray) -> np.ndarray:
        node = np.ones(len(p), np.int64)
        rows = np.arange(len(p))
        for _ in range(self.depth):
            node = 2 * node + (p[rows, self.axis[node]] > self.at[node])
        return node - 2**self.depth

    def distance2(self, p: np.ndarray) -> np.ndarray:
        """Squared distance of one point to every cell."""
        gap = np.maximum(np.maximum(self.lo - p, p - self.hi), 0)
        return (gap * gap).sum(1)


class Tree:
    """kd-tree of one shard: leaves of a few points with their boxes."""

    def __init__(self, p: np.ndarray):
        self.order = np.arange(len(p))
        cuts: list[tuple[int, int]] = []
        stack = [(0, len(p))]
        while stack:
            lo, hi = stack.pop()
            if hi - lo <= LEAF:
                cuts.append((lo, hi))
                continue
            own = self.order[lo:hi]
            x = p[own]
            axis = int(np.argmax(x.max(0) - x.min(0)))
            mid = (hi - lo) // 2
            self.order[lo:hi] = own[np.argpartition(x[:, axis], mid)]
            stack += [(lo, lo + mid), (lo + mid, hi)]
        cuts.sort()
        self.starts = np.array([c[0] for c in cuts], np.int64)
        self.ends = np.array([c[1] for c in cuts], np.int64)
        q = p[self.order]
        self.points = q
        self.lo = np.minimum.reduceat(q, self.starts) if len(cuts) else q
        self.hi = np.maximum.reduceat(q, self.starts) if len(cuts) else q


def search_shard(ids: np.ndarray, x: np.ndarray, q_ids: np.ndarray, q: np.ndarray, bound: np.ndarray, proj: np.ndarray, k: int, quantile: float) -> list[tuple[int, int, float]]:
    """The k nearest of each query found in one shard: (query, vector, distance), ties to the smaller id."""
    p, qp = x @ proj, q @ proj
    tree = Tree(p)
    xs, own = x[tree.order], ids[tree.order]
    out = []
    for i in range(len(q)):
        gap = np.maximum(np.maximum(tree.lo - qp[i], qp[i] - tree.hi), 0)
        far = (gap * gap).sum(1)
        order = np.argsort(far, kind="stable")
        slack = 1e-9 * (1.0 + float(qp[i] @ qp[i]))  # rounding of projections
        limit = bound[i]  # squared distance of the k-th found so far, elsewhere or here
        best_d, best_id = np.zeros(0), np.zeros(0, np.int64)
        at, step = 0, 4
        while at < len(order) and far[order[at]] <= quantile * limit + slack:
            leaves = order[at : at + step]
            at, step = at + step, min(2 * step, 64)
            leaves = leaves[far[leaves] <= quantile * limit + slack]
            rows = np.concatenate([np.arange(tree.starts[f], tree.ends[f]) for f in leaves])
            d = tree.points[rows] - qp[i]
            near = (d * d).sum(1)
            rows = rows[near <= quantile * limit + slack]
            rows = rows[own[rows] != q_ids[i]]
            if not len(rows):
                continue
            d = xs[rows] - q[i]
            best_d = np.concatenate([best_d, (d * d).sum(1)])
            best_id = np.concatenate([best_id, own[rows]])
            o = np.lexsort((best_id, best_d))
            best_d, best_id = best_d[o], best_id[o]
            if len(best_id) > 1:  # a repeated row counts once
                _, once = np.unique(best_id, return_index=True)
                if len(once) < len(best_id):
                    once.sort()
                    best_d, best_id = best_d[once], best_id[once]
            best_d, best_id = best_d[:k], best_id[:k]
            if len(best_d) == k:
                limit = min(limit, best_d[-1])
        out += [(int(q_ids[i]), int(v), float(np.sqrt(s))) for s, v in zip(best_d, best_id, strict=True)]
    return out


def _matrix(col: pa.Array, size: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _search(data: DataFrame, queries: DataFrame, k: int, quantile: float, dims: int) -> DataFrame:
    """Search every (query, cell) of ``queries`` in ``data``; a task holds one shard and one query block."""
    shards = data.groupBy("size", "cell").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("ns"))
    blocks = queries.groupBy("size", "cell").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("nb"))
    plan = materialize(shards.join(blocks, ["size", "cell"]), "shards")
    spread = data.join(plan, ["size", "cell"]).select(
        "size", "cell", F.pmod(F.xxhash64("vec_id"), F.col("ns")).alias("shard"), F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("block"), "vec_id", "embedding"
    )
    asked = queries.join(plan, ["size", "cell"]).select(
        F.col("size").alias("q_size"), F.col("cell").alias("q_cell"), F.explode(F.sequence(F.lit(0).cast("long"), (F.col("ns") - 1).cast("long"))).alias("q_shard"), F.pmod(F.xxhash64("query_id"), F.col("nb")).cast("int").alias("q_block"), "query_id", "query", "bound"
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple[int, int, float]] = []
        if left.num_rows and right.num_rows:
            size = left.column("size")[0].as_py()
            right = right.combine_chunks()
            left = left.combine_chunks()
            rows = search_shard(
                left.column("vec_id").to_numpy(), _matrix(left.column("embedding").combine_chunks(), size), right.column("query_id").to_numpy(), _matrix(right.column("query").combine_chunks(), size),
                right.column("bound").to_numpy(), directions(size, dims), k, quantile,
            )
        cols = list(zip(*rows, strict=True)) if rows else [[], [], []]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})

    keys = ["size", "cell", "shard", "block"]
    return spread.groupBy(*keys).cogroup(asked.groupBy(*("q_" + k for k in keys))).applyInArrow(run, "query_id long, vec_id long, score double")


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query, as an ordered array; a query has at most k rows from each shard."""
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return best.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id"))), 1, k).alias("best"))


def nearest(
    vectors: DataFrame, is_query: str, k: int = 10, dims: int = DIMS, confidence: float = CONFIDENCE, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (Euclidean distance in double precision).

    Queries are the rows where the SQL condition ``is_query`` holds; candidates are all rows with another
    id.  Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null
    id, take no part; vectors are compared with those of their own length only.  Ties go to the smaller
    id; repeated rows count once.  Fewer than k candidates give fewer rows; an empty table gives none.
    Other columns are read only if ``is_query`` names them, whatever their names.
    """
    if dims % 2:
        raise ValueError("dims must be even")
    quantile = chi_square_quantile(confidence, dims)
    bounded_batches(vectors.sparkSession)
    v = vectors.where(valid_vector(F.col(vector_col)) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"), F.expr(is_query).alias("_q"))
    v = v.withColumn("size", F.size("embedding"))
    counts = {r["size"]: r["n"] for r in v.groupBy("size").agg(F.count("*").alias("n")).collect()}  # one row a vector length
    cuts: dict[int, Cuts] = {}
    for size, n in counts.items():
        depth = min(MAX_DEPTH, max(0, math.ceil(math.log2(n / CELL_ROWS)))) if n else 0
        share = min(1.0, 2.0 * SAMPLE_ROWS / n)
        rows = v.where((F.col("size") == size) & (F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1_000_000)) < int(1_000_000 * share) + 1)).select("embedding").limit(SAMPLE_ROWS).toArrow() if depth else None
        x = _matrix(rows.column(0).combine_chunks(), size) @ directions(size, dims) if rows is not None and rows.num_rows else np.zeros((0, dims))
        cuts[size] = Cuts(x, depth, dims)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = b.column(3).to_numpy()
            cell = np.zeros(b.num_rows, np.int64)
            for s in np.unique(sizes):
                at = np.flatnonzero(sizes == s)
                cell[at] = cuts[s].cell(_matrix(b.column(1).take(pa.array(at)), s) @ directions(s, dims))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], ["vec_id", "embedding", "_q", "size", "cell"])

    data = materialize(v.mapInArrow(assign, "vec_id long, embedding array<double>, _q boolean, size int, cell long"), "vectors")
    queries = data.where("_q").select("size", "cell", F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")).dropDuplicates(["query_id"])
    rows = data.select("size", "cell", "vec_id", "embedding")
    infinite = F.lit(float("inf"))
    one = materialize(_search(rows, queries.withColumn("bound", infinite), k, quantile, dims), "near")
    bound = _top(one, k).select("query_id", F.when(F.size("best") == k, F.pow(F.element_at("best", -1)["score"], 2)).otherwise(infinite).alias("bound"))
    again = queries.join(bound, "query_id", "left").select("query_id", "query", "size", "cell", F.coalesce("bound", infinite).alias("bound"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, home, limit = b.column(2).to_numpy(), b.column(3).to_numpy(), b.column(4).to_numpy()
            take, cells = [], []
            for i in range(b.num_rows):
                c = cuts[sizes[i]]
                p = _matrix(b.column(1).slice(i, 1), sizes[i])[0] @ directions(sizes[i], dims)
                go = np.flatnonzero(c.distance2(p) <= quantile * limit[i] + 1e-9)
                go = go[go != home[i]]
                take += [i] * len(go)
                cells.append(go)
            at = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), b.column(2).take(at), pa.array(np.concatenate(cells) if cells else [], pa.int64()), b.column(4).take(at)], ["query_id", "query", "size", "cell", "bound"])

    more = again.mapInArrow(spread, "query_id long, query array<double>, size int, cell long, bound double")
    two = _search(rows, materialize(more, "visits"), k, quantile, dims)
    best = _top(one.unionByName(two), k)
    return best.select("query_id", F.posexplode("best").alias("pos", "x")).select("query_id", (F.col("pos") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
