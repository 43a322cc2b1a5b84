"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products, one vector kept a group.

Rows are compared only with rows of an equal label.  Exact copies collapse to one vector with a
multiplicity.  A label with many vectors is cut into cells by spherical k-means, fitted on a bounded
sample; every vector lives in the cell of its nearest centre.  No link is lost at a border: a vector also
visits each cell in which a partner could live - one whose half-space border, seen from the vector, is no
further than the angle of the threshold.  A visitor is compared with the residents only, so every ordered
pair is seen once, in the cell of its second member.  Cells are multiplied block by block, and a block
returns per vector a count and the edges of a spanning forest, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import bounded_batches, connected_components, forest, materialize
from skein.llm.neighbours import valid_vector

THRESHOLD = 0.93
#: Vectors of a cell aimed at, rows of a block, and vectors that the centres of a label are fitted on.
CELL_ROWS, BLOCK_ROWS, SAMPLE_ROWS = 4096, 2048, 4096


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centres of unit vectors; starts from far-apart vectors; deterministic."""
    centres = [x[0]]
    near = x @ x[0]
    for _ in range(1, k):
        centres.append(x[int(np.argmin(near))])
        near = np.maximum(near, x @ centres[-1])
    c = np.array(centres)
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        for j in range(k):
            s = x[own == j].sum(0)
            norm = np.linalg.norm(s)
            if norm > 0:
                c[j] = s / norm
    return c


def _units(col: pa.Array, n: int) -> np.ndarray:
    x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow of squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centre_distances(centres: np.ndarray) -> np.ndarray:
    """Distance of every centre to every other, from their cosines."""
    return np.sqrt(np.maximum(2.0 - 2.0 * (centres @ centres.T), 0.0))


def visits(x: np.ndarray, centres: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(home cell, boolean matrix of the cells to visit, home included) of unit vectors.

    A partner at an angle of at most acos(threshold) lies beyond the border between the centres c0 and c
    only if <x, (c0 - c) / |c0 - c|> <= sin(acos(threshold)).
    """
    dots = x @ centres.T
    home = np.argmax(dots, axis=1)
    gap = centre_distances(centres)[home]
    lead = dots[np.arange(len(x)), home][:, None] - dots
    reach = math.sqrt(max(0.0, 1 - threshold * threshold))
    go = lead <= reach * gap + 1e-7  # a distance from cosines is exact to 1e-8; a visit too many costs only time
    go[np.arange(len(x)), home] = True
    return home, go


def block_links(a_ids: np.ndarray, a: np.ndarray, b_ids: np.ndarray, b: np.ndarray, mult: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of queries ``a`` to residents ``b``: counts by query, and forest edges (n x 2 ids)."""
    hit = (a @ b.T >= threshold) & (a_ids[:, None] != b_ids[None, :])
    counts = hit @ mult
    return counts, forest(a_ids, b_ids, hit)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept``: one row per input row.

    Vectors link if their labels are equal and not null, their lengths are equal and their cosine in double
    precision is ``threshold`` or more.  Vectors that are null, empty, zero or hold null or non-finite
    components, or have a null label or id, link with nothing: no links, their own component, kept.
    Repeated rows count as other vectors with the same content.  An empty table gives an empty result.
    Other columns are not read, whatever their names.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie in (0, 1]")
    bounded_batches(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).cast("string").alias("label"))
    ok = valid_vector(F.col("v")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = rows.withColumn("v", F.when(ok, F.transform("v", lambda x: x + F.lit(0.0))))  # -0.0 becomes 0.0
    reps = rows.where(F.col("v").isNotNull()).groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("mult"))
    reps = materialize(reps.withColumn("size", F.size("v")), "reps")
    big = reps.groupBy("label", "size").agg(F.count("*").alias("n")).where(F.col("n") > CELL_ROWS).collect()  # at most rows / CELL_ROWS groups
    centres: dict[tuple[str, int], np.ndarray] = {}
    for r in big:
        share = int(1_000_000 * min(1.0, 1.5 * SAMPLE_ROWS / r["n"])) + 1
        own = reps.where((F.col("label") == r["label"]) & (F.col("size") == r["size"]) & (F.pmod(F.xxhash64("rep", F.lit(5)), F.lit(1_000_000)) < share)).select("v").limit(SAMPLE_ROWS).toArrow()
        x = _units(own.column(0).combine_chunks(), own.num_rows)
        centres[r["label"], r["size"]] = spherical_kmeans(x, min(math.ceil(r["n"] / CELL_ROWS), len(x)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            labels, sizes = b.column(0).to_pylist(), b.column(4).to_pylist()
            groups: dict[tuple[str, int], list[int]] = {}
            for i, key in enumerate(zip(labels, sizes, strict=True)):
                groups.setdefault(key, []).append(i)
            for key, at in groups.items():
                part = b.take(pa.array(at))
                x = _units(part.column(1), len(at))
                if key in centres:
                    home, go = visits(x, centres[key], threshold)
                else:
                    home, go = np.zeros(len(at), np.int64), np.ones((len(at), 1), bool)
                who, cell = np.nonzero(go)
                take = pa.array(who)
                unit = pa.ListArray.from_arrays(pa.array(np.arange(len(who) + 1, dtype=np.int32) * x.shape[1]), pa.array(x[who].ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(4).take(take), pa.array(cell), pa.array(cell == home[who]), part.column(2).take(take), part.column(3).take(take), unit],
                    ["label", "size", "cell", "resident", "rep", "mult", "unit"],
                )

    placed = reps.select("label", "v", "rep", "mult", "size").mapInArrow(assign, "label string, size int, cell long, resident boolean, rep long, mult long, unit array<double>")
    placed = materialize(placed, "cells")
    keys = ["label", "size", "cell"]
    blocks = placed.groupBy(*keys).agg(F.ceil(F.count_if("resident") / BLOCK_ROWS).cast("int").alias("nb"), F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("na")).where("nb > 0")
    blocks = materialize(blocks, "blocks")
    own = placed.join(blocks, keys)
    a = own.select(*keys, F.pmod(F.xxhash64("rep"), F.col("na")).cast("int").alias("ba"), F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("bb"), "rep", "unit")
    b = own.where("resident").select(*(F.col(k).alias("b_" + k) for k in keys), F.explode(F.sequence(F.lit(0), F.col("na") - 1)).alias("b_ba"), F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int").alias("b_bb"), F.col("rep").alias("b_rep"), "mult", F.col("unit").alias("b_unit"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = {"a": [], "b": [], "n": []}
        if left.num_rows and right.num_rows:
            size = left.column("size")[0].as_py()
            mat = lambda c: c.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            ids = left.column("rep").to_numpy()
            counts, edges = block_links(ids, mat(left.column("unit")), right.column("b_rep").to_numpy(), mat(right.column("b_unit")), right.column("mult").to_numpy(), threshold)
            some = counts > 0
            kinds = {"a": np.concatenate([ids[some], edges[:, 0]]), "b": np.concatenate([ids[some], edges[:, 1]]), "n": np.concatenate([counts[some], np.zeros(len(edges), np.int64)])}
        return pa.table({k: pa.array(x, pa.int64()) for k, x in kinds.items()})

    g = [*keys, "ba", "bb"]
    found = materialize(a.groupBy(*g).cogroup(b.groupBy(*("b_" + k for k in g))).applyInArrow(run, "a long, b long, n long"), "links")
    comp = connected_components(found)
    links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
    info = reps.select("label", "v", "rep", "mult").join(links, "rep", "left").join(comp.withColumnRenamed("id", "rep"), "rep", "left")
    info = materialize(info.select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")), "classes")
    out = rows.join(info, ["label", "v"], "left")
    cid = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), cid.alias("component_id"), F.coalesce(F.col("vec_id") == cid, F.lit(True)).alias("kept"))
