"""Helpers shared by the training-data operators: scratch tables, hashing, components."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_ROOT: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` where the session has it.

    Where it is unset a temporary local folder stands in, on a single machine only: on a cluster every
    executor would write to its own disk, so there the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_ROOT:
        _OWN_ROOT[app] = "file://" + tempfile.mkdtemp(prefix="skein-scratch-")
    return _OWN_ROOT[app]


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends here.

    Later jobs read Parquet that every executor can see, so the loss of an executor costs its
    running tasks only.  Folders are removed when the driver's interpreter ends, or by ``discard``.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/skein-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._skein_path = path
    _WRITTEN.append((spark, path))
    return out


_WRITTEN: list[tuple[SparkSession, str]] = []


def discard(*frames: DataFrame) -> None:
    """Remove the folders behind frames that ``materialize`` returned and nothing reads any more."""
    for df in frames:
        path = getattr(df, "_skein_path", None)
        if path:
            _remove(df.sparkSession, path)


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    for spark, path in _WRITTEN:
        try:
            if spark._jsc is None or spark._jsc.sc().isStopped():
                raise RuntimeError("stopped")
            _remove(spark, path)
        except Exception:
            local = path.removeprefix("file://")
            if os.path.isdir(local) and local.startswith(tempfile.gettempdir()):
                import shutil

                shutil.rmtree(local, ignore_errors=True)
    _WRITTEN.clear()


def release() -> None:
    """Give a worker's free memory back: workers outlive their tasks and share an executor's memory."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not a glibc system
        pass


#: Rows of an Arrow batch of texts or vectors, and its bytes; Spark's defaults are ten and eight times as many.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small: texts can be long, and a worker holds a batch several times over.

    Lowers ``spark.sql.execution.arrow.maxRecordsPerBatch`` and ``maxBytesPerBatch`` of the session to
    ``BATCH_ROWS`` and ``BATCH_BYTES`` if they are larger.
    """
    key = "spark.sql.execution.arrow.max{}PerBatch".format
    now = int(spark.conf.get(key("Records"), "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key("Records"), BATCH_ROWS)
    size = spark.conf.get(key("Bytes")).lower().removesuffix("b")
    if not size.isdigit() or not 0 < int(size) <= BATCH_BYTES:  # written with a unit: larger, or as good as unset
        spark.conf.set(key("Bytes"), str(BATCH_BYTES))


# --------------------------------------------------------------------------- hashing
U = np.uint64
_M1, _M2, _G = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise on uint64."""
    with np.errstate(over="ignore"):
        x = x + _G
        x = (x ^ (x >> U(30))) * _M1
        x = (x ^ (x >> U(27))) * _M2
        return x ^ (x >> U(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Map 64 random bits to (0, 1]."""
    return ((x >> U(11)).astype(np.float64) + 1.0) * (1.0 / 9007199254740992.0)


# --------------------------------------------------------------------------- components
def forest(a_ids: np.ndarray, b_ids: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """Edges (n x 2 ids) that join what a boolean matrix of links joins: each id to the least of its component."""
    rows, cols = np.flatnonzero(hit.any(1)), np.flatnonzero(hit.any(0))
    if not len(rows):
        return np.zeros((0, 2), np.int64)
    h = hit[np.ix_(rows, cols)]
    left, right = a_ids[rows].copy(), b_ids[cols].copy()
    big = np.iinfo(np.int64).max
    while True:
        low = np.minimum(left, np.where(h, right[None, :], big).min(1))
        back = np.minimum(right, np.where(h, low[:, None], big).min(0))
        if (low == left).all() and (back == right).all():
            break
        left, right = low, back
    edges = np.concatenate([np.stack([a_ids[rows], left], 1), np.stack([b_ids[cols], right], 1)])
    return edges[edges[:, 0] != edges[:, 1]]


#: Edges of a file of a round's table, and files at least.
FILE_EDGES, LEAST_FILES = 100_000, 12


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable id of every vertex that has an edge: columns ``id``, ``component``.

    Alternating large-star and small-star steps: each step is a partial-aggregated ``min`` per
    vertex and a join back, so a vertex with very many edges is combined before the exchange.  The
    minima are written before the join, so both sides of it are plain reads: the engine broadcasts
    the minima while they are small and else splits the partition of a vertex with very many edges.
    Every round is written to the shared scratch folder.  Null endpoints and loops are ignored; an
    empty input gives an empty result.
    """
    e = (
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    e = materialize(e, "edges")
    print_of = lambda d: tuple(d.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
    seen = print_of(e)
    while True:
        files = max(LEAST_FILES, seen[0] // FILE_EDGES + 1)  # the edges get fewer from round to round
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m0")).select("u", F.least("u", "m0").alias("m"))
        low = materialize(low.coalesce(files), "minima")
        # an edge (u, v) has v < u: its larger end moves to the minimum of its smaller one
        large = e.join(low.select(F.col("u").alias("v"), "m"), "v").select("u", F.col("m").alias("v")).where("u <> v").distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low2, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x"))
            .select("x.*")
            .where("u <> v")
            .distinct()
        )
        new = materialize(small.coalesce(files), "edges")
        was, seen = seen, print_of(new)
        discard(e, low)
        e = new
        if seen == was:
            break
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
