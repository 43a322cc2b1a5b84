"""Near-duplicate documents by BagMinHash.

A text is the multiset of its five-word shingles.  For every shingle and every band of its weight a
Poisson process of unit rate runs over (time, weight): bands are [0,1), [1,2), [2,4), [4,8) and so on,
and every point splits its band in halves, hierarchically down to unit weights, each half continuing with
a process of its own from that time; halves above the weight are dropped.  Points below the weight take part: each picks one
of ``m`` components, which keep their earliest time.  Two texts agree in a component with probability
equal to their weighted Jaccard similarity.  Processes are followed only while they can still improve a
component.  All random numbers are functions of (shingle, band, step).

Signatures are banded; texts that share a band are candidates, and weighted Jaccard on the exact
multisets decides.  A group of copies is never turned into all its pairs: identical multisets collapse
first; then candidates are taken in rounds - each text against the smallest id it meets anywhere, then
against the pivot of each bucket, then block against block in the families of classes that still share
buckets - and every round leaves out what earlier links have already joined.  Identical texts never enter
the graph of links: they find their representative by its key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import U, bounded_batches, connected_components, discard, forest, materialize, mix64, release, uniform

SHINGLE, THRESHOLD = 5, 0.8
ROWS, BANDS = 6, 40
BROADCAST_IDS = 1_000_000
#: Documents, and items of their multisets, in a block of a family (on average).
BLOCK_ROWS, BLOCK_ITEMS = 128, 500_000
#: Shingles that are signed at once.
BLOCK = 150_000
#: Words whose hash a worker remembers.
CACHE_WORDS = 150_000
_WORDS: dict[str, int] = {}


def _word_hash(words: list[str]) -> np.ndarray:
    """64-bit hash of each word, remembered by the worker."""
    known = _WORDS
    if len(known) > CACHE_WORDS:
        known.clear()
    try:
        return np.array([known[w] for w in words], dtype=np.int64)
    except KeyError:
        for w in set(words):
            if w not in known:
                known[w] = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little", signed=True)
        return np.array([known[w] for w in words], dtype=np.int64)


def words_of(text: str | None) -> list[str]:
    """Lower-cased words between white space."""
    return (text or "").lower().split()


def shingles(words: list[str], size: int = SHINGLE) -> np.ndarray:
    """Hashes (uint64) of all runs of ``size`` words; a shorter text is one shingle, an empty one none."""
    h = _word_hash(words).view(np.uint64)
    if not len(h):
        return h
    size = min(size, len(h))
    n = len(h) - size + 1
    out = np.full(n, U(size), np.uint64)
    for i in range(size):
        out = mix64(out ^ h[i : i + n])
    return out


def _seed(elements: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Start of the random sequence of an element's band."""
    with np.errstate(over="ignore"):
        return mix64(elements ^ mix64(lo.astype(np.uint64) * U(0x100000001B3) + hi.astype(np.uint64)))


def signatures(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, m: int) -> np.ndarray:
    """BagMinHash components of ``n`` texts: element hash, integer weight and text of every row.

    Returns n x m times of the winning points, as bits: equal times mean the same point.  A text without
    elements has zeros.
    """
    best = np.full(n * m, np.inf)
    top = np.full(n, np.inf)  # latest component of each text: later points cannot matter
    # One process a (row, band of weight); lo, hi bound the band.
    rows, los, his = [np.arange(len(elements))], [np.zeros(len(elements), np.int64)], [np.ones(len(elements), np.int64)]
    lo = 1
    while True:
        more = np.flatnonzero(weights > lo)
        if not len(more):
            break
        rows.append(more)
        los.append(np.full(len(more), lo, np.int64))
        his.append(np.full(len(more), 2 * lo, np.int64))
        lo *= 2
    row, lo_, hi = np.concatenate(rows), np.concatenate(los), np.concatenate(his)
    state = _seed(elements[row], lo_, hi)
    time = np.zeros(len(row))
    own = owner[row]
    with np.errstate(over="ignore"):
        while len(row):
            state = mix64(state + U(1))
            time = time - np.log(uniform(state)) / (hi - lo_)
            live = time < top[own]
            row, lo_, hi, state, time, own = row[live], lo_[live], hi[live], state[live], time[live], own[live]
            if not len(row):
                break
            pick = mix64(state ^ U(0xA5A5A5A5A5A5A5A5))
            w = weights[row]
            width = hi - lo_
            hit = lo_ + ((pick & U(0xFFFFFFFF)).astype(np.float64) * (1.0 / 4294967296.0) * width).astype(np.int64) < w
            slot = own[hit] * m + ((pick[hit] >> U(33)) % U(m)).astype(np.int64)
            t = time[hit]
            better = t < best[slot]
            slot, t = slot[better], t[better]
            np.minimum.at(best, slot, t)
            flag = np.zeros(n, bool)
            flag[slot // m] = True
            touched = np.flatnonzero(flag)
            top[touched] = best.reshape(n, m)[touched].max(1)
            if (width > 1).any():  # every point splits its band: the halves go on from its time
                keep, cut = width == 1, width > 1
                mid = (lo_[cut] + hi[cut]) // 2
                need = mid < w[cut]  # the upper half, unless the weight ends below it
                r = np.concatenate([row[cut], row[cut][need]])
                a = np.concatenate([lo_[cut], mid[need]])
                b = np.concatenate([mid, hi[cut][need]])
                row, lo_, hi = np.concatenate([row[keep], r]), np.concatenate([lo_[keep], a]), np.concatenate([hi[keep], b])
                state = np.concatenate([state[keep], _seed(elements[r], a, b)])
                time = np.concatenate([time[keep], time[cut], time[cut][need]])
                own = np.concatenate([own[keep], own[cut], own[cut][need]])
    return np.where(np.isinf(best), 0.0, best).view(np.uint64).reshape(n, m)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    x = sig.reshape(len(sig), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(sig), bands)).copy()
    for i in range(rows):
        key = mix64(key ^ x[:, :, i])
    return key.view(np.int64)


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``_id``, ``key`` (digest of the word sequence), ``n`` (shingles), ``bands``; from ``_id``, ``_text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys, sizes, sh = [], [], [], []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                w = words_of(text.as_py())
                s = shingles(w)
                ids.append(doc)
                keys.append(hashlib.blake2b(" ".join(w).encode(), digest_size=16).hexdigest())
                sizes.append(len(s))
                sh.append(s)
                if sum(sizes) >= BLOCK:
                    yield _signed_batch(ids, keys, sizes, sh, bands, rows)
                    ids, keys, sizes, sh = [], [], [], []
            if ids:
                yield _signed_batch(ids, keys, sizes, sh, bands, rows)
        _WORDS.clear()  # kept strings would pin the memory of all that were split beside them
        release()

    return docs.select("_id", "_text").mapInArrow(run, "_id long, key string, n int, bands array<long>")


def _signed_batch(ids: list, keys: list, sizes: list, sh: list, bands: int, rows: int) -> pa.RecordBatch:
    owner = np.repeat(np.arange(len(ids)), sizes)
    h = np.concatenate(sh) if sh else np.zeros(0, np.uint64)
    o = np.lexsort((h, owner))
    h, owner = h[o], owner[o]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])]) if len(h) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    weights = np.diff(np.append(at, len(h)))
    keys_ = band_keys(signatures(h[at], weights, owner[at], len(ids), bands * rows), bands, rows)
    offsets = np.arange(len(ids) + 1, dtype=np.int32) * bands
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(keys), pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys_.ravel()))], ["_id", "key", "n", "bands"]
    )


def multisets(docs: DataFrame) -> DataFrame:
    """``_id`` and ``items``: the multiset as a set, each shingle mixed with its occurrence number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = []
            for text in b.column(1):
                h = np.sort(shingles(words_of(text.as_py())))
                first = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
                start = np.maximum.accumulate(np.where(first, np.arange(len(h)), 0)) if len(h) else np.zeros(0, np.int64)
                nth = (np.arange(len(h)) - start).astype(np.uint64)
                sets.append(np.where(nth > 0, mix64(h + nth), h).view(np.int64))
            offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets) if sets else [], pa.int64()))], ["_id", "items"])
        _WORDS.clear()
        release()

    return docs.select("_id", "_text").mapInArrow(run, "_id long, items array<long>")


def _verify(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) with ``ok``: weighted Jaccard of the multisets is at least ``threshold``."""
    left = pairs.join(sets.select(F.col("_id").alias("a"), F.col("items").alias("x")), "a")
    both = left.join(sets.select(F.col("_id").alias("b"), F.col("items").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.select("a", "b", common.alias("c"), (F.size("x") + F.size("y") - common).alias("u")).select("a", "b", (F.col("c") >= threshold * F.col("u")).alias("ok"))


def _check(src: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """``pairs`` (a, b) with ``ok``, by their exact multisets."""
    ids = materialize(pairs.select(F.explode(F.array("a", "b")).alias("_id")).distinct(), "ids")
    sets = _sets(src, ids)
    checked = materialize(_verify(pairs, sets, threshold), "checked")
    discard(sets)
    return checked


def _sets(src: DataFrame, ids: DataFrame) -> DataFrame:
    """Multisets of the documents in ``ids``; the ids travel to the texts while they are few."""
    few = ids.count() <= BROADCAST_IDS
    return materialize(multisets(src.join(F.broadcast(ids) if few else ids, "_id", "left_semi")).dropDuplicates(["_id"]), "sets")


def _mixed(mem: DataFrame, comp: DataFrame) -> DataFrame:
    """Members (bucket, p, _id, n, c) of the buckets whose members belong to more than one class c."""
    placed = mem.join(comp.withColumnRenamed("id", "_id"), "_id", "left").select("bucket", "p", "_id", "n", F.coalesce("component", "_id").alias("c"))
    spread = placed.groupBy("bucket").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 <> c1").select("bucket", "c0")
    return materialize(placed.join(spread, "bucket"), "mixed")


def _families(src: DataFrame, left: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) across the classes that share buckets: all of them, as forests of blocks.

    Classes that share a bucket form a family.  In a family, the members of all classes but the largest are
    queries and everyone is a target; queries and targets meet block by block, and a block multiplies
    incidence matrices of the exact multisets.  What leaves a block is a spanning forest, never its pairs.
    """
    fam = materialize(connected_components(left.select(F.col("c").alias("a"), F.col("c0").alias("b"))), "families")
    own = left.select("_id", "n", "c").distinct().join(fam.select(F.col("id").alias("c"), F.col("component").alias("fam")), "c")
    own = materialize(own, "family-members")
    largest = own.groupBy("fam", "c").agg(F.count("*").alias("k"), F.sum("n").alias("items")).groupBy("fam").agg(
        F.max(F.struct("k", "c"))["c"].alias("big"), F.sum("k").alias("k"), F.sum("items").alias("items"), F.max("k").alias("kb")
    )
    blocks = lambda k: F.greatest(F.ceil(k / F.lit(BLOCK_ROWS)), F.ceil(F.col("items") / F.lit(BLOCK_ITEMS))).cast("int")
    plan = materialize(largest.select("fam", "big", blocks(F.col("k")).alias("nt"), blocks(F.col("k") - F.col("kb")).alias("nq")), "family-plan")
    sets = _sets(src, own.select("_id"))
    full = materialize(own.join(plan, "fam").join(sets, "_id"), "family-sets")
    discard(sets)
    block = lambda n, seed: F.pmod(F.xxhash64("_id", F.lit(seed)), F.col(n)).cast("int")
    q = full.where("c <> big").select("fam", F.explode(F.sequence(F.lit(0), F.col("nt") - 1)).alias("tb"), block("nq", 1).alias("qb"), "_id", "items")
    t = full.select(F.col("fam").alias("t_fam"), block("nt", 2).alias("t_tb"), F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("t_qb"), F.col("_id").alias("t_id"), F.col("items").alias("t_items"))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        edges = np.zeros((0, 2), np.int64)
        if a.num_rows and b.num_rows:
            edges = _block_edges(a.column("_id").to_numpy(), a.column("items").combine_chunks(), b.column("t_id").to_numpy(), b.column("t_items").combine_chunks(), threshold)
        return pa.table({"a": pa.array(edges[:, 0]), "b": pa.array(edges[:, 1])})

    met = q.groupBy("fam", "tb", "qb").cogroup(t.groupBy("t_fam", "t_tb", "t_qb")).applyInArrow(run, "a long, b long")
    return materialize(met, "family-links")


def _block_edges(a_ids: np.ndarray, a_items: pa.ListArray, b_ids: np.ndarray, b_items: pa.ListArray, threshold: float) -> np.ndarray:
    """Forest edges of the links between two blocks of multisets."""
    parts = []
    for items in (a_items, b_items):
        size = np.diff(items.offsets.to_numpy())
        parts.append((items.flatten().to_numpy(), np.repeat(np.arange(len(size)), size), size))
    (x, xr, xn), (y, yr, yn) = parts
    shared = np.intersect1d(x, y)
    common = np.zeros((len(xn), len(yn)), np.float32)
    for k in range(0, len(shared), 4096):  # columns of the incidence matrices, a slice at a time
        cols = shared[k : k + 4096]
        both = []
        for v, r, n in ((x, xr, len(xn)), (y, yr, len(yn))):
            at = np.minimum(np.searchsorted(cols, v), len(cols) - 1)
            hit = cols[at] == v
            m = np.zeros((n, len(cols)), np.float32)
            m[r[hit], at[hit]] = 1
            both.append(m)
        common += both[0] @ both[1].T
    c = common.astype(np.float64)
    link = (c >= threshold * (xn[:, None] + yn[None, :] - c)) & (a_ids[:, None] != b_ids[None, :])
    return forest(a_ids, b_ids, link)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``class_id`` (smallest id reachable through links) and ``kept``, one row per document.

    A link is a weighted Jaccard similarity of word five-shingle multisets of ``threshold`` or more.
    A text of fewer than five words is one shingle; texts with no words (null, empty) link with nothing,
    and so do rows with a null id, whose class is null.  Repeated rows of an id share its class.
    An empty table gives an empty result; other columns are not read, whatever their names.
    """
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    bounded_batches(docs.sparkSession)
    sig = materialize(signed(src), "signed")
    usable = sig.where("n > 0 and _id is not null")
    keys = materialize(usable.groupBy("key").agg(F.min("_id").alias("rep")), "keys")
    # Identical texts are stars already: one of them stands for all, and only such representatives enter the graph.
    of = materialize(usable.select("_id", "key").join(keys, "key").groupBy("_id").agg(F.min("rep").alias("rep"), F.max("rep").alias("other")), "representatives")
    same_id = of.where("rep <> other").select(F.col("rep").alias("a"), F.col("other").alias("b"))  # rows of one id with different texts
    copies = of.where("_id <> rep").select("_id")
    n_copies = copies.count()
    reps = usable.join(F.broadcast(copies) if n_copies <= BROADCAST_IDS else copies, "_id", "left_anti")
    members = reps.select("_id", "n", F.explode("bands").alias("bucket"))
    pivots = members.groupBy("bucket").agg(F.min("_id").alias("p"), F.count("*").alias("k")).where("k > 1").select("bucket", "p")
    pivots = materialize(pivots, "pivots")
    mem = materialize(members.join(pivots, "bucket"), "members")  # buckets of two and more
    # Round 1: each text against the smallest pivot of all its buckets.
    first = mem.where("_id <> p").groupBy(F.col("_id").alias("b")).agg(F.min("p").alias("a")).select("a", "b")
    known = _check(src, materialize(first, "pairs"), threshold)
    links = same_id.unionByName(known.where("ok").select("a", "b"))
    # Round 2: the members of a bucket that belong to another class than its pivot against the pivot.
    left = _mixed(mem, materialize(connected_components(links), "components"))
    of_pivot = left.where("_id = p").select("bucket", F.col("c").alias("pc"))
    star = left.join(of_pivot, "bucket").where("c <> pc").select(F.least("p", "_id").alias("a"), F.greatest("p", "_id").alias("b")).distinct()
    more = _check(src, materialize(star.join(known.select("a", "b"), ["a", "b"], "left_anti"), "pairs"), threshold)
    links = links.unionByName(more.where("ok").select("a", "b"))
    # Round 3: what still shares a bucket across classes, family by family.
    left = _mixed(mem, materialize(connected_components(links), "components"))
    links = links.unionByName(_families(src, left, threshold))
    comp = materialize(connected_components(links), "components")
    found = of.select("_id", "rep").join(comp.withColumnRenamed("id", "rep"), "rep", "left").select("_id", F.coalesce("component", "rep").alias("component"))
    out = src.select("_id").join(materialize(found, "found"), "_id", "left")
    cls = F.coalesce("component", "_id")
    return out.select(F.col("_id").alias(id_col), cls.alias("class_id"), F.coalesce(cls == F.col("_id"), F.lit(True)).alias("kept"))
