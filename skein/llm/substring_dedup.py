"""Removal of repeated byte strings by suffix arrays over shards.

A byte goes if it lies in a string of ``length`` bytes that starts at two places of the corpus.

1. Winnowing.  In every window of ``length`` bytes the smallest hash of its ``GRAM``-byte strings
   picks one string, by content alone, so equal windows pick equal strings at equal offsets.
   Neighbouring windows mostly pick the same place; a document becomes a list of (hash, windows).
2. Only places whose hash occurs twice can hold equal windows.  Counting is a partial aggregate.
   Documents with the same whole text count once as a text: one of them stands for all.
3. The bytes around such places, each distinct context once with its multiplicity, are sharded by
   hash.  All equal windows meet in one shard: their suffix array is built by induced sorting, and
   permuted common prefixes of ``length`` or more mark the windows that occur twice.
4. A hash with very many distinct contexts would make a shard grow without bound.  Its windows are
   dealt out one by one by a cryptographic digest of their bytes (BLAKE2b, 128 bits) and counted: the way
   for hot places, exact because no two strings of one digest can be found.
5. Marked windows go back to their documents as byte intervals; their union is cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import U, bounded_batches, materialize, mix64, release
from skein.llm.suffix_array import permuted_lcp, suffix_array

GRAM = 64
#: Bytes of contexts that a shard holds on average, and the most that one hash may bring to a shard.
SHARD_BYTES, HOT_BYTES = 2_000_000, 1_000_000
#: Ids up to this many are broadcast when they filter the texts; above it the join is by key.
BROADCAST_IDS = 1_000_000
#: Text is worked on in blocks of about this many bytes.
BLOCK = 600_000

_BASE = U(0x9E3779B97F4A7C15 | 1)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
#: Low bits of a hash that give way to its place: a window is far shorter than this range.
_PLACE = U((1 << 26) - 1)
_TABLE = mix64(np.arange(256, dtype=np.uint64)) | U(1)


def _powers(n: int, base: np.uint64) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes at each position (rolling: prefix sums times inverse powers)."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        s = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * _powers(len(data), _BASE), dtype=np.uint64)])
        return mix64((s[k:] - s[:-k]) * _powers(n, _INVERSE))


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours."""
    n = len(v) - w + 1
    pad = -len(v) % w
    x = np.concatenate([v, np.full(pad, np.iinfo(v.dtype).max, v.dtype)]).reshape(-1, w)
    fore = np.minimum.accumulate(x, axis=1).ravel()
    back = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], fore[w - 1 : w - 1 + n])


def winnow(texts: list[bytes], length: int, gram: int) -> list[list[np.ndarray]]:
    """Per text: arrays hash (int64), first window, number of windows, place of the string."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    edges = np.cumsum([0, *map(len, texts)])
    none = [np.zeros(0, np.int64)] * 4
    if len(data) < length:
        return [none for _ in texts]
    h = gram_hashes(data, gram)
    at = np.arange(len(h), dtype=np.uint64)
    low = sliding_min((h & ~_PLACE) | (at & _PLACE), length - gram + 1)  # ties: the leftmost
    at = at[: len(low)]
    place = (at + ((low - at) & _PLACE)).astype(np.int64)
    out = []
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        if hi - lo < length:
            out.append(none)
            continue
        p = place[lo : hi - length + 1]
        first = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        n = np.diff(np.append(first, len(p)))
        out.append([h[p[first]].view(np.int64), first, n, p[first] - lo])
    return out


def _blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Slices of a list of texts of about BLOCK bytes."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BLOCK:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def _prints(docs: DataFrame, length: int) -> DataFrame:
    kind = "_id long, n_bytes long, sha string, h array<long>, s array<int>, n array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0)
            texts = [(x.as_py() or "").encode() for x in b.column(1)]
            for lo, hi in _blocks(texts):
                got = winnow(texts[lo:hi], length, GRAM)
                cols = [[g[i] for g in got] for i in (0, 1, 2)]
                arrays = [_lists(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.int32()), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array([len(t) for t in texts[lo:hi]], pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in texts[lo:hi]]), *arrays], ["_id", "n_bytes", "sha", "h", "s", "n"]
                )
        release()

    return docs.mapInArrow(run, kind)


def _lists(xs: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.cumsum([0, *map(len, xs)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(xs) if xs else [], kind))


def semi(df: DataFrame, ids: DataFrame, col: str, n: int) -> DataFrame:
    """Rows of ``df`` whose ``col`` is among ``ids`` (n distinct rows): broadcast only if few."""
    keep = ids.select(col)
    return df.join(F.broadcast(keep) if n <= BROADCAST_IDS else keep, col, "left_semi")


def _contexts(joined: DataFrame, length: int, out: str, hot: bool) -> DataFrame:
    """Bytes around the candidate places of each document.

    Plain: one row a place (h, c1, c2, _id, s, n, content).  Hot: one row a window (w1, w2, _id, at).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, text, places in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                raw = (text.as_py() or "").encode()
                if hot:
                    at = np.concatenate([np.arange(p["s"], p["s"] + p["n"]) for p in places])
                    for k in range(0, len(at), 50_000):
                        x = at[k : k + 50_000]
                        w = np.frombuffer(b"".join([hashlib.blake2b(raw[i : i + length], digest_size=16).digest() for i in x.tolist()]), np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(w[0::2]), pa.array(w[1::2]), pa.array(np.full(len(x), doc)), pa.array(x.astype(np.int32))], ["w1", "w2", "_id", "at"])
                    continue
                parts = [raw[p["s"] : p["s"] + p["n"] + length - 1] for p in places]
                digest = np.frombuffer(b"".join(hashlib.blake2b(c, digest_size=16).digest() for c in parts), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p["h"] for p in places], pa.int64()), pa.array(digest[0::2]), pa.array(digest[1::2]), pa.array([doc] * len(places), pa.int64()), pa.array([p["s"] for p in places], pa.int32()), pa.array([p["n"] for p in places], pa.int32()), pa.array(parts, pa.binary())],
                    ["h", "c1", "c2", "_id", "s", "n", "content"],
                )
        release()

    return joined.mapInArrow(run, out)


def _shard(key, pdf, length: int):  # noqa: ANN001, ANN202
    """One shard: marks for each context, as runs of window numbers (from its first window)."""
    import pandas as pd

    content = pdf["content"].tolist()
    size = np.fromiter(map(len, content), np.int64, len(content))
    joined = b"\x00".join(content)
    text = np.frombuffer(joined, np.uint8).astype(np.int16) + 1
    starts = np.concatenate([[0], np.cumsum(size[:-1] + 1)])
    text[starts[1:] - 1] = 0  # a symbol that no text holds, between contexts
    sa = suffix_array(text)
    plcp, phi = permuted_lcp(text, sa, starts, 2 * length + 16)
    valid = np.zeros(len(text), bool)
    windows = size - length + 1
    valid[np.repeat(starts, windows) + _ranges(windows)] = True
    twice = (plcp >= length) & valid
    marked = twice.copy()
    marked[phi[np.flatnonzero(twice)]] = True
    many = np.flatnonzero(pdf["mult"].to_numpy() > 1)
    if len(many):
        marked[np.repeat(starts[many], windows[many]) + _ranges(windows[many])] = True
    marked &= valid
    edge = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    own = np.searchsorted(starts, first, side="right") - 1
    del sa, plcp, phi, text
    release()
    return pd.DataFrame({"h": pdf["h"].to_numpy()[own], "c1": pdf["c1"].to_numpy()[own], "c2": pdf["c2"].to_numpy()[own], "a": (first - starts[own]).astype(np.int32), "b": (end - starts[own]).astype(np.int32)})


def _ranges(sizes: np.ndarray) -> np.ndarray:
    """0..size-1 for each size, in one array."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def repeated_spans(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``_id``, ``n_bytes``, ``sha``, ``whole`` and ``runs`` (sorted [a, b) bytes to remove).

    ``whole``: the text occurs elsewhere too and is at least ``length`` bytes long, so all of it goes;
    ``runs`` is then empty, as it is where nothing repeats.  Ids must be distinct and not null.
    """
    if length < GRAM:
        raise ValueError(f"length must be {GRAM} at least")
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    bounded_batches(docs.sparkSession)
    prints = materialize(_prints(src, length), "prints")
    texts = materialize(prints.groupBy("sha").agg(F.min("_id").alias("_id"), F.count("*").alias("copies")), "texts")
    extra = materialize(prints.select("_id", "sha").join(texts.where("copies > 1").select("sha", F.col("_id").alias("_rep")), "sha").where("_id <> _rep").select("_id"), "copies")
    n_extra = extra.count()
    once_each = prints.join(F.broadcast(extra) if n_extra <= BROADCAST_IDS else extra, "_id", "left_anti")
    places = once_each.select("_id", F.explode(F.arrays_zip("h", "s", "n")).alias("p")).select("_id", "p.h", "p.s", "p.n")
    repeated = materialize(places.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h"), "hashes")
    found = places.join(repeated, "h")
    cand = materialize(found.groupBy("_id").agg(F.collect_list(F.struct("h", "s", "n")).alias("places")), "places")  # one document's own places
    n_cand = cand.count()
    joined = semi(src, cand, "_id", n_cand).join(cand, "_id").select("_id", "_text", "places")
    ctx = _contexts(joined, length, "h long, c1 long, c2 long, _id long, s int, n int, content binary", False)
    ctx = materialize(ctx, "contexts")
    locations = ctx.select("h", "c1", "c2", "_id", "s")
    distinct = ctx.groupBy("h", "c1", "c2").agg(F.count("*").alias("mult"), F.sum(F.length("content")).alias("bytes"))
    load = distinct.groupBy("h").agg(F.count("*").alias("k"), F.sum(F.col("bytes") / F.col("mult")).alias("bytes"))
    load = materialize(load, "load")
    row = load.where(F.col("bytes") <= HOT_BYTES).agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("b")).first()
    hot = load.where(F.col("bytes") > HOT_BYTES).select("h")
    n_hot = hot.count()
    shards = max(1, int(row["b"] // SHARD_BYTES) + 1)
    calm = ctx.join(F.broadcast(hot), "h", "left_anti") if 0 < n_hot <= BROADCAST_IDS else (ctx.join(hot, "h", "left_anti") if n_hot else ctx)
    once = calm.groupBy("h", "c1", "c2").agg(F.count("*").alias("mult"), F.min("content").alias("content"))
    marks = once.withColumn("_shard", F.pmod(F.xxhash64("h"), F.lit(shards))).groupBy("_shard").applyInPandas(lambda key, pdf: _shard(key, pdf, length), "h long, c1 long, c2 long, a int, b int")
    marks = materialize(marks, "marks")
    spans = locations.join(marks, ["h", "c1", "c2"]).select("_id", (F.col("s") + F.col("a")).alias("a"), (F.col("s") + F.col("b") + length - 1).alias("b"))
    if n_hot:
        hot_places = found.join(F.broadcast(hot) if n_hot <= BROADCAST_IDS else hot, "h").groupBy("_id").agg(F.collect_list(F.struct("h", "s", "n")).alias("places"))
        hot_places = materialize(hot_places, "hot")
        n = hot_places.count()
        win = materialize(_contexts(semi(src, hot_places, "_id", n).join(hot_places, "_id").select("_id", "_text", "places"), length, "w1 long, w2 long, _id long, at int", True), "windows")
        twice = materialize(win.groupBy("w1", "w2").agg(F.count("*").alias("c")).where("c > 1").select("w1", "w2"), "twice")
        spans = spans.unionByName(win.join(twice, ["w1", "w2"]).select("_id", F.col("at").alias("a"), (F.col("at") + length).alias("b")))
    per_doc = spans.groupBy("_id").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("runs"))  # one document's own runs
    none = F.expr("cast(array() as array<struct<a:int,b:int>>)")

    out = prints.select("_id", "n_bytes", "sha").join(texts.select("sha", "copies"), "sha").join(per_doc, "_id", "left")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    return out.select("_id", "n_bytes", "sha", whole.alias("whole"), F.when(whole, none).otherwise(F.coalesce("runs", none)).alias("runs"))


def merged(runs: list[dict]) -> list[tuple[int, int]]:
    """Sorted runs as disjoint, non-touching intervals."""
    out: list[tuple[int, int]] = []
    for r in runs:
        if out and r["a"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], r["b"]))
        else:
            out.append((r["a"], r["b"]))
    return out


def _char_edges(raw: bytes, a: int, b: int) -> tuple[int, int]:
    """The interval shrunk to whole UTF-8 characters."""
    while a < b and raw[a] & 0xC0 == 0x80:
        a += 1
    while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
        b -= 1
    return a, b


def cut_out(raw: bytes, gone: list[tuple[int, int]]) -> bytes:
    """The bytes outside the intervals."""
    out, at = [], 0
    for a, b in gone:
        out.append(raw[at:a])
        at = b
    out.append(raw[at:])
    return b"".join(out)


def digests(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What removal of all repeated ``length``-byte strings leaves: counts and a digest per document.

    Returns ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256``.
    A null text counts as empty; texts shorter than ``length`` lose nothing; copies of a whole text lose
    everything; an empty table stays empty.  Rows are told apart by a number of their own, so ids may be
    null or shared: each row is judged by its text and gives one row.
    """
    src = docs.select(F.monotonically_increasing_id().alias("_id"), F.col(id_col).cast("long").alias("_doc"), F.col(text_col).cast("string").alias("_text"))
    src = materialize(src, "rows")
    spans = materialize(repeated_spans(src, length, "_id", "_text"), "spans")
    part = spans.where(~F.col("whole") & (F.size("runs") > 0)).select("_id", "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text, runs in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                raw, gone = (text.as_py() or "").encode(), merged(runs)
                left = cut_out(raw, gone)
                rows.append((doc, len(raw) - len(left), len(gone), hashlib.sha256(left).hexdigest()))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["_id", "n_removed", "n_spans", "kept_sha256"])

    edited = semi(src, part, "_id", part.count()).join(part, "_id").select("_id", "_text", "runs").mapInArrow(cut, "_id long, n_removed long, n_spans long, kept_sha256 string")
    whole = F.col("whole")
    return spans.drop("runs").join(edited, "_id", "left").join(src.select("_id", "_doc"), "_id").select(
        F.col("_doc").alias(id_col),
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated strings cut out of ``text_col``; all other columns as they were.

    Removed runs shrink to whole characters, so the text stays valid.  Texts that lose everything become
    empty strings.  Untouched documents are passed through without moving their text.  Rows are told apart
    by a number of their own, so ids may be null or shared.
    """
    columns, row = docs.columns, "_skein_row"
    docs = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    spans = materialize(repeated_spans(docs.select(row, text_col), length, row, text_col), "spans")
    touched = materialize(spans.where(F.col("whole") | (F.size("runs") > 0)).select(F.col("_id").alias(row), F.col("whole").alias("_skein_whole"), F.col("runs").alias("_skein_runs")), "touched")
    n = touched.count()
    ids = touched.select(row)
    rest = docs.join(F.broadcast(ids) if n <= BROADCAST_IDS else ids, row, "left_anti")

    @F.pandas_udf("string", F.PandasUDFType.SCALAR_ITER)
    def cut(batches):  # noqa: ANN001, ANN202
        import pandas as pd

        for texts, runs in batches:
            out = []
            for text, r in zip(texts, runs, strict=True):
                raw = (text or "").encode()
                out.append(cut_out(raw, [_char_edges(raw, a, b) for a, b in merged(list(r))]).decode())
            yield pd.Series(out)
        release()

    edited = semi(docs, touched, row, n).join(touched, row)
    edited = edited.withColumn(text_col, cut(F.when(~F.col("_skein_whole"), F.col(text_col)), F.col("_skein_runs"))).select(*columns)
    return rest.select(*columns).unionByName(edited)
