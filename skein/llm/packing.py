"""Best-fit packing planned on the length histogram.

1. Every document is tokenized where it lies; only longer ones than a sequence are cut, the short
   piece first.  Per piece the workers keep its length, a checksum and its rank among the pieces of
   the same length in the partition.
2. The histogram of lengths (at most ``capacity`` numbers) goes to the driver, which packs counts,
   not documents: lengths in descending order, each into the open sequences with the least room that
   still fits, a whole group of equal sequences at a time.  The result is a list of runs: "ranks
   k..k+n of length l go to sequences s..s+n at offset o".
3. Pieces find their run by their rank within their length.  Ranks are made unique across partitions
   by running sums over (length, partition) counts, so no length is ever gathered in one task.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.common import bounded_batches, materialize

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Fixed value: the split pattern of byte-level BPE files.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Printable ASCII, tab and line ends, and Latin letters: here the split pattern means the same to
#: Python's ``regex`` and to the tokenizer.  Other texts go to the tokenizer whole.
_PLAIN = re.compile(r"[\x20-\x7e\t\n\r¡-ſ]*")


class ByteTokenizer:
    """Ids of whole texts as little-endian uint32 bytes.

    The vocabulary and merges are the file's.  When its ids ascend in merge order, as byte-level files'
    do, plain texts go through a rank encoder built from them, which gives the same ids in less time.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        self.fast = _rank_encoder(path)

    def ids(self, text: str | None) -> bytes:
        text = text or ""
        if self.fast is None or "<|" in text or not _PLAIN.fullmatch(text):
            return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()
        return self.fast.encode_to_numpy(text, disallowed_special=()).tobytes()


def _rank_encoder(path: str):  # noqa: ANN202 - an encoder or None
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"][a + b] for a, b in pairs]
    if made != sorted(made) or len(set(made)) < len(made):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if all(c in byte_of for c in t)}
    if len(ranks) != len(model["vocab"]) or min(made) < max(ranks[bytes([b])] for b in range(256)):
        return None
    return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


_TOKENIZERS: dict[str, ByteTokenizer] = {}


def tokenizer(path: str) -> ByteTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ByteTokenizer(path)
    return _TOKENIZERS[path]


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else the shorter piece first."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, count, first sequence, offset) of a best-fit-decreasing packing.

    Sequences with equal contents form one group, so the work depends on the number of distinct
    lengths and not on the number of pieces.
    """
    rooms: list[int] = []  # the rooms for which there are groups, ascending
    groups: dict[int, list[tuple[int, int]]] = {}  # room -> [(first sequence, how many)]
    runs, opened = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room:
            if room not in groups:
                groups[room] = []
                insort(rooms, room)
            groups[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                first, n = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    rooms.pop(i)
                take = min(n, left)
                if take < n:
                    put(room, first + take, n - take)
            else:
                room, first = capacity, opened
                take = -(-left // (capacity // length)) if capacity // length > 1 else left
                opened += take
            runs.append((length, rank, take, first, capacity - room))
            put(room - length, first, take)
            rank, left = rank + take, left - take
    return runs


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, and its place (part, local rank)."""
    bounded_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, part = tokenizer(tokenizer_path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for b in batches:
            rows: list[tuple] = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = t.ids(text.as_py()) + end
                for k, (s, n) in enumerate(pieces_of(len(ids) // 4, capacity)):
                    rows.append((doc, k, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)]), part, int(seen[n])))
                    seen[n] += 1
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["_id", "piece", "start", "length", "ids_crc32", "_part", "_local"])

    return src.mapInArrow(run, "_id long, piece int, start long, length long, ids_crc32 long, _part int, _local long")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns per piece: ``id_col``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``,
    ``offset``.  A null or empty text is one token, the end id.  Repeated rows are packed as often
    as they occur; an empty table gives an empty result; other columns are not read.
    The pieces are written once, so a task that runs again cannot change a rank.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    pieces = materialize(tokenized_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pieces")
    counts = pieces.groupBy("length", "_part").agg(F.count("*").alias("n"))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    runs = plan(totals, capacity)
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("_base", F.coalesce(F.sum("n").over(before), F.lit(0))).groupBy("_part").agg(F.map_from_entries(F.collect_list(F.struct("length", "_base"))).alias("_bases"))
    # a partition's bases are at most `capacity` numbers: its pieces join them by partition
    flat = sorted((length, rank, first, offset) for length, rank, _n, first, offset in runs)
    table = np.array(flat, dtype=np.int64).reshape(-1, 4)
    edges = np.searchsorted(table[:, 0], np.arange(capacity + 2))

    placed = pieces.join(bases, "_part").select(
        "_id", "piece", "start", "length", "ids_crc32", (F.col("_local") + F.element_at("_bases", F.col("length"))).alias("_rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                rows = np.flatnonzero(length == n)
                own = table[edges[n] : edges[n + 1]]
                k = np.searchsorted(own[:, 1], rank[rows], side="right") - 1
                seq[rows] = own[k, 2] + rank[rows] - own[k, 1]
                off[rows] = own[k, 3]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(off)], ["_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    out = placed.mapInArrow(place, "_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("_id", id_col)
