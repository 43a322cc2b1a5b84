"""Brown class-based bigram language model.

Counting covers every training text.  Tables that come out of it: word counts (distributed, as large as
the vocabulary), neighbouring words among the most frequent ones (bounded, see ``sizes``), the class
neighbours of every other word (distributed), and counts of neighbouring classes.

* Exchange clustering runs on the driver over the bounded bigram table: each of its words moves to the
  class that raises the class-bigram likelihood most, until a sweep moves nothing.
* Every other word that occurs twice or more is placed, once and by tasks, in the class whose
  class-bigram likelihood its own class neighbours raise most.  The number of classes and of words
  clustered on the driver grow with the number of such words.
* Words seen once or never are the rare class, and the end of a text is its own class.
* ``P(w | v) = P(class w | class v) * P(w | class w)``: transitions are interpolated with the class
  unigram, emissions use the counts of the whole corpus, and the class of rare words keeps the mass
  of unseen ones.  Logarithms are to base 10.

The most frequent words travel with the task as a cache of the word table; the others of a text find
their count and class by a join on the word, so the size of the cache changes no result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import bounded_batches, discard, materialize

#: Spill a partition's word counts beyond this many distinct words.
COUNT_WORDS = 500_000
#: Spill a partition's class neighbours beyond this many distinct words or tokens.
PLACE_WORDS, PLACE_TOKENS = 200_000, 2_000_000
#: In a coded text: a word that is not in the cache.
_TAIL = 65_535


def tokens(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lowered, split at 0x20 and 0x09-0x0D; the end token is not included."""
    return (text or "").encode().lower().split()  # bytes: exactly the ASCII letters and blanks


class _Index(dict):
    """Numbers for words, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _parts(lists: pa.Array) -> tuple[np.ndarray, pa.StructArray]:
    """A list column of structs as the number of entries in each row and the entries of all."""
    size = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    return size, lists.flatten()


def _int32s(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A binary column of int32 bytes as the numbers in each row and all numbers."""
    size = np.nan_to_num(pc.binary_length(values).to_numpy(zero_copy_only=False)).astype(np.int64) // 4
    first = np.frombuffer(values.buffers()[1], np.int32)[values.offset] if len(values) else 0
    data = values.buffers()[2] if len(values) else None
    return size, np.frombuffer(data, np.int32, int(size.sum()), int(first)) if data is not None and size.sum() else np.zeros(0, np.int32)


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word`` (binary), ``c`` over all texts; the end of a text is not a word here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "c"])
            seen.clear()
            return out

        for b in batches:
            for text in b.column(0):
                seen.update(tokens(text.as_py()))
                if len(seen) > COUNT_WORDS:
                    yield flush()
        if seen:
            yield flush()

    part = docs.select(F.col(text_col).cast("string").alias("_text")).mapInArrow(run, "word binary, c long")
    return part.groupBy("word").agg(F.sum("c").alias("c"))


def _pairs(docs: DataFrame, of: dict[bytes, int], other: int, end: int, size: int, text_col: str) -> DataFrame:
    """Counts of neighbouring symbols: ``code`` = left * size + right, ``n``; texts begin after an end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, dtype=np.int64)
        for b in batches:
            seq: list[int] = []
            for text in b.column(0):
                seq.append(end)
                seq.extend([of.get(w, other) for w in tokens(text.as_py())])
            s = np.array([*seq, end], dtype=np.int64)
            if len(s) > 1:
                total += np.bincount(s[:-1] * size + s[1:], minlength=size * size)
        k = np.flatnonzero(total)
        for i in range(0, len(k), 200_000):
            part = k[i : i + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["code", "n"])

    part = docs.select(F.col(text_col).cast("string").alias("_text")).mapInArrow(run, "code long, n long")
    return part.groupBy("code").agg(F.sum("n").alias("n"))


def _matrix(pairs: DataFrame, size: int) -> np.ndarray:
    """A bounded table of pairs as a dense matrix on the driver."""
    t = pairs.toArrow()
    out = np.zeros(size * size)
    out[t.column("code").to_numpy()] = t.column("n").to_numpy()
    return out.reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))  # counts: 0, or 1 and more


def exchange(bigrams: np.ndarray, classes: int, fixed: int) -> np.ndarray:
    """Exchange clustering of the first ``len - fixed`` symbols into ``classes``; the rest keep their own.

    Starts from frequency order dealt round robin; a symbol moves to the class of highest class-bigram
    log-likelihood, ties to the lowest class, until a sweep moves nothing.  Deterministic.  A move must
    gain more than rounding could, so the likelihood rises with each one and the sweeps end.
    """
    n = len(bigrams)
    free = n - fixed
    k = classes + fixed
    cls = np.concatenate([np.arange(free) % max(classes, 1), classes + np.arange(fixed)]).astype(np.int64)
    onehot = np.zeros((n, k))
    onehot[np.arange(n), cls] = 1.0
    right = bigrams @ onehot  # symbol -> class to its right
    left = bigrams.T @ onehot  # symbol <- class to its left
    g = onehot.T @ right
    h = _xlogx
    least = 1e-9 + 1e-12 * float(h(bigrams.sum()))
    while True:
        moved = 0
        for w in range(free):
            a = cls[w]
            r, l, own = right[w].copy(), left[w].copy(), bigrams[w, w]
            if r.sum() + l.sum() == 0:
                continue
            r[a] -= own
            l[a] -= own
            g[a, :] -= r
            g[:, a] -= l
            g[a, a] -= own
            rows, cols = g.sum(1) + l, g.sum(0) + r  # the totals keep w as a neighbour, whatever its class
            # gain of adding w to each class b: changes in row b, column b and their crossing
            gain = (h(g[:classes] + r) - h(g[:classes])).sum(1) + (h(g[:, :classes].T + l) - h(g[:, :classes].T)).sum(1)
            d = np.diag(g)[:classes]
            gain += h(d + r[:classes] + l[:classes] + own) - h(d + r[:classes]) - h(d + l[:classes]) + h(d)
            gain -= h(rows[:classes] + r.sum() + own) - h(rows[:classes]) + h(cols[:classes] + l.sum() + own) - h(cols[:classes])
            b = int(np.argmax(gain))
            if b != a and gain[b] <= gain[a] + least:
                b = int(a)
            g[b, :] += r
            g[:, b] += l
            g[b, b] += own
            if b != a:
                cls[w] = b
                moved += 1
                right[:, a] -= bigrams[:, w]
                right[:, b] += bigrams[:, w]
                left[:, a] -= bigrams[w, :]
                left[:, b] += bigrams[w, :]
        if not moved:
            break
    return cls


def sizes(recurring: int, cluster_words: int, classes: int) -> tuple[int, int]:
    """Words clustered on the driver and classes, for so many words that occur twice or more.

    Classes are their cube root, ``classes`` at least, and the words grow in proportion.
    """
    k = max(classes, round(recurring ** (1 / 3)))
    m = min(recurring, cluster_words * k // classes)
    return m, max(1, min(k, m))


def _class_neighbours(train: DataFrame, top: dict[bytes, int], other: int, end: int, text_col: str) -> DataFrame:
    """``word``, ``codes``, ``ns``: counts of the classes beside each word outside ``top``; a row a word and spill.

    A code is the class to the right, or ``end + 1`` more than the class to the left.  Values are int32 bytes.
    """
    width = 2 * (end + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = _Index({w: i for i, w in enumerate(top)})
        m, cls = len(top), np.array([*top.values(), 0], np.int64)
        parts: list[np.ndarray] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            code, n = np.unique(np.concatenate(parts), return_counts=True)
            edges = np.searchsorted(code, np.arange(len(at) - m + 1) * width)
            code, n, words = (code % width).astype(np.int32), n.astype(np.int32), list(at)[m:]
            for i in range(0, len(words), 50_000):
                e = edges[i : i + 50_001]
                offsets = pa.py_buffer(((e - e[0]) * 4).astype(np.int32))
                binary = [pa.Array.from_buffers(pa.binary(), len(e) - 1, [None, offsets, pa.py_buffer(x[e[0] : e[-1]])]) for x in (code, n)]
                yield pa.RecordBatch.from_arrays([pa.array(words[i : i + 50_000], pa.binary()), *binary], ["word", "codes", "ns"])
            for w in words:
                del at[w]
            parts.clear()

        for b in batches:
            seq = [-1]  # the end of a text
            for text in b.column(0):
                seq.extend(map(at.__getitem__, tokens(text.as_py())))
                seq.append(-1)
            x = np.array(seq, np.int64)
            s = np.where(x < 0, end, np.where(x < m, cls[np.clip(x, 0, m)], other))
            i = np.flatnonzero(x >= m)
            if len(i):
                parts += [(x[i] - m) * width + s[i + 1], (x[i] - m) * width + end + 1 + s[i - 1]]
                held += 2 * len(i)
            if len(at) - m > PLACE_WORDS or held > PLACE_TOKENS:
                yield from flush()
                held = 0
        if parts:
            yield from flush()

    return train.select(F.col(text_col).cast("string").alias("_text")).mapInArrow(run, "word binary, codes binary, ns binary")


def place(codes: np.ndarray, ns: np.ndarray, owner: np.ndarray, words: int, g: np.ndarray, classes: int) -> np.ndarray:
    """Class of each of ``words`` words: the one of highest class-bigram log-likelihood, ties to the lowest.

    ``codes`` and ``ns`` are class neighbours as ``_class_neighbours`` counts them, ``owner`` (rising) their word.
    """
    k = len(g)
    side = np.bincount(owner * 2 * k + codes, weights=ns, minlength=words * 2 * k).reshape(words, 2 * k)
    out = np.zeros(words, np.int64)
    h = _xlogx
    by = np.concatenate([g[:classes].T, g[:, :classes]])  # code -> count beside each class
    base = h(by)
    rows, cols, d = g.sum(1)[:classes], g.sum(0)[:classes], np.diag(g)[:classes]
    for lo in range(0, words, 256):
        part = side[lo : lo + 256]
        w, code = np.nonzero(part)
        gain = np.zeros((len(part), classes))
        if len(w):
            first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            gain[w[first]] = np.add.reduceat(h(by[code] + part[w, code][:, None]) - base[code], first, axis=0)
        r, l = part[:, :classes], part[:, k : k + classes]
        gain += h(d + r + l) - h(d + r) - h(d + l) + h(d)
        gain -= h(rows + part[:, :k].sum(1)[:, None]) - h(rows) + h(cols + part[:, k:].sum(1)[:, None]) - h(cols)
        out[lo : lo + 256] = gain.argmax(1)
    return out


def word_classes(counts: DataFrame, train: DataFrame, recurring: int, cluster_words: int, classes: int, text_col: str) -> tuple[DataFrame, int]:
    """``word``, ``c``, ``cls`` of every word, and the number of classes before the rare one and the end's."""
    m, k = sizes(recurring, cluster_words, classes)
    again = counts.where("c > 1")
    top = [bytes(r["word"]) for r in again.orderBy(F.desc("c"), "word").limit(m).collect()] if m else []
    m = len(top)
    big = _matrix(_pairs(train, {w: i for i, w in enumerate(top)}, m, m + 1, m + 2, text_col), m + 2)
    cls = exchange(big, k, 2)
    onehot = np.zeros((m + 2, k + 2))
    onehot[np.arange(m + 2), cls] = 1.0
    g = onehot.T @ big @ onehot
    of = {w: int(cls[i]) for i, w in enumerate(top)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, c = b.column(0).to_pylist(), b.column(1)
            size, near = _parts(b.column(2))
            n, codes = _int32s(near.field("codes"))
            own = np.repeat(np.repeat(np.arange(len(words)), size), n)
            got = place(codes, _int32s(near.field("ns"))[1], own, len(words), g, k)
            got = [of.get(w, x) for w, x in zip(words, got.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), c, pa.array(got, pa.int32())], ["word", "c", "cls"])

    near = _class_neighbours(train, of, k, k + 1, text_col)
    met = again.join(near, "word", "left").groupBy("word").agg(F.max("c").alias("c"), F.collect_list(F.struct("codes", "ns")).alias("near"))  # an entry a task and spill
    placed = met.mapInArrow(run, "word binary, c long, cls int")
    rare = counts.where("c = 1").select("word", "c", F.lit(k).alias("cls"))
    return materialize(placed.unionByName(rare), "word-classes"), k


def _coded(docs: DataFrame, train_where: str, words: DataFrame, head: dict[bytes, tuple[int, int]], rare: int, end: int, id_col: str, text_col: str) -> DataFrame:
    """Every text as classes: ``_id``, ``_train``, ``n``, ``seq`` (uint16 bytes, an end at both sides) and sums over its words.

    ``known`` counts the words of the table, ``base`` sums log10(c + 1) over all and ``emit`` the log10 of
    c, or for rare words c + 1.
    """
    src = docs.select(
        F.col(id_col).cast("long").alias("_id"),
        F.col(text_col).cast("string").alias("_text"),
        F.monotonically_increasing_id().alias("_row"),
        F.coalesce(F.expr(train_where), F.lit(False)).alias("_train"),
    )

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {w: i for i, w in enumerate(head)}
        c, cls = (np.array([*(x[i] for x in head.values()), 0], np.int64) for i in (0, 1))
        cls[-1] = _TAIL  # a word at -1 is outside the cache
        base, emit = np.log10(c + 1.0), np.log10(np.maximum(c, 1))
        for b in batches:
            out: list[tuple] = []
            for text in b.column(1):
                ws = tokens(text.as_py())
                x = np.fromiter(map(at.get, ws, repeat(-1)), np.int64, len(ws))
                left = _Index()
                far = np.flatnonzero(x < 0)
                tail = np.array([left[ws[i]] for i in far], np.int32)
                seq = np.full(len(ws) + 2, end, np.uint16)
                seq[1:-1] = cls[x]
                out.append((len(ws) + 1, len(ws) - len(far), float(base[x].sum()), float(emit[x].sum()), seq.tobytes(), tail.tobytes(), list(left)))
            cols = list(zip(*out, strict=True)) if out else [[]] * 7
            kinds = [pa.int64()] * 2 + [pa.float64()] * 2 + [pa.binary()] * 2 + [pa.list_(pa.binary())]
            arrays = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(2), b.column(0), b.column(3), *arrays], ["_row", "_id", "_train", "n", "known", "base", "emit", "seq", "tail", "words"])

    sums = "_id long, _train boolean, n long, known long, base double, emit double, seq binary"
    raw = materialize(src.mapInArrow(code, f"_row long, {sums}, tail binary, words array<binary>"), "texts")
    found = raw.select("_row", F.posexplode("words").alias("i", "word")).join(words, "word").groupBy("_row").agg(F.collect_list(F.struct("i", "c", "cls")).alias("found"))  # one text's own words

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = {x: b.column(x).to_pylist() for x in ("n_words", "known", "base", "emit", "seq", "tail")}
            size, parts = _parts(b.column("found"))
            edges = np.concatenate([[0], np.cumsum(size)])
            at_, c_, cls_ = (parts.field(x).to_numpy(zero_copy_only=False) for x in ("i", "c", "cls"))
            known, base, emit, seqs = [], [], [], []
            for j, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                seq, tail = np.frombuffer(t["seq"][j], np.uint16).copy(), np.frombuffer(t["tail"][j], np.int32)
                c, cls = np.zeros(t["n_words"][j], np.int64), np.full(t["n_words"][j], rare, np.uint16)
                c[at_[lo:hi]], cls[at_[lo:hi]] = c_[lo:hi], cls_[lo:hi]
                seq[seq == _TAIL] = cls[tail]
                n = np.bincount(tail, minlength=len(c))
                more = np.log10(c + 1.0)
                known.append(t["known"][j] + int(n[c > 0].sum()))
                base.append(t["base"][j] + float(n @ more))
                emit.append(t["emit"][j] + float(n @ np.where(cls == rare, more, np.log10(np.maximum(c, 1)))))
                seqs.append(seq.tobytes())
            arrays = [pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(emit, pa.float64()), pa.array(seqs, pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *arrays], ["_id", "_train", "n", "known", "base", "emit", "seq"])

    whole = raw.withColumn("n_words", F.size("words")).drop("words").join(found, "_row", "left")
    out = materialize(whole.select("_id", "_train", "n", "known", "base", "emit", "seq", "tail", "n_words", "found").mapInArrow(fill, sums), "coded")
    discard(raw)
    return out


def _transitions(coded: DataFrame, k: int) -> np.ndarray:
    """Counts of neighbouring classes of the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k * k, dtype=np.int64)
        for b in batches:
            for x in b.column(0):
                s = np.frombuffer(x.as_py(), np.uint16).astype(np.int64)
                np.add.at(total, s[:-1] * k + s[1:], 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["code", "n"])

    return _matrix(coded.where("_train").select("seq").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")), k)


def score(
    docs: DataFrame,
    train_where: str,
    head_words: int = 100_000,
    cluster_words: int = 1000,
    classes: int = 60,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Score every text by a class bigram model learnt from the rows where ``train_where`` holds.

    Returns ``id_col``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (add-one unigram)
    and ``score`` (the class model), both log10 probabilities of the whole text.  A null text counts
    as empty: one end token.  With no training rows every word is unseen.  Repeated rows are scored
    and counted each; other columns are read only if ``train_where`` names them.  ``head_words`` is the
    size of the cache that travels with a task; ``cluster_words`` and ``classes`` are the least (``sizes``).
    """
    bounded_batches(docs.sparkSession)
    train = docs.where(F.expr(train_where))
    n_docs = train.count()
    counts = materialize(word_counts(train, text_col), "words")
    tot = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.count_if(F.col("c") > 1).alias("again")).first()
    total = tot["n"] + n_docs  # the end of each text is a token
    distinct = tot["v"] + (1 if n_docs else 0)
    words, rare = word_classes(counts, train, tot["again"], cluster_words, classes, text_col)
    end, k = rare + 1, rare + 2
    head = {bytes(r["word"]): (r["c"], r["cls"]) for r in words.where("c > 1").orderBy(F.desc("c"), "word").limit(head_words).collect()}
    coded = _coded(docs, train_where, words, head, rare, end, id_col, text_col)
    trans = _transitions(coded, k)
    mass, types = np.zeros(k), np.zeros(k)  # tokens and words of each class
    for r in words.groupBy("cls").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        mass[r["cls"]], types[r["cls"]] = r["n"], r["v"]
    mass[end] = n_docs
    uni = (mass + 0.5) / (mass.sum() + 0.5 * k)
    row = trans.sum(1, keepdims=True)
    lam = row / (row + 5.0 * k)  # interpolation: the more a class was seen, the more its own row counts
    log_trans = np.log10(lam * trans / np.maximum(row, 1.0) + (1 - lam) * uni)
    #: log10 P(word | class) = log10(count) - norm; in the rare class log10(count + 1) - norm, an unseen word at count 0
    norm = np.log10(np.maximum(mass, 1))
    norm[rare] = math.log10(mass[rare] + types[rare] + 1)
    norm[end] = 0.0
    step = log_trans - norm[None, :]  # a transition and its word's norm
    end_log, base_norm, seen_end = math.log10(n_docs + 1), math.log10(total + distinct + 1), int(n_docs > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for x in b.column(1):
                s = np.frombuffer(x.as_py(), np.uint16)
                got.append(float(step[s[:-1], s[1:]].sum()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), b.column(4), pa.array(np.array(got) + b.column(5).to_numpy(), pa.float64())], ["_id", "n", "known", "base", "s"])

    out = coded.select("_id", "seq", "n", "known", "base", "emit").mapInArrow(run, "_id long, n long, known long, base double, s double")
    return out.select(
        F.col("_id").alias(id_col),
        F.col("n").alias("n_tokens"),
        (F.col("known") + seen_end).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + end_log - F.col("n") * base_norm).alias("base_score"),
        F.col("s").alias("score"),
    )
