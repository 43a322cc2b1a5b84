"""Quality by pairwise ranking: a Bradley-Terry model on preference pairs.

Every text becomes a short vector of surface features.  A pair sets a text of label 1 against one of
label 0; the model's score difference gives the probability that the first is preferred, and the
logistic loss on feature differences is minimised.  Pairs come from a bounded, documented sample of
labelled rows.  A quantile of the scores of all labelled rows - the one at the share of label 0 - is the
border, and scores are mapped so that the border lies at ``threshold``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import bounded_batches

#: At most this many labelled rows are sampled, the ones with the smallest hash of their id.
SAMPLE_ROWS = 20_000
#: Preference pairs drawn from the sample.
PAIRS = 60_000
#: Bins of the histogram of raw scores that the border is read from.
BINS = 20_000
#: Labelled rows up to this many are broadcast to the texts; more are joined by id, without the texts.
BROADCAST_LABELS = 1_000_000

_MARKS = "!*$&%#|@~^<>{}[]=+_\\/"
FEATURES = 25


def features(text: str | None) -> np.ndarray:
    """Surface features of a whole text; an empty text has all zeros but the last."""
    out = np.zeros(FEATURES)
    text = text or ""
    words = text.split()
    n, w = len(text), len(words)
    if not w:
        out[-1] = 1.0
        return out
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    low = np.bincount(np.minimum(codes, 127), minlength=128)
    upper = int(low[65:91].sum())
    freq = Counter(words)
    top = max(freq.values())
    runs = sum(1 for a, b in zip(words, words[1:], strict=False) if a == b)
    lines = [x for x in text.split("\n") if x.strip()]
    tail = Counter(x[-1] for x in words)
    odd_tail = sum(c for ch, c in tail.items() if not ch.isalnum() and ch not in ".,")
    lens = np.fromiter(map(len, words), np.int64, w)
    out[0] = np.log1p(w)
    out[1] = upper / n
    out[2] = low[97:123].sum() / n
    out[3] = low[48:58].sum() / n
    out[4] = sum(int(low[ord(c)]) for c in _MARKS) / n
    out[5] = low[127] / n
    out[6] = len(freq) / w
    out[7] = top / w
    out[8] = runs / w
    out[9] = odd_tail / w
    out[10] = lens.mean() / 10
    out[11] = lens.std() / 10
    out[12] = low[ord("|")] / w
    out[13] = low[ord("!")] / w
    out[14] = sum(x.isupper() and len(x) > 1 for x in words) / w
    out[15] = sum(x.isalpha() for x in words) / w
    out[16] = len(lines) / w
    out[17] = 1 - len(set(lines)) / max(len(lines), 1)
    out[18] = low[46] / w
    out[19] = low[44] / w
    out[20] = np.sqrt(out[4])
    out[21] = np.sqrt(out[9])
    out[22] = np.sqrt(out[8])
    out[23] = np.sqrt(out[12] + out[13])
    return out


class BradleyTerry:
    """Weights on standardised features, and the map from raw scores to (0, 1)."""

    def __init__(self, threshold: float = 0.7, l2: float = 1e-3, seed: int = 7):
        self.threshold, self.l2, self.seed = threshold, l2, seed
        self.mean = np.zeros(FEATURES)
        self.scale = np.ones(FEATURES)
        self.w = np.zeros(FEATURES)
        self.border, self.slope = 0.0, 1.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> BradleyTerry:
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        if not len(good) or not len(bad):
            self.border = -1e9 if len(good) else (1e9 if len(bad) else 0.0)
            return self
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        rng = np.random.default_rng(self.seed)
        m = min(PAIRS, len(good) * len(bad))
        d = z[rng.choice(good, m)] - z[rng.choice(bad, m)]
        w = np.zeros(FEATURES)
        for _ in range(30):  # Newton steps on the convex loss
            p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
            grad = -(d.T @ (1 - p)) / m + self.l2 * w
            hess = (d * (p * (1 - p))[:, None]).T @ d / m + self.l2 * np.eye(FEATURES)
            step = np.linalg.solve(hess, grad)
            w -= step / max(1.0, np.abs(step).max())
            if np.abs(step).max() < 1e-6:
                break
        self.w = w
        s = np.sort(z @ w)
        k = len(bad)  # the quantile at the share of label 0
        self.border = float((s[k - 1] + s[k]) / 2)
        self.slope = 1.0 / max(float(np.percentile(s, 75) - np.percentile(s, 25)), 1e-6)
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.w

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Bin of each raw score: they lie within eight times the sum of the weights' sizes."""
        reach = 8.0 * np.abs(self.w).sum() + 1e-9
        return np.clip((self.raw(x) + reach) * (BINS / (2 * reach)), 0, BINS - 1).astype(np.int32)

    def set_border(self, rows: dict[int, tuple[int, int]]) -> None:
        """Put the border at the quantile of the share of label 0, from bin -> (rows, rows of label 0)."""
        reach, bad, seen = 8.0 * np.abs(self.w).sum() + 1e-9, sum(b for _, b in rows.values()), 0
        if not 0 < bad < sum(n for n, _ in rows.values()):
            return
        order = sorted(rows)
        for i, k in enumerate(order):
            seen += rows[k][0]
            if seen >= bad:
                above = order[i + 1] if i + 1 < len(order) else k + 1
                self.border = float((k + 1 + above) / 2 * (2 * reach / BINS) - reach)  # between this bin and the next that holds a row
                return

    def score(self, x: np.ndarray) -> np.ndarray:
        t = np.clip((self.raw(x) - self.border) * self.slope * 2, -30, 30) + np.log(self.threshold / (1 - self.threshold))
        return 1 / (1 + np.exp(-t))


def train(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> BradleyTerry:
    """Fit on at most ``sample_rows`` labelled rows; rows without a 0/1 label or an id take no part.

    The border comes from all labelled rows.
    """
    bounded_batches(docs.sparkSession)
    lab = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_y")).distinct()
    picked = lab.orderBy(F.xxhash64("_id"), "_y").limit(sample_rows)  # a bounded top-k, not a full sort
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text")).join(F.broadcast(picked), "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t.as_py()).tolist() for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(x, pa.list_(pa.float64()))], ["_id", "_y", "x"])

    got = src.select("_text", "_id", "_y").mapInArrow(run, "_id long, _y int, x array<double>").orderBy("_id", "_y").collect()
    m = BradleyTerry(threshold)
    if got:
        m.fit(np.array([r["x"] for r in got]), np.array([r["_y"] for r in got]))
        m.set_border({r["bin"]: (r["n"], r["bad"]) for r in _histogram(docs, lab, m, id_col, text_col).collect()})  # a row a bin at most
    return m


def _histogram(docs: DataFrame, lab: DataFrame, model: BradleyTerry, id_col: str, text_col: str) -> DataFrame:
    """``bin``, ``n``, ``bad``: all labelled rows by bin of their raw score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t.as_py()) for t in b.column(0)]).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(model.bins(x))], ["_id", "bin"])

    src = docs.select(F.col(text_col).cast("string").alias("_text"), F.col(id_col).cast("long").alias("_id"))
    if lab.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        src = src.join(F.broadcast(lab.select("_id").distinct()), "_id", "left_semi").select("_text", "_id")
    scored = src.mapInArrow(run, "_id long, bin int").join(lab, "_id")
    return scored.groupBy("bin").agg(F.count("*").alias("n"), F.count_if(F.col("_y") == 0).alias("bad"))


def score(docs: DataFrame, model: BradleyTerry, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with a column ``out_col`` in (0, 1).

    A null text counts as empty; empty and very long texts get a score like any other.  All columns
    and repeated rows stay; a column already named ``out_col`` is replaced.  An empty table stays
    empty.
    """

    bounded_batches(docs.sparkSession)
    @F.pandas_udf("double")
    def f(texts):  # noqa: ANN001, ANN202 - a pandas Series to a pandas Series
        import pandas as pd

        return pd.Series(model.score(np.array([features(t) for t in texts]).reshape(-1, FEATURES)))

    return docs.withColumn(out_col, f(F.col(text_col).cast("string")))
