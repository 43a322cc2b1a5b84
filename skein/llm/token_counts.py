"""Token counts of a unigram tokenizer without building token lists.

An Aho-Corasick automaton over the vocabulary enumerates every piece that ends at a position; a
dynamic programme over positions carries only the best score and the number of pieces on the best
path.  Tie rules are those of the ``tokenizers`` library's unigram model: scores are compared as
doubles, a path replaces another only if it is strictly better, and candidates arrive in the order of
their start, so among equals the longest piece wins; a character that no single-character piece covers
may be an unknown piece at the lowest score less ten; neighbouring unknown pieces fuse into one.

Vocabulary: a SentencePiece file's pieces and stored scores.  A text is a word mark, then the text
with every space replaced by the mark.  When no piece has a mark after another character, best paths
never cross the border before a mark, so the programme runs once per distinct word and a worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import bounded_batches

#: The word mark, and what an unknown character costs below the lowest score.
MARK, UNKNOWN_PENALTY = "▁", 10.0
CACHE_WORDS = 400_000


def read_pieces(model_path: str) -> tuple[list[tuple[str, float]], int]:
    """(piece, score) in id order, and the unknown id.  Byte and control pieces match no text: they are ''."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    mute = lambda i: sp.is_byte(i) or sp.is_control(i) or sp.is_unused(i)
    return [("" if mute(i) else sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())], sp.unk_id()


class CountOnlyViterbi:
    """Best path's piece count for strings over one vocabulary."""

    def __init__(self, pieces: list[tuple[str, float]], unk_id: int):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        scores = [s for _, s in pieces]
        for i, (p, s) in enumerate(pieces):
            if p and i != unk_id:
                self.automaton.add_word(p, (len(p), s))
        self.has_any = any(p and i != unk_id for i, (p, _) in enumerate(pieces))
        if self.has_any:
            self.automaton.make_automaton()
        self.unk = min(scores) - UNKNOWN_PENALTY
        self.local = not any(MARK in p.lstrip(MARK) for i, (p, _) in enumerate(pieces) if i != unk_id)
        self.cache: dict[str, tuple[int, bool, bool]] = {}
        self.split = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")

    def path(self, s: str) -> tuple[int, bool, bool]:
        """(pieces, begins with an unknown piece, ends with one) of a non-empty string."""
        n = len(s)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]  # start -> pieces
        if self.has_any:
            for last, (size, score) in self.automaton.iter(s):
                ends[last - size + 1].append((size, score))
        none = float("-inf")
        best, count = [none] * (n + 1), [0] * (n + 1)
        open_unk, first_unk = [False] * (n + 1), [False] * (n + 1)  # path ends / begins with unknown
        best[0] = 0.0
        for i in range(n):
            b = best[i]  # every position is reachable: a single character or an unknown covers it
            single = False
            for size, score in ends[i]:  # ascending sizes: the automaton reports by end
                single = single or size == 1
                if b + score > best[i + size]:
                    j = i + size
                    best[j], count[j], open_unk[j] = b + score, count[i] + 1, False
                    first_unk[j] = first_unk[i]
            if not single and b + self.unk > best[i + 1]:
                best[i + 1], open_unk[i + 1] = b + self.unk, True
                count[i + 1] = count[i] + (0 if open_unk[i] else 1)
                first_unk[i + 1] = True if i == 0 else first_unk[i]
        return count[n], first_unk[n], open_unk[n]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        s = MARK + text.replace(" ", MARK)
        if not self.local:
            return self.path(s)[0]
        cache, total, open_unk = self.cache, 0, False
        if len(cache) > CACHE_WORDS:
            cache.clear()
        for w in self.split.findall(s):
            hit = cache.get(w)
            if hit is None:
                hit = self.path(w)
                if len(w) < 200:
                    cache[w] = hit
            total += hit[0] - (open_unk and hit[1])
            open_unk = hit[2]
        return total


_MODELS: dict[str, CountOnlyViterbi] = {}


def counter(path: str) -> CountOnlyViterbi:
    if path not in _MODELS:
        _MODELS[path] = CountOnlyViterbi(*read_pieces(path))
    return _MODELS[path]


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``n_tokens`` of every whole text.

    A null or empty text has no tokens.  Rows are independent, so repeated rows stay and an empty
    table gives an empty result; other columns are not read, whatever their names.
    """
    bounded_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = counter(model_path)
        for b in batches:
            n = [m.count(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["_id", "n_tokens"])

    return src.mapInArrow(run, "_id long, n_tokens long").withColumnRenamed("_id", id_col)
