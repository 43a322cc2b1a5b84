"""BPE encoding and decoding by a pair occurrence index.

The distinct words of a partition are laid out as one linked list of symbols.  An index maps every
pair that has a merge rank to all positions where it occurs in that list.  Active ranks are applied
in ascending order from a heap: one rank is applied at all its positions at once, and only the lists
of the neighbouring pairs are updated.  A word is encoded once per Python worker however often it
occurs, so the work per document is a split and one dictionary lookup a word.

Splitting a text into words follows the tokenizer file.  Texts whose characters all lie in a range
where Python's and the tokenizer's Unicode tables agree take a compiled pattern; all other texts take
the tokenizer's own normalizer and splitter.  Merging is always done here.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import bounded_batches

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Words that a worker remembers; the cache is emptied when it is full.
CACHE_WORDS = 400_000

#: Printable ASCII, the usual white space, and precomposed Latin letters up to U+017F.
_PLAIN = re.compile(r"[\x20-\x7e\t\n\r¡-¬®-įı-ſ]*")


class PairIndexBPE:
    """The merges of a ``tokenizers`` BPE file, applied to batches of words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.merges[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        self.text_of = {i: s for s, i in self.vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text_of |= {i: s for s, i in self.added.items()}
        self.tokenizer = Tokenizer.from_file(path)
        self.byte_chars = _byte_chars()

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word; a word is a string in the tokenizer's byte alphabet."""
        sym: list[int] = []
        word: list[int] = []
        starts: list[int] = []
        vocab, suffix, merges = self.vocab, self.suffix, self.merges
        for w, s in enumerate(words):
            starts.append(len(sym))
            last = len(s) - 1
            for i, ch in enumerate(s):
                k = vocab.get(ch + suffix if i == last else ch)
                if k is not None:  # no unknown token in these files: such a symbol is left out
                    sym.append(k)
                    word.append(w)
        n = len(sym)
        starts.append(n)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        for s in starts[:-1]:
            if s < n:
                before[s] = -1
            if 0 < s <= n:
                after[s - 1] = n
        if n:
            after[n - 1] = n
        index: dict[tuple[int, int], list[int]] = {}
        for p in range(n - 1):
            if after[p] != n:
                pair = (sym[p], sym[p + 1])
                if pair in merges:
                    index.setdefault(pair, []).append(p)
        active = [(merges[p][0], p) for p in index]
        heapq.heapify(active)
        while active:
            rank, pair = heapq.heappop(active)
            places = index.pop(pair, None)
            if not places:
                continue
            places.sort()
            a, b = pair
            made = merges[pair][1]
            held: set[int] = set()  # words in which a lower rank has just become active
            later: list[int] = []
            for p in places:
                q = after[p] if sym[p] == a else n
                if q == n or sym[q] != b:
                    continue  # an earlier merge took one of its symbols
                if held and word[p] in held:
                    later.append(p)
                    continue
                r = after[q]
                sym[p], sym[q], after[p] = made, -1, r
                if r != n:
                    before[r] = p
                    new = (made, sym[r])
                    hit = merges.get(new)
                    if hit:
                        _list(index, active, new, hit[0]).append(p)
                        if hit[0] < rank:
                            held.add(word[p])
                o = before[p]
                if o != -1:
                    new = (sym[o], made)
                    hit = merges.get(new)
                    if hit:
                        _list(index, active, new, hit[0]).append(o)
                        if hit[0] < rank:
                            held.add(word[p])
            if later:
                _list(index, active, pair, rank).extend(later)
        out: list[list[int]] = [[] for _ in words]
        for p in range(n):
            if sym[p] >= 0:
                out[word[p]].append(sym[p])
        return out


def _list(index: dict, active: list, pair: tuple[int, int], rank: int) -> list[int]:
    found = index.get(pair)
    if found is None:
        found = index[pair] = []
        heapq.heappush(active, (rank, pair))
    return found


def _byte_chars() -> dict[int, str]:
    """Byte-level alphabet as a table for ``str.translate`` over latin-1 text.

    Rule: printable bytes stand for themselves, the rest take the code points from 256 on, in order.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return {b: chr(b) if b in set(shown) else chr(next(rest)) for b in range(256)}


class WordCodec:
    """Documents to ids and back, with a cache of words that lives as long as the worker."""

    def __init__(self, path: str):
        import regex

        self.bpe = PairIndexBPE(path)
        # The split pattern of this tokenizer file.
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
        added = sorted(self.bpe.added, key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self.plain: dict[str, tuple[int, str, str]] = {}  # a plain word -> count, ids, decoded
        self.mapped: dict[str, tuple[int, str, str]] = {}  # the same for words in the byte alphabet
        self.special = {s: (1, str(i), s) for s, i in self.bpe.added.items()}

    def parts(self, text: str) -> list[tuple[str, str]]:
        """(kind, piece) with kind 'added' or 'text'."""
        if self.added is None or "<|" not in text:
            return [("text", text)]
        cut = self.added.split(text)
        return [("added" if i % 2 else "text", x) for i, x in enumerate(cut) if x]

    def words(self, piece: str) -> tuple[dict, list[str]]:
        """The cache to look in, and the words of a piece of ordinary text."""
        if _PLAIN.fullmatch(piece):
            return self.plain, self.pattern.findall(piece.lower())
        t = self.bpe.tokenizer
        normal = t.normalizer.normalize_str(piece) if t.normalizer else piece
        return self.mapped, [w for w, _ in t.pre_tokenizer.pre_tokenize_str(normal)]

    def learn(self, cache: dict, words: set[str]) -> None:
        new = sorted(words)
        if cache is self.plain:
            mapped = [w.encode().decode("latin-1").translate(self.bpe.byte_chars) for w in new]
        else:
            mapped = new
        for w, ids in zip(new, self.bpe.encode_words(mapped), strict=True):
            cache[w] = (len(ids), " ".join(map(str, ids)), self.decode(ids))

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by one space: these files name no decoder; unknown ids are left out."""
        return " ".join(self.bpe.text_of[i] for i in ids if i in self.bpe.text_of)

    def encode_batch(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """(number of ids, ids joined by one space, decoded text) of each text; None counts as ''."""
        docs, missing = [], {id(self.plain): set(), id(self.mapped): set()}
        for cache in (self.plain, self.mapped):
            if len(cache) > CACHE_WORDS:
                cache.clear()
        for text in texts:
            segs = []
            for kind, piece in self.parts(text or ""):
                if kind == "added":
                    segs.append((self.special, [piece]))
                    continue
                cache, words = self.words(piece)
                missing[id(cache)].update(w for w in words if w not in cache)
                segs.append((cache, words))
            docs.append(segs)
        for cache in (self.plain, self.mapped):
            if missing[id(cache)]:
                self.learn(cache, missing[id(cache)])
        out = []
        for segs in docs:
            hits = [cache[w] for cache, words in segs for w in words]
            hits = [h for h in hits if h[0]]
            out.append((sum(h[0] for h in hits), " ".join(h[1] for h in hits), " ".join(h[2] for h in hits)))
        return out


_CODECS: dict[str, WordCodec] = {}


def codec(path: str) -> WordCodec:
    """One codec per worker process and file."""
    if path not in _CODECS:
        _CODECS[path] = WordCodec(path)
    return _CODECS[path]


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns ``id_col``, ``n_tokens``, ``decoded`` and, if asked, ``ids`` (decimal, one space between).
    A null text counts as empty and gives no ids.  Rows are independent: repeated rows and ids stay,
    an empty table gives an empty result, other columns are not read, whatever their names.
    """
    return _mapped(docs, tokenizer_path, id_col, text_col, digest=False).select(id_col, "n_tokens", "decoded", *(["ids"] if with_ids else []))


def encode_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode_decode``, with SHA-256 digests in place of ids and decoded text."""
    return _mapped(docs, tokenizer_path, id_col, text_col, digest=True)


def _mapped(docs: DataFrame, path: str, id_col: str, text_col: str, digest: bool) -> DataFrame:
    bounded_batches(docs.sparkSession)
    names = ["n_tokens", "ids_sha256", "decoded_sha256"] if digest else ["n_tokens", "ids", "decoded"]
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            for k in range(0, b.num_rows, 500):
                part = b.slice(k, 500)
                got = c.encode_batch(part.column(1).to_pylist())
                x, y = [g[1] for g in got], [g[2] for g in got]
                if digest:
                    x = [hashlib.sha256(s.encode()).hexdigest() for s in x]
                    y = [hashlib.sha256(s.encode()).hexdigest() for s in y]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([g[0] for g in got], pa.int64()), pa.array(x, pa.string()), pa.array(y, pa.string())], ["_id", *names])

    out = src.mapInArrow(run, f"_id long, {names[0]} long, {names[1]} string, {names[2]} string")
    return out.withColumnRenamed("_id", id_col)
