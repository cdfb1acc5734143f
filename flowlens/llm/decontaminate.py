"""Benchmark decontamination: n-gram seeds, then local alignment.

Words are lower-cased and freed of punctuation at their ends.  A passage is
scored by Smith-Waterman (match 1, mismatch -1, gap -0.5, word by word) over the
item's number of words; from ``min_score`` on the document is contaminated.

Seeds are the item's word pairs, next to each other or with words between them
(up to ``n`` words in all), and so are the document's, so one word inserted, left
out or replaced between two words does not hide them.  How many such pairs a
passage has is what makes it rare: an alignment of score s times the item's
length L has M matches and at most 2 (M - s L) other columns, so at least
s L - 1 of its neighbouring matches have at most one column between them, all of
them within (3 - 2 s) L words of the document.  Only stretches with that many
pairs of an item (each as often as the item has it) are aligned, and of these only those where ``most``, an upper
bound by known words, allows the score; so every passage of an item of
``SHORT`` words or more that scores ``min_score`` is found, however it is edited.
Shorter items need all pairs of neighbouring words (one word: that word).

The test items are the small side.  They are taken in slices of at most about
``slice_words`` words, one after another: the driver and a task hold one slice,
and each further slice is a pass over the documents as staged by the last.

Cases: null or empty texts and items match nothing; repeated rows are judged alike; equal items are
all reported; null item_ids are ignored; empty tables leave documents clean;
result columns get underscores in front where their names are taken.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import encoded, free_name, staged, table, texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

N = 3
SHORT = 8
GAP = 0.5
_MEMO_WORDS = 500_000
_HITS = 1_000_000


def bare(word: bytes) -> str:
    """A word in lower case without non-alphanumerics at its ends."""
    s = word.decode("utf-8", "surrogatepass").lower()
    if s.isalnum():
        return s
    a, b = 0, len(s)
    while a < b and not s[a].isalnum():
        a += 1
    while b > a and not s[b - 1].isalnum():
        b -= 1
    return s[a:b]


def bare_words(text: str | None) -> list[str]:
    return [w for w in map(bare, encoded(text).split()) if w]


def align(item: np.ndarray, passage: np.ndarray) -> float:
    """Smith-Waterman score, a row of the matrix at a time; gaps along the
    row by a running maximum."""
    slope = np.arange(len(passage) + 1) * GAP
    row, best = np.zeros(len(passage) + 1), 0.0
    for word in item:
        step = np.zeros(len(passage) + 1)
        step[1:] = row[:-1] + np.where(passage == word, 1.0, -1.0)
        step = np.maximum(np.maximum(step, row - GAP), 0.0)
        row = np.maximum.accumulate(step + slope) - slope
        best = max(best, float(row.max()))
    return best


def most(known: np.ndarray) -> float:
    """No alignment of a passage scores more: a word that is in the item
    (``known``) adds 1 at most, any other costs a gap at least."""
    total = np.concatenate([[0.0], np.cumsum(np.where(known, 1.0, -GAP))])
    return float((total - np.minimum.accumulate(total)).max())


class _Ids(dict):
    """Raw word -> id of its bare form in the items; -1 elsewhere, -2 for
    words without letters or digits."""

    def __init__(self, vocab: dict[str, int]):
        super().__init__()
        self.vocab = vocab

    def __missing__(self, word: bytes) -> int:
        if len(self) > _MEMO_WORDS:
            self.clear()
        s = bare(word)
        self[word] = i = self.vocab.get(s, -1) if s else -2
        return i


class Items:
    """A slice of the benchmark: words, codes of word pairs, and whose they are."""

    def __init__(self, rows: list[tuple[int, str | None]], n: int):
        self.n = n
        split = [(i, bare_words(t)) for i, t in rows if i is not None]
        split = [(i, w) for i, w in split if w]
        vocab: dict[str, int] = {}
        self.ids = [i for i, _ in split]
        self.words = [np.array([vocab.setdefault(w, len(vocab)) for w in ws], dtype=np.int64) for _, ws in split]
        self.base = len(vocab) + 1
        self.vocab = vocab
        self.table = _Ids(vocab)
        self.length = np.array([len(w) for w in self.words], dtype=np.int64)
        grams, times = zip(*[np.unique(self.pairs(w)[0] if len(w) > 1 else w + 1, return_counts=True) for w in self.words]) if self.words else ((), ())
        # one row for each item and seed of it, by seed
        code = np.concatenate([np.zeros(0, dtype=np.int64), *grams])
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        order = np.lexsort((owner, code))
        self.owner, self.times = owner[order], np.concatenate([np.zeros(0, dtype=np.int64), *times])[order]
        self.seeds, first = np.unique(code[order], return_index=True)
        self.first = np.append(first, len(code))

    def pairs(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, places) of pairs of known words within ``n`` words.  A
        word's own code, for items of one word, is smaller than any of them."""
        codes, places = [], []
        for step in range(1, self.n):
            a, b = ids[:-step], ids[step:]
            at = np.flatnonzero((a >= 0) & (b >= 0))
            codes.append((a[at] + 1) * self.base + b[at] + 1)
            places.append(at)
        return np.concatenate(codes), np.concatenate(places)

    def read(self, text: str | None) -> np.ndarray:
        ids = self.table
        own = np.array([ids[w] for w in encoded(text).split()], dtype=np.int64)
        return own[own > -2]

    def hits(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and numbers of the seeds in a document."""
        code, place = self.pairs(own)
        if (self.length == 1).any():
            at = np.flatnonzero(own >= 0)
            code, place = np.concatenate([code, own[at] + 1]), np.concatenate([place, at])
        found = np.minimum(np.searchsorted(self.seeds, code), len(self.seeds) - 1)
        real = self.seeds[found] == code
        return place[real], found[real]

    def passages(self, own: np.ndarray, min_seeds: int, min_score: float):
        """(item, start, stop) of stretches with enough pairs of an item.  Hits
        of very many items are taken some items at a time."""
        places, seeds = self.hits(own)
        need = np.where(self.length < SHORT, np.maximum(self.length - 1, 1), np.maximum(np.ceil(min_score * self.length).astype(np.int64) - 1, min_seeds))
        reach = np.ceil((3 - 2 * min(min_score, 1.0)) * self.length).astype(np.int64) + self.n
        wide = len(own) + int(reach.max(initial=0)) + 1
        many = self.first[seeds + 1] - self.first[seeds]
        parts = -(-int(many.sum()) // _HITS)
        for part in range(parts):
            rows, hit = self._expand(places, seeds, many, part, parts)
            key = self.owner[rows] * wide + places[hit]
            order = np.argsort(key, kind="stable")
            key, rows = key[order], rows[order]
            at = key[np.flatnonzero(np.diff(key, prepend=-1))]
            k = at // wide
            enough = np.searchsorted(at, at + reach[k], side="right") - np.arange(len(at)) >= need[k]
            at, k = at[enough], k[enough]
            if not len(at):
                continue
            p = at - k * wide
            begin = np.ones(len(at), dtype=bool)
            begin[1:] = (k[1:] != k[:-1]) | (p[1:] - p[:-1] > 2 * reach[k[1:]])
            first = np.flatnonzero(begin)
            last = np.append(first[1:], len(at)) - 1
            item = k[first]
            # A pair counts as often as the item has it: words said over and
            # over are no passage.
            low, high = np.searchsorted(key, at[first]), np.searchsorted(key, at[last] + reach[item], side="right")
            start, stop = np.maximum(p[first] - reach[item], 0), p[last] + reach[item]
            for i, a, b, x, y in zip(item.tolist(), low.tolist(), high.tolist(), start.tolist(), stop.tolist()):
                own_rows, often = np.unique(rows[a:b], return_counts=True)
                if np.minimum(often, self.times[own_rows]).sum() >= need[i]:
                    yield i, x, y

    def _expand(self, places, seeds, many, part: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Owner rows and hits of the items of a part."""
        rows, hits = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        ends = np.cumsum(many)
        a = 0
        while a < len(seeds):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + _HITS, "right")))
            n = many[a:b]
            row = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[seeds[a:b]], n)
            hit = np.repeat(np.arange(a, b), n)
            if parts > 1:
                own = self.owner[row] % parts == part
                row, hit = row[own], hit[own]
            rows.append(row)
            hits.append(hit)
            a = b
        return np.concatenate(rows), np.concatenate(hits)

    def matches(self, own: np.ndarray, min_seeds: int, min_score: float) -> list[tuple[int, float]]:
        """(item_id, score) of the items found in a document."""
        best: dict[int, float] = {}
        mark = np.zeros(len(self.vocab) + 1, dtype=bool) if len(own) else None  # the last: in no item
        for k, start, stop in self.passages(own, min_seeds, min_score):
            words, passage = self.words[k], own[start:stop]
            mark[words] = True
            bound = most(mark[passage])
            mark[words] = False
            if bound >= min_score * len(words):
                best[k] = max(best.get(k, 0.0), align(words, passage) / len(words))
        return [(self.ids[k], score) for k, score in best.items() if score >= min_score]


def _slices(benchmark: DataFrame, text: str, item_id: str, n: int, slice_words: int) -> Iterator[Items]:
    """The benchmark's slices, each collected when it is asked for."""
    rows = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).dropna()
    words = rows.agg(F.sum(F.size(F.split("t", r"\s+")))).first()[0] or 0
    parts = -(-int(words) // slice_words)
    for k in range(parts):
        own = rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == k).collect()  # about slice_words words
        items = Items(sorted((r.i, r.t) for r in own), n)
        if items.ids:
            yield items


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_text: str = "text",
    item_id: str = "item_id",
    n: int = N,
    min_seeds: int = 2,
    min_score: float = 0.5,
    slice_words: int = 500_000,
) -> DataFrame:
    """``docs`` with items (item_ids found), score (the best) and
    contaminated."""
    found, score, bad = (free_name(docs.columns, c) for c in ("items", "score", "contaminated"))
    at = docs.columns.index(text)
    out = docs.withColumn(found, F.array().cast("array<long>")).withColumn(score, F.lit(0.0))
    for i, items in enumerate(_slices(benchmark, item_text, item_id, n, slice_words)):
        if i:  # a task runs one slice's worker
            out = staged(out, "decontaminated")

        def run(batches, items=items):
            for batch in batches:
                lists, scores = [], []
                for t, had, top in zip(texts(batch.column(at)), batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                    new = items.matches(items.read(t), min_seeds, min_score)
                    lists.append(sorted([*had, *(i for i, _ in new)]))
                    scores.append(max([top, *(s for _, s in new)]))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-2], pa.array(lists, pa.list_(pa.int64())), pa.array(scores, pa.float64())], batch.schema.names
                )

        out = out.mapInArrow(run, out.schema)
    return out.withColumn(bad, F.size(F.col(found)) > 0)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents, with the test items found in them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.filter("contaminated").select("doc_id", "items", "score")
