"""Spelling variants: words one edit apart, found over a reduced alphabet.

Letters are hashed to a few symbols (a code point's remainder), so a word
becomes a short string over a small alphabet and its full one-edit
neighbourhood (every deletion, replacement and insertion, and the string
itself) has only a few dozen members.  Two words one edit apart have reduced
strings at most one edit apart, so each word's neighbourhood is joined with the
reduced vocabulary and the pairs that meet are verified on the original words.

Reduced strings are compared by a rolling 64-bit hash: every neighbour's hash
follows from the word's own in one step, so a word of 50,000 letters makes
numbers, not strings.  A key also holds one half of the original word: an edit
leaves the half on its other side alone, so a neighbour edited in the second
half is looked up with the exact first half, and the other way round (each word
of the vocabulary is listed under both).  That keeps words apart which only
share their reduced form, whatever the size of the vocabulary.  A bit map of
fixed size (``BITS``) over the vocabulary's keys drops most neighbours that are
no word's before they are shuffled; where it is full it just drops fewer.
Hash collisions only add candidates: nothing is lost, verification is exact.

``form``: the near word of largest n (ties: first in code-point order) with
n >= ``ratio`` times the word's; ``root``: where the forms lead, by pointer
doubling (n grows by ``ratio`` with each step, so chains are short).

Cases: null words, and words without a row of their own, do not exist; equal
words are added up; words of any length and script take part (a task holds about 200
bytes for each letter of a word); an empty table gives an empty one.  ``word_counts``: null and empty texts have no words, a null
doc_id reads as empty text, repeated rows count as often as they occur.
"""

from __future__ import annotations

import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import staged_with_count
from .common import staged, table, texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SYMBOLS = 8
BITS = 27
_HELD_WORDS = 200_000
_CHUNK = 1 << 20
#: Odd multipliers of the hashes.
_B, _C = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_K = (0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xA0761D6478BD642F)

#: One byte a letter: A-Z lower-cased, a-z and U+00C0 to U+00FF as they are,
#: everything else a space.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs(text: str):
    """Lists of the text's runs of letters as Latin-1 bytes, A-Z lower-cased."""
    raw = text.encode("latin-1", "replace").translate(LETTERS)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + _CHUNK) if at + _CHUNK < len(raw) else -1
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def word_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", change=None) -> DataFrame:
    """(word, n): the runs of letters of all texts, added up within a task and
    then over all.  ``change(doc_id as bytes)`` may give a function from a run
    to the word it stands for in that document (both Latin-1)."""

    def count(batches):
        held: Counter = Counter()

        def out():
            words = [w.decode("latin-1") for w in held]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            ids = batch.column(0)
            for i, t in enumerate(texts(batch.column(1))):
                if not t:
                    continue
                to = change((ids[i].as_py() or "").encode()) if change else None
                for words in runs(t):
                    if to is None:
                        held.update(words)
                    else:
                        for w, n in Counter(words).items():
                            held[to(w)] += n
                    if len(held) > _HELD_WORDS:
                        yield out()
                        held.clear()
        if held:
            yield out()

    rows = docs.select(F.col(f"`{doc_id}`").cast("string"), F.col(f"`{text}`")).mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


class Letters:
    """The letters of a batch of words, one after another, with the hashes of
    all their prefixes and suffixes."""

    def __init__(self, words: list[str]):
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]]).astype(np.int64) if words else np.zeros(0, np.int64)
        x = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        self.word = np.repeat(np.arange(len(words)), self.length)  # of each letter
        self.j = np.arange(len(x)) - self.start[self.word]
        top = int(self.length.max(initial=0)) + 2
        self.powers = [np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(top, m, np.uint64))]) for m in (_B, _C)]
        self.symbol = x % np.uint64(SYMBOLS) + np.uint64(1)
        back = self.length[self.word] - 1 - self.j
        self.sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(v, dtype=np.uint64)]) for v in (self.symbol * self.powers[0][self.j], x * self.powers[1][self.j], x * self.powers[1][back])]

    def head(self, which: int, n: np.ndarray, word: np.ndarray | None = None) -> np.ndarray:
        """Hash of the first ``n`` letters of each word."""
        start = self.start if word is None else self.start[word]
        return self.sums[which][start + n] - self.sums[which][start]

    def halves(self, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of partners of that length: hashes of what precedes their middle and
        of what follows, in this word's letters."""
        h = length // 2
        tail = self.head(2, self.length) - self.head(2, self.length - (length - h))
        return self.head(1, h), tail


def _key(reduced, half, length, side) -> np.ndarray:
    z = reduced * np.uint64(_K[0]) + half * np.uint64(_K[1]) + (length.astype(np.uint64) * np.uint64(2) + side.astype(np.uint64)) * np.uint64(_K[2])
    z ^= z >> np.uint64(31)
    z *= np.uint64(_K[3])
    return z ^ (z >> np.uint64(29))


def own_keys(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(key, word's index): a word's reduced string with either half."""
    at = Letters(words)
    reduced = at.head(0, at.length)
    head, tail = at.halves(at.length)
    zero = np.zeros(len(words), np.int64)
    return np.concatenate([_key(reduced, head, at.length, zero), _key(reduced, tail, at.length, zero + 1)]), np.tile(np.arange(len(words)), 2)


def neighbour_keys(words: list[str]):
    """(keys, words' indices) of the full one-edit neighbourhoods, in parts."""
    at = Letters(words)
    whole = at.head(0, at.length)
    power = at.powers[0]
    yield own_keys(words)  # itself: a letter replaced by one with its symbol

    def keyed(reduced, word, place, length):
        head, tail = at.halves(length)
        late = place >= (length // 2)[word]
        return _key(reduced, np.where(late, head[word], tail[word]), length[word], ~late), word

    w, j = at.word, at.j
    total, own = whole[w], at.symbol * power[j]
    before = at.head(0, j, w)
    rest = (total - before - own) * np.uint64(pow(_B, -1, 1 << 64))
    yield keyed(before + rest, w, j, np.maximum(at.length - 1, 0))
    for step in range(1, SYMBOLS):
        other = (at.symbol - np.uint64(1) + np.uint64(step)) % np.uint64(SYMBOLS) + np.uint64(1)
        yield keyed(total + (other - at.symbol) * power[j], w, j, at.length)
    w = np.repeat(np.arange(len(words)), at.length + 1)
    j = np.arange(len(w)) - (at.start + np.arange(len(words)))[w]
    before = at.head(0, j, w)
    moved = before + (whole[w] - before) * np.uint64(_B)
    for symbol in range(1, SYMBOLS + 1):
        yield keyed(moved + np.uint64(symbol) * power[j], w, j, at.length + 1)


def one_edit(a: str, b: str) -> bool:
    """Whether one letter inserted, deleted or replaced makes ``a`` of ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return a[i + (len(a) == len(b)) :] == b[i + 1 :]
    return len(a) < len(b)


def _bit_map(keys: DataFrame) -> np.ndarray:
    """2**BITS bits, those of the keys set: at most 2**(BITS - 6) rows are
    collected, whatever the vocabulary."""
    cell = F.floor(F.pmod(F.col("key"), F.lit(1 << BITS)) / 64).alias("cell")
    cells = keys.groupBy(cell).agg(F.expr("bit_or(shiftleft(1L, cast(pmod(key, 64) AS int)))").alias("bits"))
    found = cells.toArrow()
    out = np.zeros(1 << (BITS - 6), np.int64)
    out[found.column("cell").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint64)


def _pieces(words: list[str], letters: int = 200_000):
    """Cuts of a batch with about that many letters each."""
    a, n = 0, 0
    for i, w in enumerate(words):
        if n and n + len(w) > letters:
            yield a, i
            a, n = i, 0
        n += len(w)
    if a < len(words):
        yield a, len(words)


def _merged(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """A merge join at every size.  Both sides grow with the vocabulary, and
    Spark sizes them by compressed files or shuffles (a word's neighbourhood by
    the word alone), so what it would broadcast can be more than a driver holds."""
    return left.join(right.hint("merge"), on, how)


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n), once for every two words of ``vocabulary``
    (word, n; distinct words) that are one edit apart, from either side."""
    spark = vocabulary.sparkSession
    rows = vocabulary.select("word", "n", F.xxhash64("word").alias("id"))

    def own(batches):
        for batch in batches:
            words = batch.column(0).to_pylist()
            for a, b in _pieces(words):
                keys, at = own_keys(words[a:b])
                part = batch.slice(a, b - a).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), part.column(0), part.column(1)], ["key", "near", "near_n"])

    listed = staged(rows.select("word", "n").mapInArrow(own, "key long, near string, near_n long"), "reduced-words")
    bits = spark.sparkContext.broadcast(_bit_map(listed))

    def spread(batches):
        held = bits.value
        for batch in batches:
            words, ids = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for a, b in _pieces(words):
                for keys, at in neighbour_keys(words[a:b]):
                    bit = keys & np.uint64((1 << BITS) - 1)
                    on = (held[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
                    # In a run of equal letters every place gives the same key.
                    keys, at = keys[on].view(np.int64), at[on]
                    order = np.lexsort((keys, at))
                    keys, at = keys[order], at[order]
                    new = np.ones(len(at), bool)
                    new[1:] = (keys[1:] != keys[:-1]) | (at[1:] != at[:-1])
                    yield pa.RecordBatch.from_arrays([pa.array(keys[new]), pa.array(ids[a:b][at[new]])], ["key", "id"])

    asked = rows.select("word", "id").mapInArrow(spread, "key long, id long")
    met = _merged(_merged(asked, listed, "key"), rows, "id").select("word", "n", "near", "near_n")

    def verified(batches):
        for batch in batches:
            on = [one_edit(a, b) for a, b in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            yield batch.filter(pa.array(on, pa.bool_()))

    return met.mapInArrow(verified, met.schema).distinct()


def spelling_variants(words: DataFrame, word: str = "word", n: str = "n", ratio: int = 2) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of a table of words
    and counts."""
    vocabulary = staged(
        words.select(F.col(f"`{word}`").alias("word"), F.col(f"`{n}`").cast("long").alias("n")).filter("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")),
        "vocabulary",
    )
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    near = near_pairs(vocabulary).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    near = near.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
    large = F.coalesce(F.col("form_n") >= F.lit(int(ratio)) * F.col("n"), F.lit(False))
    rows = staged(
        _merged(vocabulary, near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(large, F.col("form")).alias("form"), F.when(large, F.col("form_n")).alias("form_n")
        ),
        "forms",
    )
    roots = _roots(rows.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return _merged(rows, roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def _roots(steps: DataFrame) -> DataFrame:
    """Where chains of (word, root) lead: each round joins the table with
    itself and doubles the steps taken."""
    at, moved = staged_with_count(steps, "roots")
    while moved:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        far = _merged(at, on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        at = staged(far, "roots")
        moved = at.filter("moved").limit(1).count()
        at = at.drop("moved")
    return at


def one_letter_short(every: int):
    """Deletes a code point of every ``every``-th (document, run) by the crc32
    of ``<doc_id>:<run>``, so that a corpus holds variants to be found."""

    def change(doc_id: bytes):
        base = zlib.crc32(doc_id + b":")

        def to(run: bytes) -> bytes:
            h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), base)
            if h % every:
                return run
            k = h % len(run)
            return run[:k] + run[k + 1 :]

        return to

    return change


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of at least 5 letters and 3 occurrences with their variants."""
    counts = word_counts(table(spark, sf_dir, "documents"), change=one_letter_short(97))
    return spelling_variants(counts.filter((F.length("word") >= 5) & (F.col("n") >= 3)))
