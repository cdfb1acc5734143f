"""Repeated passages from a sparse suffix array.

A suffix is kept where it starts with a minimiser: the smallest hash of ``k``
words among ``window`` consecutive places.  The choice depends on the words
alone, so equal passages keep the same suffixes, about two in ``window + 1``.
A suffix's prefix are its first ``min_words - window + 1`` words, as a 96-bit
hash, so every passage of ``min_words`` words holds a kept suffix whose whole
prefix is inside it.  Each row carries two-byte hashes of the ``window - 1``
words after the prefix and before it.

Suffixes are ordered by the prefix, then by the words after and before it, then
by document and place, range-partitioned and sorted.  A prefix lies in
``window`` stretches of ``min_words`` words; suffixes of equal prefixes are
compared on each of them, so a stretch that another document has is met
whatever stands between the two in sorted order.  Stretches of a document that
overlap are one passage.  A group of equal prefixes that crosses a partition's
edge leaves the stretches that no other document had there, and two documents'
for each that some had; these are grouped once more.  So a passage that is in a
third of all documents is spread over many tasks.

Cases: null, empty or short texts have no passages; repeats inside one
doc_id do not count, nor do repeated rows of it; a null doc_id is one
document; an empty table gives an empty result.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import encoded, partitions, staged, table, texts, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_NULL_ID = -(2**63)
_MEMO_WORDS = 500_000
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
SUFFIX = "h long, g int, doc long, at int, near binary"


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _MEMO_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def word_hashes(text: str | None) -> np.ndarray:
    hashes = worker_cache("word hashes", _Hashes)
    return np.array([hashes[w] for w in encoded(text).split()], dtype=np.uint64)


def run_hashes(words: np.ndarray, size: int, factor: int) -> np.ndarray:
    """Hash of every run of ``size`` words: a polynomial modulo 2**64 from
    prefix sums, scaled back by the factor's inverse, then mixed."""
    n = len(words)
    powers = np.full(n + 1, factor, dtype=np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    inverse = np.full(n + 1, pow(factor, -1, 1 << 64), dtype=np.uint64)
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(words * powers[:n], out=sums[1:])
    own = (sums[size:] - sums[: n - size + 1]) * inverse[: n - size + 1]
    own = (own ^ (own >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return own ^ (own >> np.uint64(32))


def suffixes(words: np.ndarray, k: int, window: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kept places, and two hashes of the prefixes of ``size`` words there."""
    empty = np.zeros(0, dtype=np.int64)
    if len(words) < max(size, k + window - 1):
        return empty, empty.astype(np.uint64), empty.astype(np.uint64)
    grams = run_hashes(words, k, _FACTORS[0])
    least = sliding_window_view(grams, window).argmin(axis=1)
    at = np.unique(least + np.arange(len(least)))
    at = at[at + size <= len(words)]
    return at, run_hashes(words, size, _FACTORS[0])[at], run_hashes(words, size, _FACTORS[1])[at]


def suffix_array(docs: DataFrame, text: str, doc_id: str, k: int, window: int, size: int) -> DataFrame:
    """Rows of SUFFIX.  ``near``: two bytes for each of the window - 1 words
    after the prefix, then before it, the nearest first; 0 past the text."""
    reach = window - 1

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                places, first, second, near, counts = [], [], [], [], []
                for t in texts(part.column(1)):
                    words = word_hashes(t)
                    at, h, g = suffixes(words, k, window, size)
                    padded = np.zeros(len(words) + 2 * reach, dtype=np.uint16)
                    padded[reach : reach + len(words)] = (words % np.uint64(0xFFFF)).astype(np.uint16) + 1
                    before = at[:, None] + np.arange(reach - 1, -1, -1)
                    after = at[:, None] + reach + size + np.arange(reach)
                    near.append(padded[np.concatenate([after, before], axis=1)])
                    places.append(at)
                    first.append(h)
                    second.append(g)
                    counts.append(len(at))
                bytes_ = np.concatenate(near)
                ends = np.arange(len(bytes_) + 1, dtype=np.int32) * (4 * reach)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(first).view(np.int64)),
                        pa.array((np.concatenate(second) >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                        part.column(0).take(pa.array(np.repeat(np.arange(len(counts)), counts))),
                        pa.array(np.concatenate(places).astype(np.int32)),
                        pa.Array.from_buffers(pa.binary(), len(bytes_), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(bytes_.tobytes())]),
                    ],
                    ["h", "g", "doc", "at", "near"],
                )

    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL_ID)).alias("doc"), F.col(text).alias("text")).mapInArrow(run, SUFFIX)


def _stretches(h, g, near) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the stretches around each suffix, a column for each number of
    words before it, and whether the text is long enough for them."""
    n, reach = len(h), near.shape[1] // 2
    hashes = np.zeros((2, n, reach + 1), dtype=np.uint64)
    inside = np.ones((2, n, reach + 1), dtype=bool)
    for side in (0, 1):  # after, before
        own = near[:, side * reach : (side + 1) * reach]
        inside[side, :, 1:] = own > 0
        for i in range(reach):
            step = (hashes[side, :, i] + own[:, i] + np.uint64(1)) * np.uint64(_FACTORS[side])
            hashes[side, :, i + 1] = step ^ (step >> np.uint64(29))
    mixed = h.view(np.uint64) ^ (g.astype(np.uint64) << np.uint64(17))
    keys = hashes[0, :, ::-1] * np.uint64(0xD6E8FEB86659FD93) + hashes[1] + np.arange(reach + 1, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25)
    keys = (keys ^ (keys >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + mixed[:, None]
    return (keys ^ (keys >> np.uint64(31))).view(np.int64), inside[0, :, ::-1] & inside[1]


def _matches(h, g, doc, at, near, size: int, open_left: bool, open_right: bool):
    """(row, start, stop) of suffixes with a stretch that another document
    has, and (key, row, start) of the stretches to be compared with those of
    other parts, of the first and last group if they are open."""
    n, reach = len(h), near.shape[1] // 2
    begin = np.ones(n, dtype=bool)
    begin[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    group, first = np.cumsum(begin) - 1, np.flatnonzero(begin)
    several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
    partial = np.zeros(len(first), dtype=bool)
    partial[0] |= open_left
    partial[-1] |= open_right
    rows = np.flatnonzero((several | partial)[group])
    keys, inside = _stretches(h[rows], g[rows], near[rows])
    doc, at, is_open = doc[rows], at[rows], partial[group[rows]]
    lefts, rights = np.full(len(rows), -1), np.full(len(rows), reach + 1)
    left_over = [(np.zeros(0, dtype=np.int64),) * 3]
    for before in range(reach + 1):
        own = np.flatnonzero(inside[:, before])
        if not len(own):
            continue
        own = own[np.lexsort((doc[own], keys[own, before]))]
        key = keys[own, before]
        new = np.ones(len(own), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        run, start = np.cumsum(new) - 1, np.flatnonzero(new)
        stop = np.append(start[1:], len(own)) - 1
        shared = (doc[own[start]] != doc[own[stop]])[run]
        lefts[own[shared]] = before
        rights[own[shared]] = np.minimum(rights[own[shared]], before)
        place = np.arange(len(own))
        left = own[is_open[own] & (~shared | (place == start[run]) | (place == stop[run]))]
        left_over.append((keys[left, before], rows[left], at[left] - before))
    found = np.flatnonzero(lefts >= 0)
    matched = rows[found], at[found] - lefts[found], at[found] - rights[found] + size + reach
    return matched, tuple(np.concatenate(x) for x in zip(*left_over))


def compare_neighbours(rows: DataFrame, size: int, whole: bool) -> DataFrame:
    """(doc, start, stop) of matches in sorted suffixes.  If groups of equal
    prefixes may cross partitions (not ``whole``), stretches of a partition's
    first and last group follow with their key, start null."""

    def run(batches):
        held: list[pa.RecordBatch] = []

        def finished(part: pa.Table, left: bool, right: bool):
            near = np.frombuffer(b"".join(part.column("near").to_pylist()), dtype=np.uint16).reshape(part.num_rows, -1)
            h, g, doc, at = (part.column(c).to_numpy() for c in ("h", "g", "doc", "at"))
            (row, start, stop), (key, of, first) = _matches(h, g, doc, at, near, size, left, right)
            names = ["doc", "start", "stop", "key", "g", "first"]
            none = lambda n, *kinds: [pa.nulls(n, k) for k in kinds]
            found = [pa.array(doc[row], pa.int64()), pa.array(start, pa.int32()), pa.array(stop, pa.int32())]
            yield pa.RecordBatch.from_arrays([*found, *none(len(row), pa.int64(), pa.int32(), pa.int32())], names)
            for a in range(0, len(key), 100_000):
                k, o, f = key[a : a + 100_000], of[a : a + 100_000], first[a : a + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[o], pa.int64()), *none(len(k), pa.int32(), pa.int32()), pa.array(k), pa.array(g[o], pa.int32()), pa.array(f, pa.int32())],
                    names,
                )

        # parts are cut between groups, except that a group of more than
        # 200,000 rows is cut anywhere
        left, count = not whole, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            count += batch.num_rows
            if count < 50_000:
                continue
            part = pa.Table.from_batches(held)
            h, g = (part.column(c).to_numpy() for c in ("h", "g"))
            cut = np.flatnonzero((h[1:] != h[:-1]) | (g[1:] != g[:-1])) + 1
            if len(cut):
                yield from finished(part.slice(0, cut[-1]), left, False)
                left, held = False, part.slice(cut[-1]).to_batches()
            elif count > 200_000 and not whole:
                yield from finished(part, True, True)
                left, held = True, []
            count = sum(b.num_rows for b in held)
        if held:
            yield from finished(pa.Table.from_batches(held), left, not whole)

    return rows.mapInArrow(run, "doc long, start int, stop int, key long, g int, first int")


def repeated_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = 51, k: int = 8, window: int = 16) -> DataFrame:
    """(doc_id, passages) of the documents that have any: array of
    (start, stop), in words, stop exclusive."""
    spark, size = docs.sparkSession, min_words - window + 1
    # in order of the words around the prefix, so that a large group's equal
    # stretches are mostly in the same part
    order = ["h", "g", "near", "doc", "at"]
    array = suffix_array(docs, text, doc_id, k, window, size)  # twice: range bounds are sampled; cheaper than on disk
    ranged = array.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    found = staged(compare_neighbours(ranged, size, False), "suffix-matches")
    crossing = found.filter("start IS NULL").groupBy("key", "g")
    crossing = crossing.agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.collect_list(F.struct("doc", "first")).alias("own"))
    again = crossing.filter("least < most").select(F.inline("own")).select("doc", F.col("first").alias("start"), (F.col("first") + min_words).alias("stop"))
    matches = found.filter("start IS NOT NULL").select("doc", "start", "stop").unionByName(again).distinct()
    lists = matches.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))

    def merge(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            out = []
            for spans in batch.column(1):
                merged: list[list[int]] = []
                for s in spans.as_py():
                    if merged and s["start"] < merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s["stop"])
                    else:
                        merged.append([s["start"], s["stop"]])
                out.append([{"start": a, "stop": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["doc", "passages"])

    merged = lists.mapInArrow(merge, "doc long, passages array<struct<start:long,stop:long>>").filter(F.size("passages") > 0)
    return merged.select(F.when(F.col("doc") != _NULL_ID, F.col("doc")).alias("doc_id"), "passages")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per repeated passage: the document, and the passage's words."""
    found = repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = found.select("doc_id", F.posexplode("passages").alias("passage", "p"))
    return rows.select("doc_id", "passage", F.col("p.start").alias("start"), F.col("p.stop").alias("stop"))
