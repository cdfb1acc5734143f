"""Ranked lexical search: the k best documents of every item, by dual trees.

A text's terms are its maximal runs of ASCII letters and digits and of code
points beyond ASCII, only A-Z lower-cased.  A document scores the sum, over the
item's terms (repeats included), of the term's weight times a saturated share of
its occurrences that falls with the document's length (``term_weights``,
``impacts``); all in 64-bit integers.

Items and documents are sparse vectors (weights; impacts), so a score is their
inner product.  Each side has a hierarchy: neighbours in an order by their
commonest terms (documents also by length) form nodes of ``FAN``, these again,
up to one root; a node holds the maximum of every coordinate below it.  The
product of two nodes' maxima bounds every score between them.  From the roots
down, a pair of nodes is dropped, with all items and documents below it, when
its bound is under the weakest kth score of the node's items: nothing below it
can enter a list.  Pairs of leaves that are left have exact scores.  Ties stay
in (only a bound strictly under the kth score drops), so results are exact.

On Spark: one pass turns texts into vectors over the items' terms, which are
staged with each document's length; document frequencies and totals are
aggregates over them.  Every task builds the trees of its documents a block at
a time and keeps k documents an item.  A search of 1/64 of the documents (by a
hash) first gives every task kth scores to start from; they are scores of real
documents, so they only save work.  Tasks' lists are merged by a rank per item.
Items are taken in slices of about ``slice_bytes`` of text, each with its own
pass and its own staged result, so a task holds one slice however large the
benchmark is.

Cases: null or empty texts have no terms, their documents count nowhere and
their items have no rows; documents without a common term are not listed; equal
scores by ascending doc_id, null last; repeated documents are listed each; equal
(item_id, text) rows are one item, an id with several texts is ranked for each;
long texts are read whole, a piece at a time; other columns are ignored.
"""

from __future__ import annotations

import math
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import encoded, int_lists, staged, table, texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FAN = 8
BLOCK = 1024
_BLOCK_ENTRIES = 400_000
_CELLS = 4_000_000
_CHUNK = 1 << 20
SEED = 64

#: One byte a byte of UTF-8: digits, a-z and all of non-ASCII as they are, A-Z
#: lower-cased, everything else a space.
TERM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str | None):
    """Lists of a text's terms as bytes, piece by piece."""
    raw = encoded(text).translate(TERM)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + _CHUNK) if at + _CHUNK < len(raw) else -1
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Of a term that occurs ``tf`` times in a document of ``n`` terms."""
    m = 100 - 25 + (25 * n * n_docs) // max(n_terms, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... (length[0] of them), start[1], ..."""
    before = np.cumsum(length) - length
    return np.repeat(start - before, length) + np.arange(int(length.sum()))


def _maxima(node: np.ndarray, term: np.ndarray, value: np.ndarray, width: int):
    """The largest value of every (node, term), in that order."""
    key = node * width + term
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    value = np.maximum.reduceat(value[order], first) if len(key) else value
    return key[first] // width, key[first] % width, value


class Tree:
    """Levels of nodes over rows 0..n-1 (level 0: the rows; each further one:
    nodes of FAN neighbours), as (node, term, maximum) in node order."""

    def __init__(self, row: np.ndarray, term: np.ndarray, value: np.ndarray, n: int, width: int):
        self.sizes, self.levels = [n], [_maxima(row, term, value, width)]
        while self.sizes[-1] > 1:
            node, t, v = self.levels[-1]
            self.levels.append(_maxima(node // FAN, t, v, width))
            self.sizes.append(-(-self.sizes[-1] // FAN))
        self.starts = [np.searchsorted(node, np.arange(n + 1)) for (node, _, _), n in zip(self.levels, self.sizes)]

    def children(self, level: int, nodes: np.ndarray):
        """(children one level down, how many each node has)."""
        n = np.minimum(FAN, self.sizes[level - 1] - nodes * FAN)
        return _ranges(nodes * FAN, n), n


class Items:
    """The items' tree, each level also listed by term."""

    def __init__(self, ids: list, counts: list[dict[int, int]], weight: np.ndarray, df: np.ndarray):
        common = [tuple(sorted(c, key=lambda t: (-df[t], t))[:FAN]) for c in counts]
        order = sorted(range(len(ids)), key=lambda i: (common[i], i))
        self.ids, self.width = [ids[i] for i in order], max(len(weight), 1)
        row = np.repeat(np.arange(len(order)), [len(counts[i]) for i in order])
        term = np.array([t for i in order for t in counts[i]], np.int64)
        value = np.array([n for i in order for n in counts[i].values()], np.int64) * weight[term]
        self.tree = Tree(row, term, value, len(order), self.width)
        self.by_term = []
        for node, t, v in self.tree.levels:
            by = np.argsort(t, kind="stable")
            top = np.zeros(self.width, np.int64)
            np.maximum.at(top, t, v)
            exact = float(top.sum()) * 1e6 < 2.0**53  # sums fit a double
            self.by_term.append((np.searchsorted(t[by], np.arange(self.width + 1)), node[by], v[by], exact))

    def weakest(self, kth: np.ndarray) -> list[np.ndarray]:
        """Per level the smallest kth score below each node."""
        out = [kth]
        for n in self.tree.sizes[1:]:
            out.append(np.minimum.reduceat(out[-1], np.arange(n) * FAN))
        return out

    def bounds(self, docs: Tree, doc_level: int, level: int, nodes: np.ndarray) -> np.ndarray:
        """The products of document nodes with all item nodes of a level."""
        starts, item_node, item_value, exact = self.by_term[level]
        n = self.tree.sizes[level]
        _, term, value = docs.levels[doc_level]
        begin = docs.starts[doc_level][nodes]
        length = docs.starts[doc_level][nodes + 1] - begin
        entry = _ranges(begin, length)
        owner = np.repeat(np.arange(len(nodes)), length)
        t, v = term[entry], value[entry]
        fan = starts[t + 1] - starts[t]
        out = np.zeros(len(nodes) * n, np.int64)
        cuts = np.searchsorted(np.cumsum(fan), np.arange(0, int(fan.sum()) + _CELLS, _CELLS), side="right")
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            at = _ranges(starts[t[a:b]], fan[a:b])
            cell = np.repeat(owner[a:b] * n, fan[a:b]) + item_node[at]
            product = np.repeat(v[a:b], fan[a:b]) * item_value[at]
            if exact:
                low = int(owner[a]) * n
                out[low : (int(owner[b - 1]) + 1) * n] += np.bincount(cell - low, product, (int(owner[b - 1]) + 1) * n - low).astype(np.int64)
            else:
                np.add.at(out, cell, product)
        return out.reshape(len(nodes), n)


def search(items: Items, docs: Tree, kth: np.ndarray):
    """(item, document, score) of every pair that may be in an item's list,
    given scores that its kth has at least; scores are above 0."""
    weakest = items.weakest(kth)
    ld, li = len(docs.sizes) - 1, len(items.tree.sizes) - 1
    d, i = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while True:
        nodes, at = np.unique(d, return_inverse=True)
        step = max(1, _CELLS // items.tree.sizes[li])
        bound = np.zeros(len(d), np.int64)
        for a in range(0, len(nodes), step):
            here = (at >= a) & (at < a + step)
            bound[here] = items.bounds(docs, ld, li, nodes[a : a + step])[at[here] - a, i[here]]
        on = bound >= np.maximum(weakest[li][i], 1)
        d, i, bound = d[on], i[on], bound[on]
        if ld == li == 0 or not len(d):
            return i, d, bound
        if ld:
            d, n = docs.children(ld, d)
            i, ld = np.repeat(i, n), ld - 1
        if li:
            i, n = items.tree.children(li, i)
            d, li = np.repeat(d, n), li - 1


class Best:
    """The k best documents of every item so far: by score, then doc_id, null
    last."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.kth = k, floor.copy()
        self.item, self.score, self.doc, self.null = (np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool))

    def add(self, item, score, doc, null) -> None:
        if not len(item):
            return
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, score])
        doc, null = np.concatenate([self.doc, doc]), np.concatenate([self.null, null])
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        first = np.searchsorted(item, item)
        place = np.arange(len(item)) - first
        own = order[place < self.k]
        last = place == self.k - 1
        self.kth[item[last]] = np.maximum(self.kth[item[last]], score[order][last])
        self.item, self.score, self.doc, self.null = item[place < self.k], score[own], doc[own], null[own]


def _vectors(docs: DataFrame, vocabulary) -> DataFrame:
    """(id, n, terms, tfs): a document's length and its terms of the
    vocabulary."""

    def read(batches):
        known = vocabulary.value.get
        for batch in batches:
            lengths, sizes, found, counts = [], [], [], []
            for t in texts(batch.column(1)):
                n, own = 0, Counter()
                for words in terms(t):
                    n += len(words)
                    own.update(map(known, words))
                own.pop(None, None)
                lengths.append(n)
                sizes.append(len(own))
                found.extend(own)
                counts.extend(own.values())
            lists = [int_lists(np.array(x, np.int32), sizes, pa.int32()) for x in (found, counts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64()), *lists], ["id", "n", "terms", "tfs"])

    return docs.mapInArrow(read, "id long, n long, terms array<int>, tfs array<int>")


def _search_all(vectors: DataFrame, items, n_docs: int, n_terms: int, k: int, floor) -> DataFrame:
    """(item, doc, score): every task's k best documents of each item."""

    def block(batch, held: Items, best: Best) -> None:
        size = np.diff(batch.column(2).offsets.to_numpy())
        own = np.flatnonzero(size)
        if not len(own):
            return
        n = batch.column(1).to_numpy()
        term = batch.column(2).flatten().to_numpy().astype(np.int64)
        tf = batch.column(3).flatten().to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(size)), size)
        value = impacts(tf, n[row], n_docs, n_terms)
        most = np.zeros(len(size), np.int64)  # the term with the most occurrences
        by = np.lexsort((-term, tf, row))
        most[row[by]] = term[by]
        order = own[np.lexsort((n[own], most[own]))]
        place = np.zeros(len(size), np.int64)
        place[order] = np.arange(len(order))
        item, doc, score = search(held, Tree(place[row], term, value, len(order), held.width), best.kth)
        ids = batch.column(0).take(pa.array(order[doc]))
        best.add(item, score, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))

    def run(batches):
        held = items.value
        best = Best(len(held.ids), k, floor.value)
        for batch in batches:
            a = 0
            ends = batch.column(2).offsets.to_numpy()
            while a < batch.num_rows:  # about BLOCK documents, fewer when they are long
                b = min(a + BLOCK, int(np.searchsorted(ends, ends[a] + _BLOCK_ENTRIES, side="left")), batch.num_rows)
                b = max(b, a + 1)
                block(pa.RecordBatch.from_arrays([pa.concat_arrays([c.slice(a, b - a)]) for c in batch.columns], schema=batch.schema), held, best)
                a = b
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item), pa.array(best.doc, pa.int64(), mask=best.null), pa.array(best.score)], ["item", "doc", "score"]
        )

    return vectors.mapInArrow(run, "item long, doc long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search_slice(docs: DataFrame, rows: list, k: int) -> DataFrame | None:
    spark = docs.sparkSession
    context = spark.sparkContext
    vocabulary: dict[bytes, int] = {}
    ids, counts = [], []
    for item, text in rows:
        own = Counter(vocabulary.setdefault(w, len(vocabulary)) for words in terms(text) for w in words)
        if own:
            ids.append(item)
            counts.append(own)
    if not ids:
        return None
    vectors = staged(_vectors(docs, context.broadcast(vocabulary)), "term-vectors")
    total = vectors.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = int(total["docs"]), int(total["terms"] or 0)
    df = np.zeros(len(vocabulary), np.int64)
    for row in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # the slice's terms at most
        df[row["t"]] = row["count"]
    held = context.broadcast(Items(ids, counts, term_weights(df, n_docs), df))
    floor = np.zeros(len(ids), np.int64)
    part = vectors.filter(F.pmod(F.xxhash64("id", "n", "terms"), F.lit(SEED)) == 0)
    for row in _ranked(_search_all(part, held, n_docs, n_terms, k, context.broadcast(floor)), k).filter(F.col("rank") == k).collect():
        floor[row["item"]] = row["score"]
    found = _ranked(_search_all(vectors, held, n_docs, n_terms, k, context.broadcast(floor)), k)
    names = spark.createDataFrame(list(enumerate(held.value.ids)), "item long, item_id long")
    return staged(found.join(names, "item").select("item_id", "rank", F.col("doc").alias("doc_id"), "score"), "ranked")


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    slice_bytes: int = 4_000_000,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item
    with scores above 0 (ids are whole numbers)."""
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    rows = items.select(F.col(f"`{item_id}`").cast("long").alias("i"), F.col(f"`{item_text}`").alias("t")).filter("t <> ''").distinct()
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = -(-int(size) // slice_bytes)
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for part in range(parts):
        own = rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == part).collect()  # about slice_bytes
        found = _search_slice(docs, sorted(((r["i"], r["t"]) for r in own), key=lambda x: (x[0] is None, x)), k)
        out = out if found is None else out.unionByName(found)
    return out


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents
), tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM docs) GROUP BY r, t),
n AS (SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r),
st AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM n),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM df, st),
items AS (
  SELECT row_number() OVER () AS i, item_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM (SELECT DISTINCT item_id, text FROM benchmark)
), q AS (SELECT i, t, count(*) AS qtf FROM (SELECT i, unnest(ts) AS t FROM items) GROUP BY i, t),
scored AS (
  SELECT q.i, tf.r, sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // n_terms)))))::BIGINT AS score
  FROM q JOIN tf USING (t) JOIN w USING (t) JOIN n USING (r), st GROUP BY q.i, tf.r
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
  FROM scored JOIN items USING (i) JOIN docs USING (r) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
