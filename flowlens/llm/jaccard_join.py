"""N-gram Jaccard self-join with a MinHash LSH forest.

A document's shingles are its runs of five words (all its words if it has
fewer).  Documents with equal shingle sets are one class of copies, kept once
with its number of members; everything after that is between classes.

Forest: ``trees`` MinHash signatures per class, each a path of a prefix trie;
classes that share a node at depth d are candidates.  Starting from the
deepest level, the matched prefix is shortened until a pair at the threshold
is found with the target recall (with 24 trees and 0.9999: depth 5, recall
0.99993 at similarity 0.8, more above).  Trie nodes that hold the same classes
in several trees are visited once.  Inside a node all pairs are compared by
their signatures, five standard deviations below the threshold, and the ones
that pass are linked; the connected parts of that graph hold every pair that
can be similar.

Verification: inside each part the shingle sets themselves are compared, so
the result has no false link.  Output per document: class_id, the smallest
doc_id of its connected group of similar documents, and n_links, the number of
other documents whose similarity to it is at or over the threshold.

Skew: a trie node or part with many classes is cut into blocks and each pair
of blocks is a group of its own; copies cost one row.  Counting the links of n
different texts that are all alike needs n * n comparisons; they run in
blocks, inside tasks, and only sums and spanning edges leave them.

Cases: no words (null or empty): no links, class_id is the own doc_id; null
doc_ids are documents with null class_id if the whole group has none; repeated
rows are copies; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Forest, components, encoded, free_name, grouped, int_lists, partitions, staged, table, texts, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 5
SIMILARITY = 0.8
_MEMO_WORDS = 500_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _MEMO_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    own = encoded(text).split()
    if not own:
        return np.zeros(0, dtype=np.uint64)
    hashes = worker_cache("word hashes", _Hashes)
    h = np.array([hashes[w] for w in own], dtype=np.uint64)
    size = min(words, len(h))
    rolled = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for j in range(size):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - size + 1 + j]
        rolled ^= rolled >> np.uint64(31)
    return np.unique(mixed(rolled))


def set_digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def depth_for(similarity: float, trees: int, recall: float, deepest: int) -> int:
    """Shortens the matched prefix from ``deepest`` until a pair at
    ``similarity`` shares a node of some tree with probability ``recall``."""
    depth = deepest
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < recall:
        depth -= 1
    return depth


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rand = np.random.RandomState(7)
    return (
        (rand.randint(0, 1 << 31, n, dtype=np.int64) * 2 + 1).astype(np.uint32),
        rand.randint(0, 1 << 32, n, dtype=np.int64).astype(np.uint32),
    )


def signature(own: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash of a shingle set: 32-bit minima of each permutation."""
    low = np.full(len(factors), 0xFFFFFFFF, dtype=np.uint32)
    short = (own >> np.uint64(32)).astype(np.uint32)
    for a in range(0, len(short), 2048):
        part = factors[:, None] * short[None, a : a + 2048] + offsets[:, None]
        np.minimum(low, part.min(axis=1), out=low)
    return low


def node_keys(low: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """For each tree, its trie node at ``depth`` as a signed 64-bit hash."""
    key = np.arange(trees, dtype=np.uint64)
    for column in low.reshape(trees, depth).T:
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64) + np.uint64(1))
    return key.view(np.int64)


def signed(docs: DataFrame, text: str, doc_id: str, words: int, trees: int, depth: int) -> DataFrame:
    """(doc, digest, nodes, signature) per row; digest is null without words."""

    def run(batches):
        factors, offsets = _permutations(trees * depth)
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                digests, nodes, sigs = [], [], []
                for t in texts(part.column(1)):
                    own = shingles(t, words)
                    if not len(own):
                        digests.append(None)
                        nodes.append(np.zeros(0, dtype=np.int64))
                        sigs.append(None)
                        continue
                    low = signature(own, factors, offsets)
                    digests.append(set_digest(own))
                    nodes.append(node_keys(low, trees, depth))
                    sigs.append(low.astype(np.uint16).tobytes())
                lists = int_lists(np.concatenate(nodes), [len(x) for x in nodes], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(digests, pa.binary()), lists, pa.array(sigs, pa.binary())],
                    ["doc", "digest", "nodes", "signature"],
                )

    return docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")).mapInArrow(
        run, "doc long, digest binary, nodes array<long>, signature binary"
    )


def in_blocks(rows: DataFrame, keys: list[str], node: str, n: Column, size: Column) -> DataFrame:
    """Rows of a group of ``n`` dealt to pairs of blocks of about ``size``:
    adds block, low and high (a row is in all pairs with its block), and
    brings each (keys, low, high) together, sorted, for ``grouped``."""
    dealt = (
        rows.withColumn("blocks", F.ceil(n / size).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64(node), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("other", "blocks")
    )
    by = [*keys, "low", "high"]
    return dealt.repartition(partitions(rows.sparkSession), *by).sortWithinPartitions(*by)


def sides(group: pa.Table) -> tuple[np.ndarray, np.ndarray | None]:
    """Whether a row is in the lower block, or None inside one block."""
    low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
    return group.column("block").to_numpy() == low, None if low == high else True


def signature_edges(members: DataFrame, least: int, width: int, block: int) -> DataFrame:
    """(a, b) edges that connect the classes of a trie node whose signatures
    agree in ``least`` places or more."""
    rows = in_blocks(members, ["key"], "node", F.col("n"), F.lit(block))

    def run(batches):
        for group in grouped(batches, ["key", "low", "high"]):
            nodes = group.column("node").to_numpy()
            sig = np.frombuffer(b"".join(x.as_py() for x in group.column("signature")), dtype=np.uint16).reshape(len(nodes), width)
            lower, two = sides(group)
            forest = Forest(len(nodes))
            index = np.arange(len(nodes))
            roots = index.copy()
            for i in range(len(nodes)):
                rest = index > i if two is None else (~lower if lower[i] else np.zeros(len(nodes), dtype=bool))
                rest = np.flatnonzero(rest & (roots != roots[i]))
                if not len(rest):
                    continue
                near = rest[(sig[rest] == sig[i]).sum(axis=1) >= least]
                for j in near.tolist():
                    forest.union(i, j)
                if len(near):
                    joined = np.isin(roots, np.append(roots[near], roots[i]))
                    roots[joined] = roots[joined].min()
            top = np.array([forest.find(i) for i in range(len(nodes))], dtype=np.int64)
            moved = np.flatnonzero(top != index)
            yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[top[moved]])], ["a", "b"])

    return rows.select("key", "low", "high", "block", "node", "signature").mapInArrow(run, "a long, b long")


def intersections(sets: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of all pairs' intersections, ``columns`` shared elements at a
    time."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[at] > 1
    owner = owner[shared]
    _, at = np.unique(at[shared], return_inverse=True)
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    out = np.zeros((n, n), dtype=np.float64)
    total = int(at[-1]) + 1 if len(at) else 0
    for a in range(0, total, columns):
        lo, hi = np.searchsorted(at, [a, a + columns])
        part = np.zeros((n, min(columns, total - a)), dtype=np.float32)
        part[owner[lo:hi], at[lo:hi] - a] = 1
        out += part @ part.T
    return out.astype(np.int64)


def verified(rows: DataFrame, similarity: float, block: int) -> DataFrame:
    """(node, links, top): for each block pair's classes the documents linked
    to it there, and a class of the same block pair it is connected to."""
    size = F.least(F.lit(4 * block), F.greatest(F.lit(block), F.col("n") / 64))
    dealt = in_blocks(rows, ["root"], "node", F.col("n"), size)

    def run(batches):
        for group in grouped(batches, ["root", "low", "high"]):
            nodes, first = np.unique(group.column("node").to_numpy(), return_index=True)
            if len(nodes) < 2:
                continue
            group = group.take(pa.array(first))
            sets = [np.frombuffer(x.as_py(), dtype=np.uint64) for x in group.column("own")]
            copies = group.column("copies").to_numpy()
            lower, two = sides(group)
            both = intersections(sets)
            sizes = np.array([len(s) for s in sets])
            linked = both >= similarity * (sizes[:, None] + sizes[None, :] - both) - 1e-9
            np.fill_diagonal(linked, False)
            if two is not None:
                linked &= lower[:, None] != lower[None, :]
            forest = Forest(len(nodes))
            for i, j in zip(*np.nonzero(np.triu(linked))):
                forest.union(int(i), int(j))
            top = np.array([forest.find(i) for i in range(len(nodes))], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array((linked * copies[None, :]).sum(axis=1).astype(np.int64)), pa.array(nodes[top])],
                ["node", "links", "top"],
            )

    return dealt.select("root", "low", "high", "block", "node", "copies", "own").mapInArrow(run, "node long, links long, top long")


def similar_documents(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    words: int = WORDS,
    similarity: float = SIMILARITY,
    trees: int = 24,
    deepest: int = 8,
    recall: float = 0.9999,
) -> DataFrame:
    """(doc_id, class_id, n_links), one row per row of ``docs``."""
    depth = depth_for(similarity, trees, recall, deepest)
    width = trees * depth
    least = math.floor(width * similarity - 5 * math.sqrt(width * similarity * (1 - similarity)))
    rows = staged(signed(docs, text, doc_id, words, trees, depth).withColumn("row", F.monotonically_increasing_id()), "jaccard-signed")
    classes = staged(
        rows.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("row").alias("node"), F.min("doc").alias("doc"), F.count("*").alias("copies")),
        "jaccard-classes",
    )
    kept = rows.join(classes.select(F.col("node").alias("row")), "row", "left_semi")
    paths = kept.select(F.col("row").alias("node"), F.explode("nodes").alias("key"))
    tries = paths.groupBy("key").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("f1"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("f2")
    )
    # the same classes meet in several trees: one node stands for all
    tries = staged(tries.filter("n > 1").groupBy("n", "f1", "f2").agg(F.min("key").alias("key")).select("key", "n"), "jaccard-tries")
    members = staged(paths.join(tries, "key"), "jaccard-members")
    with_signature = members.join(rows.select(F.col("row").alias("node"), "signature"), "node")
    parts = components(staged(signature_edges(with_signature, least, width, 1024), "jaccard-edges"))
    sized = parts.join(parts.groupBy("root").agg(F.count("*").alias("n")), "root")
    wanted = staged(
        sized.join(classes, "node")
        .join(rows.select(F.col("row").alias("node"), F.col("doc").alias("w_doc")), "node")
        .select("w_doc", "root", "n", "node", "copies", F.col("digest").alias("w_digest")),
        "jaccard-wanted",
    )
    # shuffled at every size, so that a small corpus runs like a large one
    again = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")).join(
        wanted.hint("merge"), F.col("doc").eqNullSafe(F.col("w_doc")), "inner"
    )

    def sets(batches):
        for batch in batches:
            digests, keep, own = batch.column(5), [], []
            for i, t in enumerate(texts(batch.column(0))):
                s = shingles(t, words)
                if set_digest(s) == digests[i].as_py():
                    keep.append(i)
                    own.append(s.tobytes())
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns[1:5], pa.array(own, pa.binary())], ["root", "n", "node", "copies", "own"])

    found = again.select("text", "root", "n", "node", "copies", "w_digest").mapInArrow(
        sets, "root long, n long, node long, copies long, own binary"
    )
    checked = staged(verified(found, similarity, 128), "jaccard-verified")
    groups = components(checked.select(F.col("node").alias("a"), F.col("top").alias("b")))
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    tops = groups.join(classes.select("node", "doc"), "node").groupBy("root").agg(F.min("doc").alias("class_id"))
    result = staged(
        classes.join(links, "node", "left")
        .join(groups.join(tops, "root").select("node", "class_id"), "node", "left")
        .select(
            F.col("digest").alias("c_digest"),
            F.coalesce("class_id", "doc").alias("class_id"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        ),
        "jaccard-result",
    )
    return (
        rows.select("doc", "digest")
        .join(result, F.col("digest") == F.col("c_digest"), "left")
        .select(
            F.col("doc").alias("doc_id"),
            F.when(F.col("digest").isNull(), F.col("doc")).otherwise(F.col("class_id")).alias("class_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        )
    )


def keep_one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` with the smallest doc_id of each group of similar documents;
    repeated rows (same doc_id and text) once."""
    keepers = similar_documents(docs, text, doc_id, **options).filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
    keepers = staged(keepers.select(F.col("doc_id").alias("k")).distinct(), "jaccard-keepers")
    mine, rank = free_name(docs.columns, "k"), free_name(docs.columns, "rank")
    kept = docs.join(keepers.withColumnRenamed("k", mine).hint("merge"), F.col(f"`{doc_id}`").cast("long").eqNullSafe(F.col(mine)), "left_semi")
    one = Window.partitionBy(F.col(f"`{doc_id}`"), F.xxhash64(F.col(f"`{text}`"))).orderBy(F.col(f"`{text}`"))
    return kept.withColumn(rank, F.row_number().over(one)).filter(F.col(rank) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE_SQL = r"""
WITH RECURSIVE ws AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i : i + least(5, len(w)) - 1], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM ws WHERE len(w) > 0)),
sized AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
ranked AS (
  SELECT doc_id, s, n, row_number() OVER (PARTITION BY doc_id ORDER BY f, s) AS pos
  FROM sh JOIN sized USING (doc_id) JOIN (SELECT s, count(*) AS f FROM sh GROUP BY s) USING (s)),
prefix AS (SELECT doc_id, s FROM ranked WHERE pos <= n - ceil(0.8 * n) + 1),
cand AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM prefix a JOIN prefix b ON a.s = b.s AND a.doc_id < b.doc_id),
inter AS (
  SELECT a, b, count(*) AS k FROM cand JOIN sh x ON x.doc_id = a JOIN sh y ON y.doc_id = b AND y.s = x.s GROUP BY a, b),
pairs AS (
  SELECT a, b FROM inter JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 5 * k >= 4 * (x.n + y.n - k)),
links AS (SELECT a AS doc_id, b AS other FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.other FROM reach r JOIN links l ON l.doc_id = r.other)
SELECT d.doc_id, (SELECT min(other) FROM reach WHERE reach.doc_id = d.doc_id) AS class_id,
  (SELECT count(*) FROM links WHERE links.doc_id = d.doc_id) AS n_links
FROM documents d
"""
