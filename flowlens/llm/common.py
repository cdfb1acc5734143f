"""Helpers the text operators share: words, staged tables, Arrow plumbing."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and reread: cuts
    the lineage in a place that outlives any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(taken: list[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no input column has it."""
    low = {c.lower() for c in taken}
    while wanted.lower() in low:
        wanted = f"_{wanted}"
    return wanted


def worker_cache(name: str, make):
    """What ``make`` gives, kept in the Python worker from task to task.
    (Module globals start anew with each task, as modules are shipped by
    value.)  A worker keeps one such thing: another name's goes, so that the
    operators of a pipeline do not add up."""
    kept = sys.modules.setdefault("_flowlens_worker_cache", types.ModuleType("_flowlens_worker_cache"))
    held = getattr(kept, "held", None)
    if held is None or held[0] != name:
        kept.held = held = None
        kept.held = held = (name, make())
    return held[1]


def encoded(text: str | None) -> bytes:
    """UTF-8 of a text, None as empty.  ``bytes.split()`` of it gives the words
    ``[^\\x20\\x09-\\x0D]+``: it splits at exactly these six characters."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def texts(column: pa.Array) -> Iterator[str | None]:
    """The strings of an Arrow column, one at a time."""
    for i in range(len(column)):
        yield column[i].as_py()


def int_lists(values: np.ndarray, lengths, kind: pa.DataType) -> pa.Array:
    """Lists cut one after another out of ``values``."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal, non-null integer ``keys`` in sorted batches, across
    batch edges.  One run is in memory at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(n, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        change[0] = last is not None and first != last
        cuts = [0, *np.flatnonzero(change).tolist(), n]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if change[a] and held:
                yield pa.Table.from_batches(held)
                held = []
            if b > a:
                held.append(batch.slice(a, b - a))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge list: (node, root), root the
    smallest node, for every node that has an edge to another.

    Each round every node takes its smallest neighbour (or itself) as parent
    and the edges are contracted to the parents; at least half of the nodes
    that still have edges go, so rounds grow with the logarithm of the size.
    Each round's tables are staged; joins carry one row per node on one side,
    so a node with very many edges is split by AQE's skew join."""
    pairs = staged(
        edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a < b").distinct(), "cc-edges"
    )
    roots = None
    while not pairs.isEmpty():
        both = pairs.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(
            pairs.select(F.col("b").alias("node"), F.col("a").alias("near"))
        )
        parent = staged(
            both.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("parent")),
            "cc-parents",
        )
        if roots is None:
            roots = parent.select("node", F.col("parent").alias("root"))
        else:
            step = parent.select(F.col("node").alias("root"), "parent")
            roots = staged(
                roots.join(step, "root", "left").select("node", F.coalesce("parent", "root").alias("root")), "cc-roots"
            )
        up = lambda side: parent.select(F.col("node").alias(side), F.col("parent").alias(f"{side}_up"))
        pairs = staged(
            pairs.join(up("a"), "a")
            .join(up("b"), "b")
            .select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b"))
            .filter("a < b")
            .distinct(),
            "cc-edges",
        )
    if roots is None:
        return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots


class Forest:
    """Union-find over 0..n-1; the root of a set is its smallest member."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def union(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True
