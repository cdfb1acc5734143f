"""Line deduplication over levelled sorted runs of line hashes.

Documents come in batches of descending ``doc_id``, of about ``batch_lines``
lines each and always more than ``fanout``, so that levels fill at any size; the
lines are written once by batch, so each batch reads its own.  A run is a table of
(line hash, documents that hold it, keeper), bucketed and sorted by the hash.
Every new batch is reduced to one row per line hash and merge-joined with the
runs: hashes that no run has (the anti-join) are new, their keeper is the
batch's largest doc_id; the others only add to the count.  The batch's rows
become a run of level 0; ``fanout`` runs of a level are merged into one of the
next, so a hash is rewritten a logarithmic number of times and a batch meets a
logarithmic number of runs.  Because runs and batch are bucketed alike, the
runs are never shuffled again.

At the end, the hashes held by ``min_docs`` documents or more lose their lines
in all documents but their keeper.

Cases: null or empty text is one empty line; a repeated ``doc_id`` counts as
one document; a null ``doc_id`` is one more document, the smallest; lines with
a key under ``min_chars`` stay; an empty table gives an empty result; all input
columns stay, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import sys
import uuid

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import scratch_path, staged_with_count
from .common import encoded, free_name, partitions, staged, table, texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPACE_BYTES = b" \t\n\x0b\x0c\r"
_NULL_ID = -(2**63)
#: Lines of a bucket, over all runs; more only where the shuffle partitions are fewer.
_BUCKET_LINES = 200_000


def line_key(line: bytes) -> bytes:
    """A line without spaces at its ends and with A-Z lower-cased (bytes.lower
    changes ASCII only)."""
    return line.strip(SPACE_BYTES).lower()


def key_hash(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "surrogatepass")) >= min_chars)


def line_hashes(docs: DataFrame, text: str, doc_id: str, min_chars: int) -> DataFrame:
    """(doc, key): the distinct long line hashes of each row."""

    def run(batches):
        for batch in batches:
            ids, owners, keys = batch.column(0), [], []
            for i, t in enumerate(texts(batch.column(1))):
                own = {k for line in encoded(t).split(b"\n") if long_enough(k := line_key(line), min_chars)}
                keys += [key_hash(k) for k in own]
                owners += [i] * len(own)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(owners, pa.int64())), pa.array(keys, pa.binary())], ["doc", "key"])

    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL_ID)).alias("doc"), F.col(text).alias("text")).mapInArrow(
        run, "doc long, key binary"
    )


class LineRuns:
    """Levelled sorted runs.  Rows: key, n (documents), keeper (set in the one
    run that saw the key first)."""

    def __init__(self, spark: SparkSession, fanout: int = 4, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or partitions(spark)
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def _write(self, rows: DataFrame) -> str:
        """``rows`` lie in buckets already, one to a task."""
        name = f"line_run_{uuid.uuid4().hex}"
        path = scratch_path(self.spark, "llm", name)
        rows.write.bucketBy(self.buckets, "key").sortBy("key").option("path", path).saveAsTable(name)
        self.paths[name] = path
        return name

    def _all(self) -> list[str]:
        return [t for level in self.levels for t in level]

    def ingest(self, batch: DataFrame) -> None:
        """Adds the (doc, key) rows of a batch whose documents all have
        smaller ids than those of earlier batches."""
        own = batch.groupBy("key").agg(F.countDistinct("doc").alias("n"), F.max("doc").alias("keeper")).repartition(self.buckets, "key")
        known = F.lit(False)
        for i, name in enumerate(self._all()):
            run = self.spark.table(name).filter("keeper IS NOT NULL").select("key", F.lit(True).alias(f"in_{i}"))
            own = own.join(run.hint("merge"), "key", "left")
            known = known | F.coalesce(F.col(f"in_{i}"), F.lit(False))
        self._add(own.select("key", "n", F.when(~known, F.col("keeper")).alias("keeper")), 0)

    def _add(self, rows: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(self._write(rows))
        if len(self.levels[level]) == self.fanout:
            full = self.levels[level]
            self.levels[level] = []
            self._add(self._merged(full).repartition(self.buckets, "key"), level + 1)
            for t in full:
                self.spark.sql(f"DROP TABLE {t}")

    def _merged(self, names: list[str]) -> DataFrame:
        # read as plain files: a union of bucketed scans claims one table's
        # partitioning but has the partitions of all
        rows = self.spark.read.schema("key binary, n long, keeper long").parquet(*[self.paths[t] for t in names])
        return rows.groupBy("key").agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper"))

    def frequent(self, min_docs: int) -> DataFrame:
        """(key, keeper) of the keys that ``min_docs`` documents hold."""
        return self._merged(self._all()).filter(F.col("n") >= min_docs).select("key", "keeper")

    def close(self) -> None:
        for level in self.levels:
            for t in level:
                self.spark.sql(f"DROP TABLE {t}")
        self.levels = []


def by_batch(pairs: DataFrame, batches: int) -> list[DataFrame]:
    """The (doc, key) rows cut at quantiles of ``doc``, largest docs first.
    They are written by batch, so that reading one is not a pass over all."""
    at = [i / batches for i in range(1, batches)]
    cuts = sorted(set(pairs.agg(F.percentile_approx("doc", at)).first()[0] or []), reverse=True) if at else []
    if not cuts:
        return [pairs]
    path = scratch_path(pairs.sparkSession, "llm", f"line-batches-{uuid.uuid4().hex}")
    number = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda cut: F.col("doc") <= cut))
    pairs.select("doc", "key", number.alias("batch")).write.partitionBy("batch").parquet(path)
    dealt = pairs.sparkSession.read.schema("doc long, key binary, batch int").parquet(path)
    return [dealt.filter(F.col("batch") == i).select("doc", "key") for i in range(len(cuts) + 1)]


def dedup_lines(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    min_chars: int = 20,
    min_docs: int = 3,
    batches: int | None = None,
    fanout: int = 4,
    batch_lines: int = 5_000_000,
) -> DataFrame:
    """``docs`` with ``text`` freed of frequent repeated lines, and n_lines
    (before) and n_dropped (long; underscores in front where the names are
    taken).  ``batches`` cuts the table at quantiles of ``doc_id``; any number
    gives the same result.  By default there are as many as make
    ``batch_lines`` lines each, and at least one more than ``fanout``."""
    spark = docs.sparkSession
    pairs, lines = staged_with_count(line_hashes(docs, text, doc_id, min_chars), "line-pairs")
    runs = LineRuns(spark, fanout, max(1, min(partitions(spark), math.ceil(lines / _BUCKET_LINES))))
    for batch in by_batch(pairs, batches or max(fanout + 1, math.ceil(lines / batch_lines))):
        runs.ingest(batch)
    frequent = staged(runs.frequent(min_docs), "line-frequent")
    runs.close()
    lost = staged(
        pairs.join(frequent, "key").filter(F.col("doc") != F.col("keeper")).groupBy("doc").agg(F.collect_set("key").alias("keys")),
        "line-lost",
    )
    keys, counts, drops = free_name(docs.columns, "keys"), free_name(docs.columns, "n_lines"), free_name(docs.columns, "n_dropped")
    doc, found = free_name(docs.columns, "doc"), lost.columns
    # merge-joined at every size, so that a small corpus runs like a large one
    joined = docs.withColumn(doc, F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL_ID))).join(
        lost.select(F.col(found[0]).alias(doc), F.col(found[1]).alias(keys)).hint("merge"), doc, "left"
    )
    joined = joined.select(*[F.col(f"`{c}`") for c in docs.columns], keys)
    at = docs.columns.index(text)

    def rebuild(arrow):
        for batch in arrow:
            new, total, dropped = [], [], []
            for t, gone in zip(texts(batch.column(at)), texts(batch.column(batch.num_columns - 1))):
                raw = encoded(t)
                n = raw.count(b"\n") + 1
                if gone:
                    gone = set(gone)
                    left = [x for x in raw.split(b"\n") if not (long_enough(k := line_key(x), min_chars) and key_hash(k) in gone)]
                    t = b"\n".join(left).decode("utf-8", "surrogatepass")
                    dropped.append(n - len(left))
                else:
                    dropped.append(0)
                total.append(n)
                new.append(t)
            columns = [pa.array(new, pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(total, pa.int64()), pa.array(dropped, pa.int64())], [*batch.schema.names[:-1], counts, drops]
            )

    schema = docs.withColumn(counts, F.lit(0).cast("long")).withColumn(drops, F.lit(0).cast("long")).schema
    return joined.mapInArrow(rebuild, schema)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    )


ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, u.line, u.pos FROM documents,
    LATERAL (SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos) u),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
frequent AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT keyed.*, frequent.k IS NOT NULL AND keyed.doc_id <> frequent.keeper AS gone
  FROM keyed LEFT JOIN frequent ON keyed.k = frequent.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
