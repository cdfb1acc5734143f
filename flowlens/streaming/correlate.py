"""Temporal correlation over an unbounded stream.

Each micro-batch runs the same skew-safe batch operator
(``operators.correlate.hit_counts``) over the retained *tail* plus the new
rows, so a hot destination is split by time buckets in the stream too and no
per-destination state ever sits in one task.

Two clocks.  The watermark is ``max(event time seen) - lateness_ms``, where
only times up to the present count: a row dated ahead of the processing clock
stays pending until the present has passed it and never moves the watermark,
neither past the present nor, in a backlog, past the rows still to come.  The
caller says what was seen, so sessions that are not candidates advance it as
well.  A row is final once the watermark passes it: every row that could precede
it inside its window has then arrived.  Final rows are emitted exactly once (the
batch in which the watermark passes them).  The tail keeps what later rows can
still need: rows not older than ``watermark - window`` (context) and rows not
yet final (pending).

Flush.  An idle source, or the end of input, is reported without touching the
watermark: rows that are pending and confirmed by what has arrived are emitted
as *early*.  Rows that come later, in time, still count and become final with
the rest, so a flush never loses anything.  More rows only raise counts, so what
was reported early stays confirmed; the set of early rows (the ledger) belongs
to its version, and rows that become final leave it.

Nothing is dropped silently: rows that arrive behind the watermark go to the
``late`` table; rows dated more than ``max_ahead_ms`` after the present go to
the ``ahead`` table instead of staying pending for long.

Durability.  The tail and the watermark of a version are written below
``state_dir``; versions are ``batch_id * 1000 + flush number`` and each reads
the newest one before it.  A retried batch rewrites its own outputs, so
replays after an executor or driver loss do not duplicate rows.  Two
generations are kept.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.correlate import hit_counts
from ..sources.files import child_names, delete_path, path_exists, read_text, write_text

_NO_WM = -(2**62)
_FLUSHES = 1000


@dataclass
class CorrelationState:
    """Where one correlation stream keeps its tail and watermark."""

    state_dir: str
    window_ms: int = S.CORRELATION_WINDOW_MS
    repeat_threshold: int = S.REPEAT_THRESHOLD
    lateness_ms: int = S.CORRELATION_WINDOW_MS
    max_ahead_ms: int = 3_600_000
    bucket_ms: int = 1000

    def tail_path(self, version: int) -> str:
        return f"{self.state_dir}/tail/version={version}"

    def mark_path(self, version: int) -> str:
        return f"{self.state_dir}/marks/{version}.json"

    def side_path(self, name: str, version: int) -> str:
        return f"{self.state_dir}/{name}/version={version}"

    def versions(self, spark: SparkSession) -> list[int]:
        """Committed versions (at most three are kept)."""
        names = child_names(spark, f"{self.state_dir}/marks")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def before(self, spark: SparkSession, version: int) -> dict:
        """The newest mark before ``version``."""
        older = [v for v in self.versions(spark) if v < version]
        if not older:
            return {"version": None, "watermark": _NO_WM, "max_seen": _NO_WM, "written_at": 0}
        return json.loads(read_text(spark, self.mark_path(older[-1])))


def batch_version(batch_id: int) -> int:
    return int(batch_id) * _FLUSHES


def row_stats(watermark: int, now_ms: int, st: CorrelationState) -> list[Column]:
    """Aggregates that ``correlate_rows`` needs of a batch: how many rows are
    late and ahead, and the largest time up to the present."""
    t = F.col("start_time")
    is_late = t <= F.lit(int(watermark))
    return [
        F.count_if(is_late).alias("late"),
        F.count_if(t > F.lit(int(now_ms) + int(st.max_ahead_ms))).alias("ahead"),
        F.max(F.when(~is_late & (t <= F.lit(int(now_ms))), t)).alias("top"),
    ]


@dataclass
class Correlated:
    """What one micro-batch confirmed: rows that are final now, rows that are
    still pending (``start_time`` after the watermark), and the watermark."""

    final: DataFrame
    pending: DataFrame
    watermark: int


def correlate_rows(
    spark: SparkSession,
    rows: DataFrame,
    version: int,
    st: CorrelationState,
    flush: bool = False,
    seen_ms: int | None = None,
    now_ms: int | None = None,
    stats: dict | None = None,
) -> Correlated:
    """Process one micro-batch of narrow rows (``session_id``, ``dst_ip``,
    ``start_time`` and any payload columns).  Returns the confirmed rows (with
    ``hit_count``); writes the new tail, the side tables and the version's mark,
    which remembers whether the version was a ``flush``.

    ``seen_ms``: the largest event time of everything the batch read, up to the
    present, when ``rows`` are only part of it.  ``stats``: the values of
    ``row_stats`` where the caller has observed them.  ``rows`` should be staged
    or persisted: one small aggregate, one write of the tail and the lazily
    returned correlation read them.
    """
    now_ms = int(time.time() * 1000) if now_ms is None else int(now_ms)
    prev = st.before(spark, version)
    prev_wm, prev_max = int(prev["watermark"]), int(prev["max_seen"])
    tail = None if prev["version"] is None else spark.read.schema(rows.schema).parquet(st.tail_path(prev["version"]))

    fresh = rows.filter(F.col("start_time").isNotNull())
    is_late = F.col("start_time") <= F.lit(prev_wm)
    is_ahead = F.col("start_time") > F.lit(now_ms + int(st.max_ahead_ms))
    present = F.col("start_time") <= F.lit(now_ms)
    if stats is None:
        stats = fresh.agg(*row_stats(prev_wm, now_ms, st)).collect()[0].asDict()
    seen = [t for t in (stats["top"], None if seen_ms is None else min(int(seen_ms), now_ms)) if t is not None]
    max_seen = max([prev_max, *seen])
    new_wm = prev_wm if max_seen == _NO_WM else max(prev_wm, max_seen - int(st.lateness_ms))
    for name, n, cond in (("late", stats["late"], is_late), ("ahead", stats["ahead"], is_ahead)):
        if n:
            fresh.filter(cond).write.mode("overwrite").parquet(st.side_path(name, version))

    # A retried batch re-reads the same tail and the same files, so the union
    # never holds a row twice.
    on_time = fresh.filter(~is_late & ~is_ahead)
    data = on_time if tail is None else tail.unionByName(on_time)

    counted = hit_counts(data, st.window_ms, bucket_ms=st.bucket_ms)
    confirmed = counted.filter((F.col("start_time") > F.lit(prev_wm)) & (F.col("hit_count") >= F.lit(int(st.repeat_threshold))))
    is_final = F.col("start_time") <= F.lit(new_wm)

    keep = data.filter(F.col("start_time") >= F.lit(new_wm - int(st.window_ms)))
    keep.write.mode("overwrite").parquet(st.tail_path(version))
    mark = {
        "version": int(version),
        "watermark": new_wm,
        "max_seen": max_seen,
        "late_rows": int(stats["late"] or 0),
        "ahead_rows": int(stats["ahead"] or 0),
        "flushed": bool(flush),
        "written_at": now_ms,
    }
    write_text(spark, st.mark_path(version), json.dumps(mark))
    for old in st.versions(spark):
        if prev["version"] is not None and old < prev["version"]:
            delete_path(spark, st.tail_path(old))
            delete_path(spark, st.mark_path(old))
    return Correlated(confirmed.filter(is_final), confirmed.filter(~is_final & present), new_wm)


def correlate_batch(
    spark: SparkSession,
    rows: DataFrame,
    version: int,
    st: CorrelationState,
    flush: bool = False,
    seen_ms: int | None = None,
    now_ms: int | None = None,
) -> DataFrame:
    """``correlate_rows``' final rows, with ``flush`` the pending ones, too."""
    out = correlate_rows(spark, rows, version, st, flush, seen_ms, now_ms)
    return out.final.unionByName(out.pending) if flush else out.final


def side_rows(spark: SparkSession, st: CorrelationState, name: str, schema) -> DataFrame:
    """The rows that came too late (``late``) or dated too far ahead
    (``ahead``), with the version that met them."""
    path = f"{st.state_dir}/{name}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema).withColumn("version", F.lit(0).cast("long"))
    return spark.read.schema(schema.add("version", "long") if "version" not in schema.fieldNames() else schema).parquet(path)


def flush_version(spark: SparkSession, st: CorrelationState) -> int | None:
    """The version of a flush after the last committed one (None before any)."""
    done = st.versions(spark)
    return done[-1] + 1 if done else None


def start_correlation(spark: SparkSession, hot: DataFrame, work_dir: str, trigger: str | None = None, **state_opts):
    """Run ``correlate_rows`` on a stream of narrow rows; final confirmed rows
    land in ``<work_dir>/confirmed/version=<n>`` (rewritten, never appended,
    when a batch is retried)."""
    st = CorrelationState(f"{work_dir}/state", **state_opts)

    def process(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.persist()
        try:
            version = batch_version(batch_id)
            out = correlate_rows(spark, batch_df, version, st).final
            out.write.mode("overwrite").parquet(f"{work_dir}/confirmed/version={version}")
        finally:
            batch_df.unpersist()

    writer = hot.writeStream.foreachBatch(process).option("checkpointLocation", f"{work_dir}/checkpoint")
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return writer.start()


def flush_correlation(spark: SparkSession, work_dir: str, now_ms: int | None = None, **state_opts) -> None:
    """Report every pending row that is confirmed, in
    ``<work_dir>/early/version=<n>``; the stream may go on as if nothing had
    happened."""
    st = CorrelationState(f"{work_dir}/state", **state_opts)
    version = flush_version(spark, st)
    if version is None:
        return
    schema = spark.read.parquet(st.tail_path(version - 1)).schema
    out = correlate_rows(spark, spark.createDataFrame([], schema), version, st, flush=True, now_ms=now_ms)
    out.final.write.mode("overwrite").parquet(f"{work_dir}/confirmed/version={version}")
    out.pending.write.mode("overwrite").parquet(f"{work_dir}/early/version={version}")


def confirmed_output(spark: SparkSession, work_dir: str, **state_opts) -> DataFrame:
    """Final confirmed rows, and those of the last flush that are not final yet
    (their ``hit_count`` is that of the flush)."""
    final = spark.read.parquet(f"{work_dir}/confirmed").drop("version")
    flushes = sorted(int(n[8:]) for n in child_names(spark, f"{work_dir}/early") if n.startswith("version="))
    st = CorrelationState(f"{work_dir}/state", **state_opts)
    done = st.versions(spark)
    if not flushes or not done:
        return final
    watermark = st.before(spark, done[-1] + 1)["watermark"]
    early = spark.read.schema(final.schema).parquet(f"{work_dir}/early/version={flushes[-1]}")
    return final.unionByName(early.filter(F.col("start_time") > F.lit(int(watermark))))
