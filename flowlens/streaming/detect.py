"""Structured Streaming entry points.

* ``stream_features``: file source with a checkpoint (each input file is
  consumed exactly once, optionally archived or deleted after commit) ->
  session features -> Parquet file sink.
* ``start_detection``: file source, then per micro-batch (``foreachBatch``)
  features, score, threshold, stream correlation with durable state, the 24 h
  event-time cool-down of every confirmed row in time order (within the batch
  and against the alert table), and an alert write keyed by writer and
  version (a retried batch replaces its own rows).  The 5-minute cadence of
  the original service loop is a processing-time trigger, or ``run_detection``
  called every five minutes.
* ``cooldown_stream``: the cool-down as a pure streaming operator
  (``dropDuplicatesWithinWatermark`` on the pair, 24 h event-time watermark);
  ``start_cooldown``: the exact rule, batch by batch.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schema as S
from ..config import staged
from ..operators.alerts import build_alerts, cooldown_alerts, utc_date
from ..operators.features import session_features
from ..operators.scoring import score_filter, score_sessions
from ..plans.detect import ALERT_INPUT
from ..plans.metrics import early_counts, observed_stream
from ..sources.alerts import read_alerts, write_alerts
from ..sources.commits import live_commits
from ..sources.files import path_exists, write_text
from ..sources.sessions import derived_session_id
from .files import read_file_stream, with_quarantine
from .correlate import CorrelationState, batch_version, correlate_rows, flush_version, row_stats

#: The alert table's writer name of the streaming detector.
STREAM_WRITER = "stream"
#: Ending of the writer name of alerts that a flush reports before the watermark
#: has passed them.
EARLY = "-early"


def read_session_stream(
    spark: SparkSession,
    input_dir: str,
    max_files_per_trigger: int | None = None,
    clean_source: str | None = None,
    archive_dir: str | None = None,
    skip_bad_files: bool = True,
) -> DataFrame:
    """A file stream of session Parquet files with the declared schema.

    ``clean_source`` is ``"archive"`` (move to ``archive_dir``) or
    ``"delete"``: files are removed from the input only after their batch has
    been committed, so a failed batch is retried from the same files.
    ``skip_bad_files``: an unreadable or mistyped file is left out instead of
    stopping the query (``sources.sessions.validate_files`` names such files).
    """
    reader = spark.readStream.schema(S.SESSION_WITH_KEYS).option("pathGlobFilter", "*.parquet")
    reader = reader.option("ignoreCorruptFiles", str(bool(skip_bad_files)).lower())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if clean_source == "archive":
            reader = reader.option("sourceArchiveDir", archive_dir)
    df = reader.parquet(input_dir)
    return df.withColumn(S.SESSION_ID, F.coalesce(F.col(S.SESSION_ID), derived_session_id()))


def _trigger(writer, trigger: str | None):
    if trigger is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def stream_features(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    checkpoint_dir: str,
    trigger: str | None = None,
    **source_opts,
) -> StreamingQuery:
    """Session features as a stream into a Parquet table (exactly-once file
    sink).  ``trigger=None`` processes what is available and stops.  Its
    progress carries the counts of ``plans.metrics.observed_stream``."""
    feats = session_features(observed_stream(read_session_stream(spark, input_dir, **source_opts)))
    writer = feats.writeStream.format("parquet").option("path", output_dir).option("checkpointLocation", checkpoint_dir)
    return _trigger(writer.outputMode("append"), trigger).start()


def last_alerts(history: DataFrame) -> DataFrame:
    """(src_ip, dst_ip, last_ms): each pair's latest alert."""
    return history.groupBy(
        F.col("match_body.network.src_ip").alias("src_ip"), F.col("match_body.network.dst_ip").alias("dst_ip")
    ).agg(F.unix_millis(F.max("alert_ts")).alias("last_ms"))


def detect_micro_batch(
    spark: SparkSession,
    hot: DataFrame,
    version: int,
    state: CorrelationState,
    alerts_dir: str,
    cooldown_minutes: int = S.ALERT_RETENTION_MINUTES,
    flush: bool = False,
    seen_ms: int | None = None,
    now_ms: int | None = None,
    writer: str = STREAM_WRITER,
    stats: dict | None = None,
) -> None:
    """One micro-batch of scored, above-threshold sessions -> alert rows.

    Every confirmed row is held against its pair's last alert in time order,
    within the batch and against the table, so the alerts do not depend on how
    rows fall into micro-batches.

    ``flush`` also reports pending rows, as early alerts (writer ``<writer>-early``).
    Each version's commit replaces the early alerts of the one before: those
    whose rows are final now are alerts in their own right or were overtaken by
    an earlier row of the pair; those still pending are carried.  Early alerts
    never suppress final ones, so the final alerts are the same with and without
    flushes, and the table as a whole is what a batch run over all input gives."""
    early = f"{writer}{EARLY}"
    hot.persist()
    try:
        prev_wm = int(state.before(spark, version)["watermark"])
        found = correlate_rows(spark, hot, version, state, flush, seen_ms, now_ms, stats)
        # All writers' alerts but this version's own: a retry never suppresses
        # its first attempt.  This batch only emits rows newer than the
        # previous watermark, so older history cannot matter: prune by date
        # partition and time.
        history = read_alerts(spark, alerts_dir)
        own = (F.col("writer") == F.lit(writer)) & (F.col("batch_id") >= F.lit(int(version)))
        past = history.filter(~(own | (F.col("writer") == F.lit(early))).eqNullSafe(F.lit(True)))
        if prev_wm > -(2**61):
            since = F.timestamp_millis(F.lit(prev_wm - int(cooldown_minutes) * 60_000))
            past = past.filter((F.col("alert_date") >= utc_date(since)) & (F.col("alert_ts") >= since))
        confirmed, keys = found.final, [(writer, version)]
        if flush:
            confirmed = confirmed.unionByName(found.pending)
        elif any(w == early for e in live_commits(spark, alerts_dir) for w, _ in e["keys"]):
            reported = history.filter((F.col("writer") == F.lit(early)) & (F.col("start_time") > F.lit(found.watermark)))
            confirmed = confirmed.unionByName(found.pending.join(reported.select(S.SESSION_ID).distinct(), S.SESSION_ID, "left_semi"))
            flush = True
        if flush:
            keys.append((early, version))
        chosen = cooldown_alerts(confirmed.drop("hit_count"), last_alerts(past), cooldown_minutes)
        whose = F.when(F.col("start_time") <= F.lit(found.watermark), F.lit(writer)).otherwise(F.lit(early))
        alerts = build_alerts(chosen, alert_ts=F.timestamp_millis(F.col("start_time")), batch_id=version, writer=whose)
        write_alerts(alerts, alerts_dir, keys=keys, instead_of=[early])
    finally:
        hot.unpersist()


def start_detection(
    spark: SparkSession,
    input_dir: str,
    work_dir: str,
    model=None,
    threshold: float = S.DEFAULT_THRESHOLD,
    window_ms: int = S.CORRELATION_WINDOW_MS,
    repeat_threshold: int = S.REPEAT_THRESHOLD,
    lateness_ms: int = S.CORRELATION_WINDOW_MS,
    max_ahead_ms: int = 3_600_000,
    cooldown_minutes: int = S.ALERT_RETENTION_MINUTES,
    trigger: str | None = "5 minutes",
    **source_opts,
) -> StreamingQuery:
    """The detector as a stream.  ``work_dir`` holds the checkpoint,
    the correlation state and the alert table (``<work_dir>/alerts``).  All
    sessions of a batch advance the watermark, not only those above the
    threshold.  Bad files are listed in ``<work_dir>/quarantine``
    (``streaming.files``).  ``source_opts``: those of ``read_file_stream``."""
    files = read_file_stream(spark, input_dir, **source_opts)
    state = CorrelationState(f"{work_dir}/state", window_ms, repeat_threshold, lateness_ms, max_ahead_ms)
    alerts_dir = f"{work_dir}/alerts"

    def process(listing: DataFrame, batch_id: int) -> None:
        # The files are read once: the narrow rows above the threshold are
        # staged, what all sessions say about time is observed on the way.
        now_ms, version = int(time.time() * 1000), batch_version(batch_id)
        started = F.col("session.start_time")
        watermark = state.before(spark, version)["watermark"]
        read = {}

        def stage(sessions: DataFrame) -> None:
            every, above = Observation(), Observation()
            seen = F.max(F.when(started <= F.lit(now_ms), started)).alias("seen")
            feats = session_features(sessions.observe(every, seen, *early_counts(threshold)[:2]))
            scored = score_sessions(feats, model) if model is not None else feats
            hot = score_filter(scored, threshold).select(*ALERT_INPUT)
            read["hot"] = staged(hot.observe(above, *row_stats(watermark, now_ms, state), F.count(F.lit(1)).alias("above_threshold")), "hot-sessions")
            read["seen"], read["stats"] = every.get["seen"], above.get
            read["counts"] = {n: int(every.get[n]) for n in ("sessions", "http")} | {"above_threshold": int(above.get["above_threshold"])}

        with_quarantine(spark, listing, version, f"{work_dir}/quarantine", stage)
        detect_micro_batch(
            spark, read["hot"], version, state, alerts_dir, cooldown_minutes, seen_ms=read["seen"], now_ms=now_ms, stats=read["stats"]
        )
        write_text(spark, f"{work_dir}/counts/{version}.json", json.dumps({"version": version, **read["counts"]}))

    writer = files.writeStream.foreachBatch(process).option("checkpointLocation", f"{work_dir}/checkpoint")
    return _trigger(writer, trigger).start()


def batch_counts(spark: SparkSession, work_dir: str) -> DataFrame:
    """(version, sessions, http, above_threshold) of each micro-batch,
    observed while it was read."""
    schema = "version long, sessions long, http long, above_threshold long"
    if not path_exists(spark, f"{work_dir}/counts"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{work_dir}/counts")


def flush_detection(
    spark: SparkSession, work_dir: str, cooldown_minutes: int = S.ALERT_RETENTION_MINUTES, now_ms: int | None = None, **state_opts
) -> None:
    """Report every pending row that is confirmed, as early alerts.  The stream
    may go on afterwards as if nothing had happened."""
    state = CorrelationState(f"{work_dir}/state", **state_opts)
    version = flush_version(spark, state)
    if version is None:
        return
    schema = spark.read.parquet(state.tail_path(version - 1)).schema
    empty = spark.createDataFrame([], schema)
    detect_micro_batch(spark, empty, version, state, f"{work_dir}/alerts", cooldown_minutes, flush=True, now_ms=now_ms)


def run_detection(spark: SparkSession, input_dir: str, work_dir: str, idle_ms: int = 300_000, now_ms: int | None = None, **options) -> bool:
    """One cycle of the service: process the files that are there, then, if
    nothing has arrived for ``idle_ms``, flush what is pending, so the last
    burst before a silence is reported.  Returns whether it flushed (once for
    each silence)."""
    start_detection(spark, input_dir, work_dir, trigger=None, **options).awaitTermination()
    names = ("window_ms", "repeat_threshold", "lateness_ms", "max_ahead_ms")
    state = CorrelationState(f"{work_dir}/state", **{k: options[k] for k in names if k in options})
    done = state.versions(spark)
    if not done:
        return False
    mark = state.before(spark, done[-1] + 1)
    now_ms = int(time.time() * 1000) if now_ms is None else now_ms
    if mark.get("flushed") or mark["watermark"] >= mark["max_seen"] or now_ms - mark["written_at"] < idle_ms:
        return False
    minutes = options.get("cooldown_minutes", S.ALERT_RETENTION_MINUTES)
    flush_detection(spark, work_dir, minutes, **{k: options[k] for k in names if k in options})
    return True


def cooldown_stream(confirmed: DataFrame, minutes: int = S.ALERT_RETENTION_MINUTES, event_time: Column | None = None) -> DataFrame:
    """One alert per pair per cool-down period on a stream of confirmed
    sessions, expiring by event time (not file age).

    Spark evicts a pair's state at the end of the first micro-batch whose
    watermark is past ``first alert + minutes``, so a re-alert can lag the
    exact expiry by up to one trigger interval."""
    ts = event_time if event_time is not None else F.timestamp_millis(F.col("start_time"))
    with_time = confirmed.withColumn("event_time", ts)
    return with_time.withWatermark("event_time", f"{int(minutes)} minutes").dropDuplicatesWithinWatermark(
        ["src_ip", "dst_ip"]
    )


def cooldown_output(spark: SparkSession, output_dir: str, schema) -> DataFrame:
    """What ``start_cooldown`` let through (no rows before the first batch)."""
    if not path_exists(spark, output_dir):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(output_dir).drop("version")


def start_cooldown(
    spark: SparkSession,
    confirmed: DataFrame,
    output_dir: str,
    checkpoint_location: str,
    minutes: int = S.ALERT_RETENTION_MINUTES,
    trigger: str | None = None,
) -> StreamingQuery:
    """R5, exactly: the cool-down of every confirmed row in time order, into a
    Parquet table with a folder per batch (rewritten when a batch is retried).

    Unlike ``cooldown_stream`` the result does not depend on when state is
    evicted.  What was let through before is the state: per batch the pairs'
    latest rows not older than the batch's first one less the cool-down."""
    schema = confirmed.schema

    def process(batch: DataFrame, batch_id: int) -> None:
        rows = staged(batch, "cooldown-batch")
        first = rows.agg(F.min("start_time").alias("m")).collect()[0]["m"]
        last = None
        if first is not None and path_exists(spark, output_dir):
            done = spark.read.schema(T.StructType([*schema.fields, T.StructField("version", T.LongType())])).parquet(output_dir)
            done = done.filter((F.col("version") < int(batch_id)) & (F.col("start_time") >= int(first) - int(minutes) * 60_000))
            last = done.groupBy("src_ip", "dst_ip").agg(F.max("start_time").alias("last_ms"))
        chosen = cooldown_alerts(rows, last, minutes)
        chosen.write.mode("overwrite").parquet(f"{output_dir}/version={int(batch_id)}")

    writer = confirmed.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_location)
    return _trigger(writer, trigger).start()
