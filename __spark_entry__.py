"""


Every query reads the driver's tables: the session records are the
``sessions`` stand-in view (FIXTURES.md) projected from ``events`` and
``pages``, and every operator then runs through the ``flowlens`` library.
"""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import uuid  # noqa: E402

from checks import sql as Q  # noqa: E402
from flowlens import schema as S  # noqa: E402
from flowlens.config import scratch_path, staged, staged_with_count  # noqa: E402
from flowlens.functions.text import bin_totals, present_bins, present_columns  # noqa: E402
from flowlens.operators import alerts as al  # noqa: E402
from flowlens.operators import features as feat  # noqa: E402
from flowlens.operators import matrix as mx  # noqa: E402
from flowlens.operators import text_features as tf  # noqa: E402
from flowlens.operators.scoring import score_filter  # noqa: E402
from flowlens.plans import detect as det  # noqa: E402
from flowlens.plans.metrics import stage_counts  # noqa: E402
from flowlens.sources import fixture  # noqa: E402
from flowlens.sources import sessions as src  # noqa: E402
from flowlens.sources.files import child_names  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"


def _optional(name: str):
    """The module, or None if it, or anything that it needs, cannot be
    imported."""
    try:
        return importlib.import_module(name)
    except ImportError:
        return None


_LLM = _optional("flowlens.llm.queries")
_PIPELINE = _optional("corpus_pipeline")

# Fixed instants used by the history-based checks (literals, so Spark and
# DuckDB see the same "now").  The alert history is what the detector itself
# emits for sessions before a cut-off; the batch under test comes after it.
HISTORY_CUT = "2024-01-02 12:00:00"
COOLDOWN_NOW = "2024-01-20 12:00:00"
EXPORT_MARKER = "2024-01-25 00:00:00"


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The stand-in records derive epoch milliseconds from a zone-less
    # timestamp; pin the session zone so both engines agree.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return fixture.session_records(spark, sf_dir)


def _staged(spark: SparkSession, sf_dir: str, split_by_port: bool = False) -> list[str]:
    """Write the stand-in records as session Parquet files (a fresh folder
    under the shared checkpoint folder) and return the source folder(s)."""
    base = scratch_path(spark, "flowlens-fixtures", uuid.uuid4().hex)
    recs = _sessions(spark, sf_dir)
    if not split_by_port:
        recs.write.parquet(f"{base}/sessions")
        return [f"{base}/sessions"]
    dirs = []
    for port in (80, 8080):
        d = f"{base}/sensor-{port}"
        recs.filter(F.col("transport.dst_port") == port).write.parquet(d)
        dirs.append(d)
    return dirs


def _flat_scan(df: DataFrame) -> DataFrame:
    """All leaves of scanned session records under the stand-in view's
    column names."""
    cols = [F.col(S.SESSION_ID)]
    cols += [F.col(f"network.{f.name}").alias(f.name) for f in S.NETWORK.fields]
    for f in S.TRANSPORT.fields:
        cols.append(F.col(f"transport.{f.name}").alias("transport_protocol" if f.name == "protocol" else f.name))
    for f in S.SESSION_STRUCT.fields:
        cols.append(F.col(f"session.{f.name}").alias("session_protocol" if f.name == "protocol" else f.name))
    cols += [F.col(f"payload.{f.name}").alias(f.name) for f in S.PAYLOAD.fields]
    cols.append(F.col(S.SCORE))
    return df.select(*cols)


def _confirmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return det.confirmed_sessions(_sessions(spark, sf_dir))


def _ms(ts: str):
    return F.unix_millis(F.to_timestamp(F.lit(ts)))


def _history_alerts(confirmed: DataFrame) -> DataFrame:
    """Alert rows as the detector emits them, stamped at the session's start."""
    return al.build_alerts(confirmed, alert_ts=F.timestamp_millis(F.col("start_time")))


def _alert_view(alerts: DataFrame) -> DataFrame:
    flat = al.flatten_alerts(alerts)
    return flat.withColumn("alert_ms", F.unix_millis("alert_ts")).drop("alert_ts")


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.session_features(_sessions(spark, sf_dir))


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------


def q_flow_features(spark, sf_dir):
    return feat.flow_features(feat.http_filter(_sessions(spark, sf_dir)))


def q_flag_features(spark, sf_dir):
    return feat.flag_features(feat.http_filter(_sessions(spark, sf_dir)))


def q_http_fields(spark, sf_dir):
    return feat.http_fields(feat.http_filter(_sessions(spark, sf_dir)))


def q_flatten_sessions(spark, sf_dir):
    return feat.flatten_sessions(_sessions(spark, sf_dir))


def q_http_filter(spark, sf_dir):
    kept = feat.http_filter(_sessions(spark, sf_dir))
    return kept.select(
        S.SESSION_ID,
        F.col("network.src_ip").alias("src_ip"),
        F.col("network.dst_ip").alias("dst_ip"),
        F.col("session.protocol").alias("session_protocol"),
    )


def q_content_length_stats(spark, sf_dir):
    return _features(spark, sf_dir).select(S.SESSION_ID, "http_content_length", *S.CONTENT_LENGTH_FEATURES)


def q_content_length_parse(spark, sf_dir):
    from flowlens.functions.arrays import empty_if_null, parse_content_length

    flat = feat.http_fields(feat.http_filter(_sessions(spark, sf_dir)))
    parsed = parse_content_length(F.col("http_content_length"))
    arr = empty_if_null(parsed)
    return flat.select(
        S.SESSION_ID,
        "http_content_length",
        parsed.isNotNull().alias("content_length_valid"),
        F.size(arr).alias("content_len_n"),
        F.size(F.filter(arr, lambda x: x.isNull())).alias("content_len_nulls"),
        F.try_element_at(arr, F.lit(1)).alias("content_len_first"),
    )


def q_empty_batch(spark, sf_dir):
    s = _sessions(spark, sf_dir)
    non_http = s.filter(~F.coalesce(F.lower(F.col("session.protocol")) == "http", F.lit(False)))
    return feat.session_features(non_http)


def q_scan_sessions(spark, sf_dir):
    return _flat_scan(src.scan_sessions(spark, *_staged(spark, sf_dir)))


def q_union_sources(spark, sf_dir):
    dirs = _staged(spark, sf_dir, split_by_port=True)
    return _flat_scan(src.union_sources(*[src.scan_sessions(spark, d) for d in dirs]))


def q_model_features(spark, sf_dir):
    return mx.model_features(_features(spark, sf_dir))


def q_impute_features(spark, sf_dir):
    imputed = mx.impute_features(_features(spark, sf_dir))
    return imputed.select(S.SESSION_ID, *S.NUMERIC_MODEL_FEATURES)


def q_score_filter(spark, sf_dir):
    hot = score_filter(_features(spark, sf_dir))
    return hot.select(S.SESSION_ID, "src_ip", "dst_ip", "start_time", S.SCORE)


def q_session_time(spark, sf_dir):
    f = feat.http_fields(feat.http_filter(_sessions(spark, sf_dir)))
    return f.select(
        S.SESSION_ID,
        "start_time",
        F.timestamp_millis("start_time").alias("event_time"),
        (F.col("start_time") / F.lit(1000.0)).alias("start_sec"),
    )


def q_text_flatten(spark, sf_dir):
    return tf.flatten_text_fields(_features(spark, sf_dir)).select(S.SESSION_ID, *S.TEXT_FIELDS)


def q_text_length(spark, sf_dir):
    out = tf.text_lengths(_features(spark, sf_dir))
    return out.select(S.SESSION_ID, *[f"{f}_len" for f in S.TEXT_FIELDS])


def q_text_entropy(spark, sf_dir):
    # log2 and the summation order differ between engines in the last bits,
    # so the comparison view rounds entropies to 9 decimals on both sides.
    out = tf.text_entropies(_features(spark, sf_dir))
    return out.select(S.SESSION_ID, *[F.round(f"{f}_entropy", 9).alias(f"{f}_entropy") for f in S.TEXT_FIELDS])


def q_unigram_long(spark, sf_dir):
    return tf.unigram_long(_features(spark, sf_dir))


def q_temporal_correlation(spark, sf_dir):
    return _confirmed(spark, sf_dir)


def q_first_alert_per_pair(spark, sf_dir):
    return al.first_alert_per_pair(_confirmed(spark, sf_dir).drop("hit_count"))


def q_malicious_summary(spark, sf_dir):
    return al.malicious_summary(_confirmed(spark, sf_dir))


def q_suppress_known(spark, sf_dir):
    confirmed = _confirmed(spark, sf_dir).drop("hit_count")
    cut = _ms(HISTORY_CUT)
    history = _history_alerts(confirmed.filter(F.col("start_time") < cut))
    batch = confirmed.filter(F.col("start_time") >= cut)
    return al.suppress_known(batch, history)


def q_alert_cooldown(spark, sf_dir):
    confirmed = _confirmed(spark, sf_dir).drop("hit_count")
    now = _ms(COOLDOWN_NOW)
    history = _history_alerts(confirmed.filter(F.col("start_time") < now))
    batch = confirmed.filter(F.col("start_time") >= now)
    return al.alert_cooldown(batch, history, COOLDOWN_NOW)


def q_build_alerts(spark, sf_dir):
    first = al.first_alert_per_pair(_confirmed(spark, sf_dir).drop("hit_count"))
    return _alert_view(_history_alerts(first))


def q_alert_retention(spark, sf_dir):
    confirmed = _confirmed(spark, sf_dir).drop("hit_count")
    return _alert_view(al.alert_retention(_history_alerts(confirmed), COOLDOWN_NOW))


def q_alert_export(spark, sf_dir):
    table = _history_alerts(_confirmed(spark, sf_dir).drop("hit_count"))
    return _alert_view(al.alert_export(table, EXPORT_MARKER))


def q_detect_alerts(spark, sf_dir):
    s = _sessions(spark, sf_dir)
    alerts = det.detect_alerts(s, alert_ts=F.timestamp_millis(F.col("start_time")))
    return _alert_view(alerts)


def q_stage_counts(spark, sf_dir):
    return stage_counts(_sessions(spark, sf_dir))


# ---- rows-only keys (no SQL oracle): ML, wide/array outputs, file sinks,
# ---- validation and streams.


def _labelled(features: DataFrame) -> DataFrame:
    """Training labels from a stated rule over the model's inputs: more
    packets sent than received.  They describe the stand-in records only, not
    detection quality."""
    return features.withColumn("label", (F.col("Total_Fwd_Packets") > F.col("Total_Backward_Packets")).cast("int"))


def _held_out():
    return F.pmod(F.xxhash64(S.SESSION_ID), F.lit(5)) == 0


_MODELS: dict = {}


def _forest(spark: SparkSession, sf_dir: str):
    """A forest fitted on four fifths of the stand-in sessions (fitted once
    per process), saved and loaded."""
    from flowlens.operators.scoring import load_model, train_forest

    key = (id(spark.sparkContext), sf_dir)
    if key not in _MODELS:
        rows = _labelled(_features(spark, sf_dir)).filter(~_held_out())
        model = train_forest(rows, num_trees=10, max_depth=5, feature_subset="onethird")
        path = scratch_path(spark, "flowlens-models", uuid.uuid4().hex)
        model.write().overwrite().save(path)
        _MODELS[key] = load_model(spark, path)
    return _MODELS[key]


def q_train_forest(spark, sf_dir):
    """All sessions scored: how many, how many scores are probabilities that
    agree with the prediction, and whether the rule was learnt, judged by the
    sessions that were held out."""
    from flowlens.operators.scoring import score_sessions

    scored = score_sessions(_labelled(_features(spark, sf_dir)), _forest(spark, sf_dir))
    agrees = F.col(S.SCORE).between(0, 1) & ((F.col(S.SCORE) > 0.5).cast("int") == F.col("prediction"))
    return scored.agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.count_if(agrees).alias("n_consistent"),
        (F.avg(F.when(_held_out(), (F.col("prediction") == F.col("label")).cast("double"))) > 0.9).alias("learnt"),
    )


def q_score_sessions(spark, sf_dir):
    """Every HTTP session scored once: its keys, and whether the score is a
    probability that agrees with the prediction."""
    from flowlens.operators.scoring import score_sessions

    scored = score_sessions(_features(spark, sf_dir), _forest(spark, sf_dir))
    agrees = F.col(S.SCORE).between(0, 1) & ((F.col(S.SCORE) > 0.5).cast("int") == F.col("prediction"))
    return scored.select(S.SESSION_ID, "src_ip", "dst_ip", "start_time", agrees.alias("consistent"))


def q_detect_with_model(spark, sf_dir):
    """Detection with the model's own scores: at least one alert, one per
    pair, every score above the threshold."""
    alerts = det.detect_alerts(_sessions(spark, sf_dir), model=_forest(spark, sf_dir))
    flat = staged(al.flatten_alerts(alerts), "model-alerts")
    return flat.agg(
        (F.count(F.lit(1)) > 0).alias("any_alert"),
        (F.count(F.lit(1)) == F.count_distinct(F.struct("src_ip", "dst_ip"))).alias("one_per_pair"),
        (F.min("score") > 0.8).alias("above_threshold"),
    )


def q_assemble_features(spark, sf_dir):
    """Width, the sum of the 57 scalar inputs, and the bytes values present."""
    from pyspark.ml.functions import vector_to_array

    vec = mx.assemble_features(_features(spark, sf_dir)).select(S.SESSION_ID, vector_to_array("features").alias("v"))
    n = len(mx.SCALAR_MODEL_INPUTS)
    return vec.select(
        S.SESSION_ID,
        F.size("v").alias("width"),
        F.round(F.aggregate(F.slice("v", 1, n), F.lit(0.0), lambda a, x: a + x), 4).alias("scalar_total"),
        F.size(F.filter(F.slice("v", n + 1, mx.MODEL_WIDTH), lambda x: x > 0)).alias("n_bins"),
    )


def _unigram_digest(spark, sf_dir, cells) -> DataFrame:
    """(session_id, field, n_bins, n_bytes, moment): the byte counts that a
    vector of frequencies stands for, as whole numbers.  ``cells`` has each
    field's frequencies above zero (``present_bins``, about a twentieth), which
    are joined with the texts' lengths."""
    texts = tf.flatten_text_fields(_features(spark, sf_dir)).select(
        F.col(S.SESSION_ID).alias("t_id"), *[F.octet_length(f).cast("bigint").alias(f"{f}_n") for f in S.TEXT_FIELDS]
    )
    rows = cells.join(texts, F.col(S.SESSION_ID) == F.col("t_id"))
    per_field = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}_v").alias("v"), F.col(f"{f}_n").alias("n_bytes")) for f in S.TEXT_FIELDS])
    counted = rows.select(S.SESSION_ID, F.inline(per_field)).withColumn("c", bin_totals("v", "n_bytes"))
    return counted.select(S.SESSION_ID, "field", "c.n_bins", "c.n_bytes", "c.moment")


def q_unigram_vector(spark, sf_dir):
    out = tf.unigram_vectors(_features(spark, sf_dir))
    return _unigram_digest(spark, sf_dir, out.select(S.SESSION_ID, *[present_bins(F.col(f"{f}_unigram")).alias(f"{f}_v") for f in S.TEXT_FIELDS]))


def q_unigram_wide(spark, sf_dir):
    wide = tf.unigram_wide(_features(spark, sf_dir))
    return _unigram_digest(spark, sf_dir, present_columns(wide, S.SESSION_ID, S.TEXT_FIELDS))


def _good_and_bad_files(spark, sf_dir, good_dir: str, bad_dirs: tuple[str, str]) -> None:
    """The records as files, as many as their scan has tasks, and once more as
    two files whose start_time arrives as text (a producer bug).  Each of the
    two is written from half of the good files, whose packed columns are a sixth
    of the rows that a shuffle would bring to the same task."""
    _sessions(spark, sf_dir).write.parquet(good_dir)
    names = sorted(n for n in child_names(spark, good_dir) if n.endswith(".parquet"))
    read = spark.read.schema(S.SESSION_WITH_KEYS).parquet

    def write(recs: DataFrame, path: str) -> None:
        text = F.col("session").withField("start_time", F.col("session.start_time").cast("string"))
        recs.withColumn("session", text).write.parquet(path)

    if len(names) == 1:
        return write(read(good_dir).repartition(2), bad_dirs[0])
    half = len(names) // 2
    halves = [read(*[f"{good_dir}/{n}" for n in part]).coalesce(1) for part in (names[:half], names[half:])]
    with ThreadPoolExecutor(2) as both:  # two jobs of one task each
        list(both.map(write, halves, bad_dirs))


def q_quarantine(spark, sf_dir):
    """Per reason the number of quarantined files, with the rows read."""
    base = scratch_path(spark, "flowlens-fixtures", uuid.uuid4().hex)
    _good_and_bad_files(spark, sf_dir, f"{base}/in", (f"{base}/in/bad files", f"{base}/in/more bad files"))
    good, report = src.read_valid_sessions(spark, f"{base}/in")
    read = good.agg(F.count(F.lit(1)).alias("rows_read"), F.countDistinct(S.SESSION_ID).alias("sessions_read"))
    return report.groupBy("reason").agg(F.count(F.lit(1)).alias("n_files")).join(F.broadcast(read))


def _alert_table(spark, sf_dir) -> str:
    from flowlens.sources.alerts import write_alerts

    path = scratch_path(spark, "flowlens-alerts", uuid.uuid4().hex)
    first = al.first_alert_per_pair(_confirmed(spark, sf_dir).drop("hit_count"))
    alerts = al.build_alerts(first, alert_ts=F.timestamp_millis(F.col("start_time")), batch_id=0)
    write_alerts(alerts, path)
    write_alerts(alerts, path)  # a retried batch replaces its own rows
    return path


def q_write_alerts(spark, sf_dir):
    from flowlens.sources.alerts import read_alerts

    return _alert_view(read_alerts(spark, _alert_table(spark, sf_dir)))


def q_alert_history(spark, sf_dir):
    from flowlens.sources.alerts import alert_history, read_alerts

    hist = alert_history(read_alerts(spark, _alert_table(spark, sf_dir)))
    return hist.select("src_ip", "dst_ip", F.unix_millis("alert_ts").alias("alert_ms"))


def q_training_set(spark, sf_dir):
    from flowlens.sources.alerts import append_training_set

    path = scratch_path(spark, "flowlens-training", uuid.uuid4().hex)
    append_training_set(_features(spark, sf_dir), path, batch_id=0)
    append_training_set(_features(spark, sf_dir), path, batch_id=0)  # a re-run replaces, never duplicates
    return spark.read.parquet(path)


#: Rows in a staged stream file, about: a task writes or reads one file.
CHUNK_FILE_ROWS = 250_000


def _time_chunks(spark, df: DataFrame, time_col, base: str, chunks: int = 6, files: int = 2) -> tuple[str, int]:
    """Stage ``df`` as ``chunks`` folders of files in event-time order (written
    one after another, so file modification order follows time): (folder,
    files per chunk).  A chunk has ``files`` files, or more where they would
    hold more than about ``CHUNK_FILE_ROWS`` rows.  The input is staged first so
    its lineage runs once, not once per chunk."""
    df, count = staged_with_count(df, "chunks")
    files = max(files, -(-count // (chunks * CHUNK_FILE_ROWS)))
    bounds = df.agg(F.min(time_col).alias("lo"), F.max(time_col).alias("hi")).collect()[0]
    lo, hi = int(bounds["lo"]), int(bounds["hi"])
    step = (hi - lo) // chunks + 1
    for i in range(chunks):
        part = df.filter((time_col >= F.lit(lo + i * step)) & (time_col < F.lit(lo + (i + 1) * step)))
        part.repartition(files).write.parquet(f"{base}/in/chunk={i:03d}")
    return f"{base}/in", files


def q_stream_features(spark, sf_dir):
    from flowlens.streaming.detect import stream_features

    base = scratch_path(spark, "flowlens-stream", uuid.uuid4().hex)
    src_dir, files = _time_chunks(spark, _sessions(spark, sf_dir), F.col("session.start_time"), base)
    q = stream_features(
        spark, src_dir, f"{base}/out", f"{base}/ckpt", clean_source="archive", archive_dir=f"{base}/archive"
    )
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


def q_stream_correlation(spark, sf_dir):
    from flowlens.streaming.correlate import confirmed_output, flush_correlation, start_correlation

    base = scratch_path(spark, "flowlens-stream", uuid.uuid4().hex)
    hot = score_filter(_features(spark, sf_dir)).select(*det.ALERT_INPUT)
    src_dir, files = _time_chunks(spark, hot, F.col("start_time"), base)
    stream = spark.readStream.schema(hot.schema).option("maxFilesPerTrigger", files).parquet(src_dir)
    stream = stream.select(*hot.columns)  # drop the staging folders' partition column
    start_correlation(spark, stream, f"{base}/work").awaitTermination()
    flush_correlation(spark, f"{base}/work")
    return confirmed_output(spark, f"{base}/work")


def q_stream_alerts(spark, sf_dir):
    from flowlens.sources.alerts import read_alerts
    from flowlens.streaming.detect import flush_detection, start_detection

    base = scratch_path(spark, "flowlens-stream", uuid.uuid4().hex)
    src_dir, files = _time_chunks(spark, _sessions(spark, sf_dir), F.col("session.start_time"), base)
    q = start_detection(spark, src_dir, f"{base}/work", trigger=None, max_files_per_trigger=files)
    q.awaitTermination()
    flush_detection(spark, f"{base}/work")
    return _alert_view(read_alerts(spark, f"{base}/work/alerts"))


def q_alert_json_sink(spark, sf_dir):
    """Alerts written as JSON lines (twice: a retry replaces itself) and read
    back as history with their own alert time."""
    from flowlens.sources.alerts import read_alert_documents, write_alerts_json

    path = scratch_path(spark, "flowlens-alerts", uuid.uuid4().hex)
    first = al.first_alert_per_pair(_confirmed(spark, sf_dir).drop("hit_count"))
    alerts = al.build_alerts(first, alert_ts=F.timestamp_millis(F.col("start_time")), batch_id=0)
    write_alerts_json(alerts, path)
    write_alerts_json(alerts, path)
    back = read_alert_documents(spark, path, lines=True)
    return al.flatten_alerts(back).withColumn("alert_ms", F.unix_millis("alert_ts")).drop("alert_ts")


def q_alert_drop(spark, sf_dir):
    """The alert table after its expired date partitions were removed."""
    import datetime as dt

    from flowlens.sources.alerts import drop_old_alerts, read_alerts

    path = _alert_table(spark, sf_dir)
    drop_old_alerts(spark, path, dt.datetime.fromisoformat(HISTORY_CUT), minutes=60)
    return _alert_view(read_alerts(spark, path))


def q_alert_export_stream(spark, sf_dir):
    """The alert table exported by a stream in two runs; the second finds
    nothing new."""
    from flowlens.sources.alerts import export_alerts, read_alert_documents

    path = _alert_table(spark, sf_dir)
    base = scratch_path(spark, "flowlens-stream", uuid.uuid4().hex)
    for _ in range(2):
        export_alerts(spark, path, f"{base}/out", f"{base}/ckpt").awaitTermination()
    back = read_alert_documents(spark, f"{base}/out", lines=True)
    return al.flatten_alerts(back).withColumn("alert_ms", F.unix_millis("alert_ts")).drop("alert_ts")


def q_stream_cooldown(spark, sf_dir):
    from flowlens.streaming.detect import cooldown_output, start_cooldown

    base = scratch_path(spark, "flowlens-stream", uuid.uuid4().hex)
    confirmed = _confirmed(spark, sf_dir).drop("hit_count")
    src_dir, files = _time_chunks(spark, confirmed, F.col("start_time"), base)
    stream = spark.readStream.schema(confirmed.schema).option("maxFilesPerTrigger", files).parquet(src_dir)
    stream = stream.select(*confirmed.columns)
    start_cooldown(spark, stream, f"{base}/out", f"{base}/ckpt").awaitTermination()
    return cooldown_output(spark, f"{base}/out", confirmed.schema)


def q_stream_correlation_keyed(spark, sf_dir):
    """The correlation as keyed state with timers; a closing row moves the
    watermark past the last session."""
    from flowlens.streaming.keyed import keyed_correlation

    base = scratch_path(spark, "flowlens-stream", uuid.uuid4().hex)
    hot = staged(score_filter(_features(spark, sf_dir)).select(*det.ALERT_INPUT), "hot")
    src_dir, files = _time_chunks(spark, hot, F.col("start_time"), base)
    last = hot.agg((F.max("start_time") + 7_200_000).alias("start_time"), F.lit("closing").alias("dst_ip"))
    last.join(hot.drop("start_time", "dst_ip").limit(1)).select(*hot.columns).write.parquet(f"{src_dir}/chunk=999")
    stream = spark.readStream.schema(hot.schema).option("maxFilesPerTrigger", 2 * files).parquet(src_dir).select(*hot.columns)
    q = keyed_correlation(stream).writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ck")
    q.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out")


def q_stream_quarantine(spark, sf_dir):
    """Per reason the number of files that a stream has left out, with the rows
    of the others."""
    from flowlens.streaming.files import quarantined_files, read_file_stream, with_quarantine

    base = scratch_path(spark, "flowlens-stream", uuid.uuid4().hex)
    _good_and_bad_files(spark, sf_dir, f"{base}/in/chunk=0", (f"{base}/in/chunk=1", f"{base}/in/chunk=2"))

    def process(listing, batch_id):
        write = lambda rows: rows.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")
        with_quarantine(spark, listing, batch_id, f"{base}/quarantine", write)

    files = read_file_stream(spark, f"{base}/in", max_files_per_trigger=2)
    files.writeStream.foreachBatch(process).option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start().awaitTermination()
    read = spark.read.parquet(f"{base}/out").agg(F.count(F.lit(1)).alias("rows_read"), F.countDistinct(S.SESSION_ID).alias("sessions_read"))
    return quarantined_files(spark, f"{base}/quarantine").groupBy("reason").agg(F.count(F.lit(1)).alias("n_files")).join(F.broadcast(read))


def q_claimed_runs(spark, sf_dir):
    """The sessions of batch runs that claim their files: a run that fails,
    then runs of at most four files until none is left."""
    from flowlens.sources.claims import claim_files, claimed_sessions

    base = scratch_path(spark, "flowlens-fixtures", uuid.uuid4().hex)
    recs, count = staged_with_count(_sessions(spark, sf_dir), "claimed")
    files = max(6, -(-count // 1_000_000))
    recs.repartition(files).write.parquet(f"{base}/in")
    claim_files(spark, f"{base}/in", f"{base}/ledger").release()
    for run in range(-(-files // 4) + 1):
        with claimed_sessions(spark, f"{base}/in", f"{base}/ledger", max_files=4) as rows:
            rows.write.parquet(f"{base}/out/run={run}")
    return _flat_scan(spark.read.schema(S.SESSION_WITH_KEYS).parquet(f"{base}/out"))


def q_pipeline_assembly(spark, sf_dir):
    """The vector that a saved and loaded pipeline makes of flat features."""
    from pyspark.ml.functions import vector_to_array

    from flowlens.operators.assembler import detector_pipeline
    from flowlens.operators.scoring import load_model

    path = scratch_path(spark, "flowlens-models", uuid.uuid4().hex)
    detector_pipeline(_forest(spark, sf_dir)).write().overwrite().save(path)
    out = load_model(spark, path).transform(_features(spark, sf_dir)).select(S.SESSION_ID, vector_to_array("features").alias("v"))
    n = len(mx.SCALAR_MODEL_INPUTS)
    return out.select(
        S.SESSION_ID,
        F.size("v").alias("width"),
        F.round(F.aggregate(F.slice("v", 1, n), F.lit(0.0), lambda a, x: a + x), 4).alias("scalar_total"),
        F.size(F.filter(F.slice("v", n + 1, mx.MODEL_WIDTH), lambda x: x > 0)).alias("n_bins"),
    )


def q_suppress_known_filtered(spark, sf_dir):
    """``suppress_known`` with the bit map before the join."""
    confirmed = staged(_confirmed(spark, sf_dir).drop("hit_count"), "confirmed")
    cut = _ms(HISTORY_CUT)
    history = _history_alerts(confirmed.filter(F.col("start_time") < cut))
    return al.suppress_known(confirmed.filter(F.col("start_time") >= cut), history, filter_bits=20)


def q_stream_stage_counts(spark, sf_dir):
    """The early stage counts of all micro-batches of a feature stream, from
    the progress of the query."""
    from flowlens.streaming.detect import stream_features

    base = scratch_path(spark, "flowlens-stream", uuid.uuid4().hex)
    src_dir, files = _time_chunks(spark, _sessions(spark, sf_dir), F.col("session.start_time"), base, chunks=3)
    q = stream_features(spark, src_dir, f"{base}/out", f"{base}/ckpt", max_files_per_trigger=files)
    q.awaitTermination()
    seen = [p.observedMetrics["stage_counts"].asDict() for p in q.recentProgress if p.numInputRows]
    rows = [(stage, sum(b[stage] for b in seen)) for stage in ("sessions", "http", "above_threshold")]
    return spark.createDataFrame(rows, "stage string, n_rows bigint")


def q_alert_compaction(spark, sf_dir):
    """The alert table, written in several commits, one of them twice, and
    compacted."""
    from flowlens.sources.alerts import compact_alerts, read_alerts, write_alerts

    path = scratch_path(spark, "flowlens-alerts", uuid.uuid4().hex)
    first = staged(al.first_alert_per_pair(_confirmed(spark, sf_dir).drop("hit_count")), "first")
    for part in (0, 1, 2, 1):
        rows = first.filter(F.pmod(F.xxhash64(S.SESSION_ID), F.lit(3)) == part)
        write_alerts(al.build_alerts(rows, alert_ts=F.timestamp_millis(F.col("start_time")), batch_id=part), path, keys=[("batch", part)])
    compact_alerts(spark, path, grace_minutes=0)
    return _alert_view(read_alerts(spark, path))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "train_forest": q_train_forest,
    "score_sessions": q_score_sessions,
    "detect_with_model": q_detect_with_model,
    "assemble_features": q_assemble_features,
    "unigram_vector": q_unigram_vector,
    "unigram_wide": q_unigram_wide,
    "quarantine": q_quarantine,
    "write_alerts": q_write_alerts,
    "alert_history": q_alert_history,
    "alert_json_sink": q_alert_json_sink,
    "alert_drop": q_alert_drop,
    "alert_export_stream": q_alert_export_stream,
    "training_set": q_training_set,
    "stream_features": q_stream_features,
    "stream_correlation": q_stream_correlation,
    "stream_alerts": q_stream_alerts,
    "stream_cooldown": q_stream_cooldown,
    "stream_correlation_keyed": q_stream_correlation_keyed,
    "stream_quarantine": q_stream_quarantine,
    "stream_stage_counts": q_stream_stage_counts,
    "claimed_runs": q_claimed_runs,
    "pipeline_assembly": q_pipeline_assembly,
    "suppress_known_filtered": q_suppress_known_filtered,
    "alert_compaction": q_alert_compaction,
    "scan_sessions": q_scan_sessions,
    "union_sources": q_union_sources,
    "model_features": q_model_features,
    "impute_features": q_impute_features,
    "score_filter": q_score_filter,
    "session_time": q_session_time,
    "text_flatten": q_text_flatten,
    "text_length": q_text_length,
    "text_entropy": q_text_entropy,
    "unigram_long": q_unigram_long,
    "temporal_correlation": q_temporal_correlation,
    "first_alert_per_pair": q_first_alert_per_pair,
    "malicious_summary": q_malicious_summary,
    "suppress_known": q_suppress_known,
    "alert_cooldown": q_alert_cooldown,
    "build_alerts": q_build_alerts,
    "alert_retention": q_alert_retention,
    "alert_export": q_alert_export,
    "detect_alerts": q_detect_alerts,
    "stage_counts": q_stage_counts,
    "flow_features": q_flow_features,
    "flag_features": q_flag_features,
    "http_fields": q_http_fields,
    "flatten_sessions": q_flatten_sessions,
    "http_filter": q_http_filter,
    "content_length_stats": q_content_length_stats,
    "content_length_parse": q_content_length_parse,
    "empty_batch": q_empty_batch,
}


# --------------------------------------------------------------------------
# DuckDB side
# --------------------------------------------------------------------------


def _oracles() -> dict[str, str]:
    idscore = "session_id, malicious_score, "
    http = f"FROM sessions WHERE {Q.HTTP_WHERE}"
    out = {
        "flow_features": Q.with_sessions(f"SELECT {idscore}{Q.select_list(Q.flow_exprs())} {http}"),
        "flag_features": Q.with_sessions(
            f"SELECT {idscore}src_ip, dst_ip, {Q.select_list(Q.flag_exprs())} {http}"
        ),
        "http_fields": Q.with_sessions(f"SELECT {idscore}{Q.select_list(Q.http_exprs())} {http}"),
        "flatten_sessions": Q.with_sessions(
            f"SELECT {idscore}{Q.select_list(Q.flow_exprs() + Q.flag_exprs() + Q.http_exprs())} FROM sessions"
        ),
        "http_filter": Q.with_sessions(f"SELECT session_id, src_ip, dst_ip, session_protocol {http}"),
        "content_length_stats": Q.with_sessions(
            "SELECT session_id, http_content_length, " + ", ".join(Q.NUMERIC[41:]) + " FROM feat",
            Q.feature_cte(),
        ),
        "content_length_parse": Q.with_sessions(
            "SELECT session_id, http_content_length, "
            "(CASE WHEN http_content_length LIKE '%\"%' THEN NULL ELSE TRY_CAST(http_content_length AS DOUBLE[]) END) IS NOT NULL AS content_length_valid, "
            "CAST(len(cl_arr) AS INTEGER) AS content_len_n, "
            "CAST(len(list_filter(cl_arr, lambda x: x IS NULL)) AS INTEGER) AS content_len_nulls, "
            "cl_arr[1] AS content_len_first "
            f"FROM (SELECT *, {Q.PARSED} AS cl_arr {http})"
        ),
        "empty_batch": Q.with_sessions(
            "SELECT * FROM feat",
            f"batch AS (SELECT * FROM sessions WHERE NOT COALESCE({Q.HTTP_WHERE}, false)),\n"
            + Q.feature_cte("batch"),
        ),
    }
    feat_cte = Q.feature_cte()
    conf = Q.confirmed_cte()
    scan_sql = Q.with_sessions("SELECT * REPLACE (CAST(dst_port AS BIGINT) AS dst_port) FROM sessions")
    flat_fields = ", ".join(f"COALESCE({f}, '') AS {f}" for f in Q.TEXT)
    feat_body = "SELECT * FROM feat"
    out.update(
        {
            "write_alerts": Q.with_sessions(Q.alert_view("first_pair"), conf + ",\n" + Q.first_cte()),
            "alert_history": Q.with_sessions(
                "SELECT src_ip, dst_ip, max(start_time) AS alert_ms FROM first_pair GROUP BY src_ip, dst_ip",
                conf + ",\n" + Q.first_cte(),
            ),
            "training_set": Q.with_sessions("SELECT *, CAST(0 AS INTEGER) AS batch_id FROM feat", feat_cte),
            "stream_features": Q.with_sessions(feat_body, feat_cte),
            "stream_correlation": Q.with_sessions("SELECT * FROM confirmed", conf),
            "scan_sessions": scan_sql,
            "union_sources": scan_sql,
            "model_features": Q.with_sessions(
                "SELECT session_id, malicious_score, " + ", ".join(Q.NUMERIC[:41] + Q.TEXT + Q.NUMERIC[41:]) + " FROM feat", feat_cte
            ),
            "impute_features": Q.with_sessions(
                "SELECT session_id, "
                + ", ".join(f"{Q.impute_sql(c)} AS {c}" for c in Q.NUMERIC)
                + " FROM feat",
                feat_cte,
            ),
            "score_filter": Q.with_sessions(
                "SELECT session_id, src_ip, dst_ip, start_time, malicious_score FROM feat "
                f"WHERE malicious_score > CAST(0.8 AS DOUBLE)",
                feat_cte,
            ),
            "session_time": Q.with_sessions(
                "SELECT session_id, start_time, epoch_ms(start_time) AS event_time, "
                f"start_time / CAST(1000 AS DOUBLE) AS start_sec {http}"
            ),
            "text_flatten": Q.with_sessions(f"SELECT session_id, {flat_fields} FROM feat", feat_cte),
            "text_length": Q.with_sessions(
                "SELECT session_id, "
                + ", ".join(f"CAST(length(COALESCE({f}, '')) AS INTEGER) AS {f}_len" for f in Q.TEXT)
                + " FROM feat",
                feat_cte,
            ),
            "text_entropy": Q.with_sessions(
                "SELECT session_id, "
                + ", ".join(f"round({Q.entropy_sql(Q.coalesce_empty(f))}, 9) AS {f}_entropy" for f in Q.TEXT)
                + " FROM feat",
                feat_cte,
            ),
            "unigram_long": Q.with_sessions(Q.unigram_long_sql(Q.TEXT), feat_cte),
            "temporal_correlation": Q.with_sessions("SELECT * FROM confirmed", conf),
            "first_alert_per_pair": Q.with_sessions("SELECT * FROM first_pair", conf + ",\n" + Q.first_cte()),
            "malicious_summary": Q.with_sessions("SELECT src_ip, dst_ip, malicious_score FROM confirmed", conf),
            "suppress_known": Q.with_sessions(
                "SELECT * EXCLUDE (hit_count) FROM confirmed b "
                f"WHERE b.start_time >= {Q.ms(HISTORY_CUT)} AND NOT EXISTS (SELECT 1 FROM confirmed h "
                f"WHERE h.start_time < {Q.ms(HISTORY_CUT)} "
                "AND h.src_ip IS NOT DISTINCT FROM b.src_ip AND h.dst_ip IS NOT DISTINCT FROM b.dst_ip)",
                conf,
            ),
            "alert_cooldown": Q.with_sessions(
                "SELECT * EXCLUDE (hit_count) FROM confirmed b "
                f"WHERE b.start_time >= {Q.ms(COOLDOWN_NOW)} AND NOT EXISTS (SELECT 1 FROM confirmed h "
                f"WHERE h.start_time < {Q.ms(COOLDOWN_NOW)} "
                f"AND h.start_time >= {Q.ms(COOLDOWN_NOW)} - 1440 * 60000 "
                "AND h.src_ip IS NOT DISTINCT FROM b.src_ip AND h.dst_ip IS NOT DISTINCT FROM b.dst_ip)",
                conf,
            ),
            "build_alerts": Q.with_sessions(Q.alert_view("first_pair"), conf + ",\n" + Q.first_cte()),
            "alert_retention": Q.with_sessions(
                Q.alert_view(
                    f"(SELECT * FROM confirmed WHERE start_time >= {Q.ms(COOLDOWN_NOW)} - 1440 * 60000)"
                ),
                conf,
            ),
            "alert_export": Q.with_sessions(
                Q.alert_view(f"(SELECT * FROM confirmed WHERE start_time > {Q.ms(EXPORT_MARKER)})"), conf
            ),
            "detect_alerts": Q.with_sessions(Q.alert_view("first_pair"), conf + ",\n" + Q.first_cte()),
            "stream_alerts": Q.with_sessions(Q.alert_view("alerting"), conf + ",\n" + Q.cooldown_cte(), recursive=True),
            "stream_cooldown": Q.with_sessions("SELECT * EXCLUDE (rn, next_rn) FROM alerting", conf + ",\n" + Q.cooldown_cte(), recursive=True),
            "alert_json_sink": Q.with_sessions(Q.document_view("first_pair"), conf + ",\n" + Q.first_cte()),
            "alert_export_stream": Q.with_sessions(Q.document_view("first_pair"), conf + ",\n" + Q.first_cte()),
            "alert_drop": Q.with_sessions(
                Q.alert_view("(SELECT * FROM first_pair WHERE start_time >= epoch_ms(TIMESTAMP '2024-01-02 00:00:00'))"),
                conf + ",\n" + Q.first_cte(),
            ),
            "unigram_vector": Q.with_sessions(Q.unigram_digest_sql(), feat_cte),
            "unigram_wide": Q.with_sessions(Q.unigram_digest_sql(), feat_cte),
            "assemble_features": Q.with_sessions(Q.assembled_sql(), feat_cte),
            "train_forest": Q.with_sessions("SELECT count(*) AS n_scored, count(*) AS n_consistent, TRUE AS learnt FROM feat", feat_cte),
            "score_sessions": Q.with_sessions("SELECT session_id, src_ip, dst_ip, start_time, TRUE AS consistent FROM feat", feat_cte),
            "detect_with_model": "SELECT TRUE AS any_alert, TRUE AS one_per_pair, TRUE AS above_threshold",
            "quarantine": Q.with_sessions(
                "SELECT 'session.start_time: string != bigint' AS reason, CAST(2 AS BIGINT) AS n_files, count(*) AS rows_read, "
                "count(DISTINCT session_id) AS sessions_read FROM sessions"
            ),
            "stage_counts": Q.with_sessions(
                f"SELECT 'sessions' AS stage, count(*) AS n_rows FROM sessions UNION ALL "
                f"SELECT 'http', count(*) FILTER (WHERE {Q.HTTP_WHERE}) FROM sessions UNION ALL "
                f"SELECT 'above_threshold', count(*) FILTER (WHERE {Q.HTTP_WHERE} AND malicious_score > "
                f"CAST(0.8 AS DOUBLE)) FROM sessions UNION ALL "
                "SELECT 'confirmed', count(*) FROM confirmed UNION ALL "
                "SELECT 'alert_pairs', count(*) FROM first_pair",
                conf + ",\n" + Q.first_cte(),
            ),
        }
    )
    for new, same in (
        ("stream_correlation_keyed", "stream_correlation"),
        ("stream_quarantine", "quarantine"),
        ("claimed_runs", "scan_sessions"),
        ("pipeline_assembly", "assemble_features"),
        ("suppress_known_filtered", "suppress_known"),
        ("alert_compaction", "write_alerts"),
    ):
        out[new] = out[same]
    out["stream_stage_counts"] = "SELECT * FROM (" + out["stage_counts"] + ") WHERE stage IN ('sessions', 'http', 'above_threshold')"
    return out


# --------------------------------------------------------------------------
# Contract
# --------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    return _features(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = dict(_QUERIES)
    if _LLM is not None:
        out.update(_LLM.QUERIES)
    if _PIPELINE is not None:
        out["pipeline"] = _PIPELINE.run
    return out


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per key (omitted for rows-only keys)."""
    out = _oracles()
    if _LLM is not None:
        out.update(_LLM.ORACLES)
    if _PIPELINE is not None and _PIPELINE.ORACLE_SQL is not None:
        out["pipeline"] = _PIPELINE.ORACLE_SQL
    return out
