"""Benchmark: headline detector queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Setup (untimed): the stand-in session records of the scale factor are
written once as multi-file session Parquet -- the shape of the detector's
real input -- and every timed query starts from a declared-schema scan of
those files.  Each query runs to completion through the ``noop`` sink (full
execution, nothing collected); batch queries report the best of two runs,
forest training and the stream one run each.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from flowlens import schema as S  # noqa: E402
from flowlens.config import build_session, scratch_path  # noqa: E402
from flowlens.operators import matrix as mx  # noqa: E402
from flowlens.operators import text_features as tf  # noqa: E402
from flowlens.operators.correlate import temporal_correlation  # noqa: E402
from flowlens.operators.features import session_features  # noqa: E402
from flowlens.operators.scoring import score_filter, score_sessions, train_forest  # noqa: E402
from flowlens.plans.detect import ALERT_INPUT, detect_alerts  # noqa: E402
from flowlens.sources.fixture import session_records  # noqa: E402
from flowlens.sources.sessions import scan_sessions  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app="flowlens-bench")
    spark.conf.set("spark.sql.session.timeZone", "UTC")

    t0 = time.time()
    staged = scratch_path(spark, "flowlens-bench", uuid.uuid4().hex, "sessions")
    session_records(spark, sf_dir).repartition(4 * cpus).write.parquet(staged)
    setup_s = time.time() - t0

    def sessions():
        return scan_sessions(spark, staged)

    n_sessions = sessions().count()
    # Untimed warm-up (JIT, Python workers) so the first timed query is not
    # charged for process start-up.
    _run(session_features(sessions()))
    queries = {
        "features": lambda: session_features(sessions()),
        "text_features": lambda: tf.text_features(session_features(sessions())),
        "correlation": lambda: temporal_correlation(score_filter(session_features(sessions())).select(*ALERT_INPUT)),
        "detect_alerts": lambda: detect_alerts(sessions(), alert_ts=F.timestamp_millis(F.col("start_time"))),
        "assemble_features": lambda: mx.assemble_features(session_features(sessions())).select(S.SESSION_ID, "features"),
    }
    # Best of two runs per batch query: the host is shared, and single runs
    # vary by up to 2x; the minimum is the least noisy estimate.
    timings: dict[str, float] = {}
    for name, build in queries.items():
        best = float("inf")
        for _ in range(2):
            t = time.time()
            _run(build())
            best = min(best, time.time() - t)
        timings[name] = round(best, 3)

    # Model: fit (timed separately) and score every HTTP session.
    feats = session_features(sessions()).withColumn(
        "label", (F.col("Total_Fwd_Packets") > F.col("Total_Backward_Packets")).cast("int")
    )
    t = time.time()
    held_out = F.pmod(F.xxhash64(S.SESSION_ID), F.lit(5)) == 0
    model = train_forest(feats.filter(~held_out), num_trees=10, max_depth=5, feature_subset="onethird")
    timings["train_forest"] = round(time.time() - t, 3)
    best = float("inf")
    for _ in range(2):
        t = time.time()
        _run(score_sessions(feats, model).select(S.SESSION_ID, "prediction", S.SCORE))
        best = min(best, time.time() - t)
    timings["score_sessions"] = round(best, 3)

    # End to end with the model: score, threshold, checkpoint the narrow
    # above-threshold rows, correlate, one alert per pair.
    t = time.time()
    found = detect_alerts(sessions(), model=model, alert_ts=F.timestamp_millis(F.col("start_time"))).count()
    timings["detect_with_model"] = round(time.time() - t, 3)
    assert found > 0, "the model path must reach the correlation"

    # Streaming: the same detection as a stream over time-ordered files
    # (6 chunks of `cpus` files, one micro-batch per chunk), with state and
    # alerts written per batch.
    from flowlens.streaming.detect import flush_detection, start_detection

    stream_base = scratch_path(spark, "flowlens-bench", uuid.uuid4().hex)
    recs = sessions()
    bounds = recs.agg(F.min("session.start_time").alias("lo"), F.max("session.start_time").alias("hi")).collect()[0]
    lo, hi, chunks = int(bounds["lo"]), int(bounds["hi"]), 6
    step = (hi - lo) // chunks + 1
    for i in range(chunks):
        t_col = F.col("session.start_time")
        part = recs.filter((t_col >= lo + i * step) & (t_col < lo + (i + 1) * step))
        part.repartition(cpus).write.parquet(f"{stream_base}/in/chunk={i:03d}")  # one batch per chunk
    t = time.time()
    q = start_detection(spark, f"{stream_base}/in", f"{stream_base}/work", trigger=None, max_files_per_trigger=cpus)
    q.awaitTermination()
    flush_detection(spark, f"{stream_base}/work")
    timings["stream_detect"] = round(time.time() - t, 3)

    total = round(sum(timings.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "detector_total_seconds",
                "value": total,
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                "sessions": n_sessions,
                "sessions_per_sec_end_to_end": round(n_sessions / timings["detect_alerts"], 1),
                "cpus": cpus,
                "setup_sec": round(setup_s, 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
