import random

from flowlens import schema as S
from flowlens.operators.correlate import temporal_correlation
from flowlens.sources.alerts import read_alerts
from flowlens.streaming.correlate import CorrelationState, confirmed_output, flush_correlation, side_rows, start_correlation
from flowlens.streaming.detect import cooldown_stream, detect_micro_batch, flush_detection, run_detection, start_detection

from .helpers import session_row, sessions_df

SCHEMA = "session_id long, src_ip string, dst_ip string, start_time long, malicious_score double"


def _rows(n=400, seed=5):
    rnd = random.Random(seed)
    t0 = 1_700_000_000_000
    return [
        (i, f"10.0.0.{i % 3}", rnd.choice(["a", "b", None]), t0 + rnd.randrange(0, 240) * 60_000, 0.9)
        for i in range(n)
    ]


def _write_in_time_order(spark, rows, path, chunks, first=0):
    rows = sorted(rows, key=lambda r: r[3])
    size = len(rows) // chunks + 1
    for i in range(chunks):
        part = rows[i * size:(i + 1) * size]
        if part:
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{path}/chunk={first + i:03d}")


def _stream(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_equals_batch(spark, workdir):
    rows = _rows()
    _write_in_time_order(spark, rows, f"{workdir}/in", 5)
    start_correlation(spark, _stream(spark, f"{workdir}/in"), f"{workdir}/w").awaitTermination()
    flush_correlation(spark, f"{workdir}/w")
    got = {(r["session_id"], r["hit_count"]) for r in confirmed_output(spark, f"{workdir}/w").collect()}
    want = {(r["session_id"], r["hit_count"]) for r in temporal_correlation(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want and len(got) > 0


def test_restart_from_checkpoint_emits_no_duplicates(spark, workdir):
    rows = sorted(_rows(seed=9), key=lambda r: r[3])
    half = len(rows) // 2
    _write_in_time_order(spark, rows[:half], f"{workdir}/in", 2)
    start_correlation(spark, _stream(spark, f"{workdir}/in"), f"{workdir}/w").awaitTermination()
    _write_in_time_order(spark, rows[half:], f"{workdir}/in", 2, first=2)
    start_correlation(spark, _stream(spark, f"{workdir}/in"), f"{workdir}/w").awaitTermination()
    flush_correlation(spark, f"{workdir}/w")
    out = confirmed_output(spark, f"{workdir}/w")
    ids = [r["session_id"] for r in out.collect()]
    assert len(ids) == len(set(ids))
    want = {r["session_id"] for r in temporal_correlation(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(ids) == want


def test_late_rows_are_kept_aside_not_miscounted(spark, workdir):
    t0 = 1_700_000_000_000
    early = [(1, "s", "d", t0 + 3_600_000, 0.9), (2, "s", "d", t0 + 3_600_000, 0.9), (3, "s", "d", t0 + 3_600_001, 0.9)]
    late = [(4, "s", "d", t0, 0.9)]  # an hour behind a 10-minute watermark
    spark.createDataFrame(early, SCHEMA).coalesce(1).write.parquet(f"{workdir}/in/c=0")
    spark.createDataFrame(late, SCHEMA).coalesce(1).write.parquet(f"{workdir}/in/c=1")
    start_correlation(spark, _stream(spark, f"{workdir}/in"), f"{workdir}/w").awaitTermination()
    flush_correlation(spark, f"{workdir}/w")
    got = {r["session_id"]: r["hit_count"] for r in confirmed_output(spark, f"{workdir}/w").collect()}
    assert got == {3: 3}
    state = CorrelationState(f"{workdir}/w/state")
    kept = side_rows(spark, state, "late", spark.createDataFrame([], SCHEMA).schema)
    assert [(r["session_id"], r["version"]) for r in kept.collect()] == [(4, 1000)]


def test_cooldown_stream_one_alert_per_pair_within_window(spark, workdir):
    t0 = 1_700_000_000_000
    day = 86_400_000
    # A pair's state is evicted at the end of the first micro-batch whose
    # event-time watermark (driven by all traffic) is past its first alert
    # + 24 h, so expiry lags by up to one trigger.  Row 4 moves the
    # watermark, row 5's batch evicts, row 3 then alerts again.
    rows = [
        (1, "s", "d", t0, 0.9),
        (2, "s", "d", t0 + 1000, 0.9),  # duplicate inside the cool-down
        (4, "s", "e", t0 + 2 * day, 0.9),
        (5, "s", "e", t0 + 2 * day + 1000, 0.9),  # duplicate of (s, e)
        (3, "s", "d", t0 + 2 * day + 2000, 0.9),  # after the cool-down: alerts again
    ]
    for i, r in enumerate(rows):
        spark.createDataFrame([r], SCHEMA).coalesce(1).write.parquet(f"{workdir}/in/c={i}")
    q = (
        cooldown_stream(_stream(spark, f"{workdir}/in"))
        .writeStream.format("parquet")
        .option("path", f"{workdir}/out")
        .option("checkpointLocation", f"{workdir}/ck")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    got = sorted(r["session_id"] for r in spark.read.parquet(f"{workdir}/out").collect())
    assert got == [1, 3, 4]


HOT = (
    "session_id long, src_ip string, dst_ip string, src_port int, dst_port int, "
    "Flow_Duration long, start_time long, malicious_score double"
)
T0 = 1_700_000_000_000
HOUR = 3_600_000


def _hot(spark, rows):
    """(session_id, src, dst, start) -> rows as the detector sees them."""
    return spark.createDataFrame([(i, s, d, 1, 80, 5, t, 0.9) for i, s, d, t in rows], HOT)


def test_retried_micro_batch_writes_alerts_once(spark, workdir):
    hot = _hot(spark, [(i, "s", "d", T0 + i * 1000) for i in range(5)])
    state = CorrelationState(f"{workdir}/state")
    for _ in range(2):  # the same batch, retried
        detect_micro_batch(spark, hot, 0, state, f"{workdir}/alerts", flush=True)
    out = read_alerts(spark, f"{workdir}/alerts").collect()
    assert len(out) == 1 and out[0]["session_id"] == 2  # first confirmed session of the pair


def _alerts_of(spark, workdir, chunks):
    state = CorrelationState(f"{workdir}/state")
    for b, rows in enumerate(chunks):
        detect_micro_batch(spark, _hot(spark, rows), b * 1000, state, f"{workdir}/alerts")
    flush_detection(spark, workdir)
    return sorted(r["session_id"] for r in read_alerts(spark, f"{workdir}/alerts").collect())


def test_alerts_do_not_depend_on_micro_batch_cuts(spark, workdir):
    """Alert at T0, hits inside the cool-down (23.9 h) and after it (24.3 h)."""
    late, after = int(23.9 * HOUR), int(24.3 * HOUR)
    bursts = [[(10 * b + i, "s", "d", T0 + t + i * 1000) for i in range(3)] for b, t in ((0, 0), (1, late), (2, after))]
    rows = [r for b in bursts for r in b]
    one = _alerts_of(spark, f"{workdir}/one", [rows])
    three = _alerts_of(spark, f"{workdir}/three", bursts)
    six = _alerts_of(spark, f"{workdir}/six", [rows[i : i + 2] for i in range(0, 9, 2)])
    assert one == three == six == [2, 22]  # the third row of a burst confirms


def test_a_future_clock_neither_moves_the_watermark_nor_vanishes(spark, workdir):
    now = T0 + 2 * HOUR
    state = CorrelationState(f"{workdir}/state")
    ahead = T0 + 10 * 365 * 24 * HOUR
    detect_micro_batch(spark, _hot(spark, [(1, "s", "d", ahead), (2, "s", "d", T0)]), 0, state, f"{workdir}/alerts", now_ms=now)
    rows = [(10 + i, "s", "d", T0 + 60_000 + i) for i in range(5)]
    detect_micro_batch(spark, _hot(spark, rows), 1000, state, f"{workdir}/alerts", now_ms=now)
    flush_detection(spark, workdir)
    assert [r["session_id"] for r in read_alerts(spark, f"{workdir}/alerts").collect()] == [11]
    aside = side_rows(spark, state, "ahead", _hot(spark, []).schema).collect()
    assert [r["session_id"] for r in aside] == [1]
    assert side_rows(spark, state, "late", _hot(spark, []).schema).count() == 0


def _files(spark, workdir, groups):
    for i, rows in enumerate(groups):
        sessions_df(spark, rows).coalesce(1).write.parquet(f"{workdir}/in/c={i}")


def test_benign_traffic_finalises_a_burst(spark, workdir):
    burst = [session_row(i, src="s", dst="d", start=T0 + i * 1000) for i in range(5)]
    benign = [session_row(100 + i, src="b", dst="e", start=T0 + i * 10 * 60_000, score=0.1) for i in range(1, 10)]
    _files(spark, workdir, [burst, benign])
    start_detection(spark, f"{workdir}/in/*", f"{workdir}/w", trigger=None, max_files_per_trigger=1).awaitTermination()
    assert [r["session_id"] for r in read_alerts(spark, f"{workdir}/w/alerts").collect()] == [2]


def test_an_idle_source_finalises_what_is_pending_and_goes_on(spark, workdir):
    _files(spark, workdir, [[session_row(i, src="s", dst="d", start=T0 + i * 1000) for i in range(5)]])
    soon = run_detection(spark, f"{workdir}/in/*", f"{workdir}/w")
    assert not soon and read_alerts(spark, f"{workdir}/w/alerts").count() == 0
    far = 2**60  # long after
    assert run_detection(spark, f"{workdir}/in/*", f"{workdir}/w", now_ms=far)
    assert [r["session_id"] for r in read_alerts(spark, f"{workdir}/w/alerts").collect()] == [2]
    assert not run_detection(spark, f"{workdir}/in/*", f"{workdir}/w", now_ms=far)  # nothing pending now
    more = [session_row(50 + i, src="t", dst="d", start=T0 + 20 * 60_000 + i) for i in range(4)]
    sessions_df(spark, more).coalesce(1).write.parquet(f"{workdir}/in/c=9")
    assert run_detection(spark, f"{workdir}/in/*", f"{workdir}/w", now_ms=far)
    assert sorted(r["session_id"] for r in read_alerts(spark, f"{workdir}/w/alerts").collect()) == [2, 52]


def test_a_batch_alert_suppresses_a_stream_alert(spark, workdir):
    first = _hot(spark, [(1, "s", "d", T0)])
    from flowlens.operators.alerts import build_alerts
    from flowlens.sources.alerts import write_alerts
    from pyspark.sql import functions as F

    ts = F.timestamp_millis(F.col("start_time"))
    write_alerts(build_alerts(first, alert_ts=ts, batch_id=42), f"{workdir}/alerts")
    assert _alerts_of(spark, workdir, [[(10 + i, "s", "d", T0 + HOUR + i) for i in range(4)]]) == [1]


def test_state_folders_stay_bounded(spark, workdir):
    from flowlens.sources.files import child_names

    state = CorrelationState(f"{workdir}/state")
    for b in range(6):
        detect_micro_batch(spark, _hot(spark, [(b, "s", "d", T0 + b * HOUR)]), b * 1000, state, f"{workdir}/alerts")
    assert len(state.versions(spark)) <= 3
    assert len([n for n in child_names(spark, f"{state.state_dir}/tail") if n.startswith("version=")]) <= 3


def test_a_mistyped_or_truncated_file_does_not_stop_the_stream(spark, workdir):
    from pyspark.sql import functions as F

    good = sessions_df(spark, [session_row(i) for i in range(6)])
    good.coalesce(1).write.parquet(f"{workdir}/in/a")
    bad = good.withColumn("session", F.col("session").withField("start_time", F.col("session.start_time").cast("string")))
    bad.coalesce(1).write.parquet(f"{workdir}/in/b")
    spark.createDataFrame([("not parquet",)], "value string").coalesce(1).write.text(f"{workdir}/in/c")
    from flowlens.sources.files import _file_system, child_names

    for name in child_names(spark, f"{workdir}/in/c"):
        if name.endswith(".txt"):
            src, fs = _file_system(spark, f"{workdir}/in/c/{name}")
            fs.rename(src, _file_system(spark, f"{workdir}/in/c/part-0.parquet")[0])
    from flowlens.streaming.detect import stream_features

    stream_features(spark, f"{workdir}/in/*", f"{workdir}/out", f"{workdir}/ck").awaitTermination()
    assert spark.read.parquet(f"{workdir}/out").select(S.SESSION_ID).distinct().count() == 6


def test_exact_cooldown_does_not_depend_on_batches(spark, workdir):
    from flowlens.streaming.detect import cooldown_output, start_cooldown

    minutes = [0, 5, 1439, 1440, 1441, 1500, 2881, 2882, 2883, 9000]
    rows = [(i, "s", "d" if i % 4 else None, T0 + m * 60_000, 0.9) for i, m in enumerate(minutes)]
    rows += [(100 + i, "s", "d", T0 + m * 60_000, 0.9) for i, m in enumerate(minutes)]
    got = {}
    for chunks in (1, 3, 7):
        base = f"{workdir}/{chunks}"
        _write_in_time_order(spark, rows, f"{base}/in", chunks)
        schema = spark.createDataFrame([], SCHEMA).schema
        stream = _stream(spark, f"{base}/in").select(*schema.names)
        for _ in range(2):  # the second run finds nothing new
            start_cooldown(spark, stream, f"{base}/out", f"{base}/ck").awaitTermination()
        got[chunks] = sorted(r["session_id"] for r in cooldown_output(spark, f"{base}/out", schema).collect())
    assert got[1] == got[3] == got[7] == [0, 4, 7, 8, 9, 100, 104]


MIN = 60_000


def _detect(spark, workdir, steps, now):
    """``steps``: lists of (id, src, dst, start) for a batch, or "flush"."""
    state, version = CorrelationState(f"{workdir}/state"), -1
    for step in steps:
        if step == "flush":
            flush_detection(spark, workdir, now_ms=now)
        else:
            version += 1
            detect_micro_batch(spark, _hot(spark, step), version * 1000, state, f"{workdir}/alerts", now_ms=now)
    return sorted(r["session_id"] for r in read_alerts(spark, f"{workdir}/alerts").collect())


def test_a_session_59_minutes_ahead_does_not_blind_the_stream(spark, workdir):
    now = T0 + 2 * HOUR
    burst = [[(10 * b + i, "s", "d", now - 5 * MIN + b * 30_000 + i) for i in range(3)] for b in range(3)]
    ahead = [(1, "x", "y", now + 59 * MIN)]
    assert _detect(spark, f"{workdir}/a", [burst[0], ahead, *burst[1:], "flush"], now) == [2]
    late = side_rows(spark, CorrelationState(f"{workdir}/a/state"), "late", _hot(spark, []).schema)
    assert late.count() == 0


def test_an_ahead_session_counts_once_the_present_has_passed_it(spark, workdir):
    now = T0 + 2 * HOUR
    rows = [(i, "s", "d", now + 30 * MIN + i) for i in range(3)]
    assert _detect(spark, workdir, [rows, [(9, "b", "e", now)], "flush"], now) == []
    later = now + HOUR
    state = CorrelationState(f"{workdir}/state")
    detect_micro_batch(spark, _hot(spark, [(10, "b", "e", later)]), 5000, state, f"{workdir}/alerts", now_ms=later)
    assert [r["session_id"] for r in read_alerts(spark, f"{workdir}/alerts").collect()] == [2]


def test_an_ahead_session_does_not_hurt_a_backlog(spark, workdir):
    """Old files after an outage: their times still make the watermark."""
    now = T0 + 100 * HOUR
    burst = [(10 + i, "s", "d", T0 + i * MIN) for i in range(3)]
    assert _detect(spark, workdir, [[(1, "x", "y", now + 1), (2, "x", "z", T0)], burst, [(3, "x", "w", T0 + HOUR)]], now) == [12]


def test_a_flush_between_batches_loses_nothing(spark, workdir):
    now = T0 + HOUR
    one, two = [(1, "s", "d", now - 8 * MIN), (2, "s", "d", now - 4 * MIN)], [(3, "s", "d", now - 6 * MIN), (4, "s", "d", now - 5 * MIN)]
    for name, steps in (("with", [one, "flush", two, "flush"]), ("without", [one, two, "flush"])):
        assert _detect(spark, f"{workdir}/{name}", steps, now) == [4]


def test_an_early_alert_gives_way_to_the_final_one(spark, workdir):
    now = T0 + HOUR
    one = [(i, "s", "d", now - 8 * MIN + i * MIN) for i in (1, 3, 4)]
    assert _detect(spark, workdir, [one, "flush"], now) == [4]
    state, alerts = CorrelationState(f"{workdir}/state"), f"{workdir}/alerts"
    # A row in time makes session 3 the third hit; the early alert is carried until that is final.
    detect_micro_batch(spark, _hot(spark, [(2, "s", "d", now - 6 * MIN)]), 2000, state, alerts, now_ms=now)
    assert [r["session_id"] for r in read_alerts(spark, alerts).collect()] == [4]
    detect_micro_batch(spark, _hot(spark, [(9, "b", "e", now + HOUR)]), 3000, state, alerts, now_ms=now + HOUR)
    assert [(r["session_id"], r["writer"]) for r in read_alerts(spark, alerts).collect()] == [(3, "stream")]


def test_stream_equals_batch_under_random_flushes_and_clock_errors(spark, workdir):
    for seed in (2,):
        rnd = random.Random(seed)
        now = T0 + 1000 * HOUR
        rows = sorted(((i, f"s{i % 3}", rnd.choice("ab"), T0 + rnd.randrange(0, 40) * MIN) for i in range(90)), key=lambda r: r[3] + rnd.randrange(0, 9) * MIN)
        steps = []
        for k in range(0, 90, 15):
            steps.append(rows[k : k + 15] + [(1000 + k, "clock", "x", now + rnd.randrange(1, 59) * MIN)])
            if rnd.random() < 0.6:
                steps.append("flush")
        got = _detect(spark, f"{workdir}/{seed}", [*steps, "flush"], now)
        hot = _hot(spark, rows)
        from flowlens.operators.alerts import cooldown_alerts

        want = cooldown_alerts(temporal_correlation(hot).drop("hit_count"))
        assert got == sorted(r["session_id"] for r in want.collect()) and got


def test_correlation_flush_reports_and_goes_on(spark, workdir):
    rows = sorted(_rows(seed=11), key=lambda r: r[3])
    got = {}
    for i, part in enumerate((rows[:150], rows[150:300], rows[300:])):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{workdir}/in/chunk={i}")
        start_correlation(spark, _stream(spark, f"{workdir}/in"), f"{workdir}/w").awaitTermination()
        flush_correlation(spark, f"{workdir}/w")
        out = confirmed_output(spark, f"{workdir}/w").collect()
        so_far = temporal_correlation(spark.createDataFrame([r for r in rows if r[0] in {x[0] for x in rows[: 150 * (i + 1)]}], SCHEMA)).collect()
        got[i] = sorted((r["session_id"], r["hit_count"]) for r in out) == sorted((r["session_id"], r["hit_count"]) for r in so_far)
    assert got == {0: True, 1: True, 2: True}


def test_the_archive_holds_exactly_the_committed_files(spark, workdir):
    """The source archives a file in a later batch than the one that read
    it; files not committed stay where they are."""
    from flowlens.sources.files import child_names
    from flowlens.streaming.detect import stream_features

    run = lambda: stream_features(
        spark, f"{workdir}/in", f"{workdir}/out", f"{workdir}/ck", max_files_per_trigger=1, clean_source="archive", archive_dir=f"{workdir}/archive"
    ).awaitTermination()
    kept = lambda base: sorted(r[0].rsplit("/", 1)[1] for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(base).select("path").collect())
    names = []
    for i in range(3):
        sessions_df(spark, [session_row(10 * i + k) for k in range(2)]).coalesce(1).write.mode("append").parquet(f"{workdir}/in")
        names.append(next(n for n in child_names(spark, f"{workdir}/in") if n.endswith(".parquet") and n not in names))
        run()
    assert spark.read.parquet(f"{workdir}/out").count() == 6
    archived = kept(f"{workdir}/archive")
    left = sorted(n for n in child_names(spark, f"{workdir}/in") if n.endswith(".parquet"))
    assert archived and sorted(archived + left) == sorted(names) and names[-1] in left


def test_a_processing_time_trigger_runs_batch_after_batch(spark, workdir):
    """The query stays up and takes up a file that comes later."""
    import time

    from flowlens.streaming.detect import stream_features

    sessions_df(spark, [session_row(1)]).coalesce(1).write.mode("append").parquet(f"{workdir}/in")
    query = stream_features(spark, f"{workdir}/in", f"{workdir}/out", f"{workdir}/ck", trigger="1 second")
    try:
        for n in (1, 2):
            until = time.time() + 60
            while time.time() < until and not (query.lastProgress and spark.read.schema("session_id long").parquet(f"{workdir}/out").count() == n):
                time.sleep(0.3)
            if n == 1:
                sessions_df(spark, [session_row(2)]).coalesce(1).write.mode("append").parquet(f"{workdir}/in")
        assert query.isActive
        ran = [p["batchId"] for p in query.recentProgress if p["numInputRows"]]
    finally:
        query.stop()
    assert ran == [0, 1] and spark.read.parquet(f"{workdir}/out").count() == 2


def _damage(spark, folder, how):
    """Rewrites the folder's one file: ``cut`` off its end, or with a broken
    page behind a sound footer."""
    import os

    local = folder.replace("file:", "", 1)
    name = next(n for n in os.listdir(local) if n.endswith(".parquet"))
    with open(f"{local}/{name}", "rb") as f:
        data = bytearray(f.read())
    if how == "cut":
        data = data[: len(data) // 2]
    else:
        data[4:400] = bytes(255 for _ in range(396))
    for n in os.listdir(local):
        if n.startswith("."):
            os.remove(f"{local}/{n}")
    with open(f"{local}/{name}", "wb") as f:
        f.write(data)


def _bad_and_good(spark, workdir):
    from pyspark.sql import functions as F

    good = sessions_df(spark, [session_row(i, src="s", dst="d", start=T0 + i * 1000) for i in range(5)])
    for name in ("a good", "b", "c", "d"):
        rows = good if name == "a good" else sessions_df(spark, [session_row(100 + i, src="t", dst="d", start=T0 + i) for i in range(50)])
        if name == "b":
            rows = rows.withColumn("session", F.col("session").withField("start_time", F.col("session.start_time").cast("string")))
        rows.coalesce(1).write.parquet(f"{workdir}/in/{name}")
    _damage(spark, f"{workdir}/in/c", "cut")
    _damage(spark, f"{workdir}/in/d", "page")


def test_the_stream_lists_the_files_it_leaves_out(spark, workdir):
    """A mistyped, a truncated and a damaged file, and one good one."""
    from flowlens.streaming.files import quarantined_files

    _bad_and_good(spark, workdir)
    start_detection(spark, f"{workdir}/in/*", f"{workdir}/w", trigger=None).awaitTermination()
    flush_detection(spark, f"{workdir}/w")
    listed = {r["path"].rsplit("/", 2)[1]: (r["reason"], r["version"]) for r in quarantined_files(spark, f"{workdir}/w/quarantine").collect()}
    assert sorted(listed) == ["b", "c", "d"] and {v for _, v in listed.values()} == {0}
    assert listed["b"][0] == "session.start_time: string != bigint" and listed["c"][0].startswith("unreadable") and listed["d"][0]
    assert [r["session_id"] for r in read_alerts(spark, f"{workdir}/w/alerts").collect()] == [2]
    # Later good files go on as before, and nothing new is listed.
    sessions_df(spark, [session_row(7, src="b", dst="e", start=T0 + HOUR, score=0.1)]).coalesce(1).write.parquet(f"{workdir}/in/e")
    start_detection(spark, f"{workdir}/in/*", f"{workdir}/w", trigger=None).awaitTermination()
    assert quarantined_files(spark, f"{workdir}/w/quarantine").count() == 3
    assert [(r["session_id"], r["writer"]) for r in read_alerts(spark, f"{workdir}/w/alerts").collect()] == [(2, "stream")]


def test_a_batch_run_reports_a_damaged_page(spark, workdir):
    from flowlens.sources.sessions import read_valid_sessions

    _bad_and_good(spark, workdir)
    rows, report = read_valid_sessions(spark, f"{workdir}/in")
    assert rows.count() == 5
    assert sorted(r["path"].rsplit("/", 2)[1] for r in report.collect()) == ["b", "c", "d"]


def test_counts_of_each_micro_batch(spark, workdir):
    """The listener's and the detector's counts are ``stage_counts`` of
    each batch's file."""
    from flowlens.plans.metrics import StageCountListener, stage_counts
    from flowlens.sources.sessions import scan_sessions
    from flowlens.streaming.detect import batch_counts, stream_features

    rnd = random.Random(1)
    for c in range(3):
        rows = [session_row(100 * c + i, protocol=rnd.choice(["http", "HTTP", "tls", None]), score=rnd.choice([0.1, 0.8, 0.95, None]), start=T0 + c * MIN + i) for i in range(20 + c)]
        sessions_df(spark, rows).coalesce(1).write.parquet(f"{workdir}/in/c={c}")
    want = []
    for c in range(3):
        n = {r["stage"]: r["n_rows"] for r in stage_counts(scan_sessions(spark, f"{workdir}/in/c={c}")).collect()}
        want.append({k: n[k] for k in ("sessions", "http", "above_threshold")})
    listener = StageCountListener()
    spark.streams.addListener(listener)
    try:
        stream_features(spark, f"{workdir}/in", f"{workdir}/out", f"{workdir}/ck", max_files_per_trigger=1).awaitTermination()
        import time

        until = time.time() + 20
        while len(listener.batches) < 3 and time.time() < until:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.counts() == list(enumerate(want))
    start_detection(spark, f"{workdir}/in", f"{workdir}/w", trigger=None, max_files_per_trigger=1).awaitTermination()
    got = batch_counts(spark, f"{workdir}/w").orderBy("version").collect()
    assert [{k: r[k] for k in want[0]} for r in got] == want
