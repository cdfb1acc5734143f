import json
import os

from pyspark.sql import functions as F

from flowlens import schema as S
from flowlens.operators import alerts as al
from flowlens.sources import alerts as sink

CONF = "session_id long, src_ip string, dst_ip string, src_port int, dst_port int, Flow_Duration long, start_time long, malicious_score double"
T0 = 1_704_067_200_000  # 2024-01-01 00:00 UTC


def _confirmed(spark):
    rows = [
        (1, "a", "x", 1000, 80, 5, T0 + 10, 0.9),
        (2, "a", "x", 1001, 80, 6, T0 + 10, 0.95),  # same time, later id
        (3, "a", "x", 1002, 80, 7, T0 + 5, 0.85),  # earliest of pair (a, x)
        (4, "b", None, 1003, 80, 8, T0 + 50, 0.91),
        (5, "b", None, 1004, 80, 9, T0 + 40, 0.92),
        (6, None, "y", 1005, 8080, 10, T0 + 1, 0.99),
    ]
    return spark.createDataFrame(rows, CONF)


def test_first_alert_per_pair_earliest_then_id(spark):
    got = {(r["src_ip"], r["dst_ip"]): r["session_id"] for r in al.first_alert_per_pair(_confirmed(spark)).collect()}
    assert got == {("a", "x"): 3, ("b", None): 5, (None, "y"): 6}


def test_suppress_known_is_null_safe(spark):
    history = spark.createDataFrame([("b", None), (None, "y")], "src_ip string, dst_ip string")
    left = {r["session_id"] for r in al.suppress_known(_confirmed(spark), history).collect()}
    assert left == {1, 2, 3}


def test_retention_export_and_cooldown(spark):
    alerts = al.build_alerts(_confirmed(spark), alert_ts=F.timestamp_millis(F.col("start_time")) + F.expr("INTERVAL 0 SECONDS"))
    now = "2024-01-02 00:00:00.040"  # 24 h after T0 + 40 ms
    kept = {r["session_id"] for r in al.alert_retention(alerts, now).collect()}
    assert kept == {4, 5}  # alert_ts >= now - 24 h
    newer = {r["session_id"] for r in al.alert_export(alerts, "2024-01-01 00:00:00.010").collect()}
    assert newer == {4, 5}  # strictly newer than the marker
    batch = spark.createDataFrame([(9, "b", None, 1, 80, 1, T0 + 86_400_000, 0.9), (10, "a", "x", 1, 80, 1, T0 + 86_400_000, 0.9)], CONF)
    left = {r["session_id"] for r in al.alert_cooldown(batch, alerts, now).collect()}
    assert left == {10}  # (a, x) alerted more than 24 h before now


def test_alert_json_shape(spark):
    first = al.first_alert_per_pair(_confirmed(spark)).filter("src_ip = 'a'")
    doc = json.loads(al.alert_json(al.build_alerts(first)).collect()[0]["json"])
    assert doc["match_body"] == {
        "session": {"protocol": "http", "session_duration": 7},
        "network": {"src_ip": "a", "dst_ip": "x"},
        "transport": {"src_port": 1002, "dst_port": 80},
    }
    assert doc["rule_name"] == S.ALERT_RULE_NAME and doc["priority"] == 1 and doc["score"] == 0.85


def test_write_alerts_is_idempotent_per_batch(spark, workdir):
    alerts = al.build_alerts(_confirmed(spark), alert_ts=F.timestamp_millis(F.col("start_time")), batch_id=3)
    sink.write_alerts(alerts, workdir)
    sink.write_alerts(alerts, workdir)
    assert sink.read_alerts(spark, workdir).count() == 6
    more = al.build_alerts(_confirmed(spark).limit(2), alert_ts=F.timestamp_millis(F.col("start_time")), batch_id=4)
    sink.write_alerts(more, workdir)
    assert sink.read_alerts(spark, workdir).count() == 8


def test_reads_indented_one_per_file_history(spark, tmp_path):
    for i, (s, d) in enumerate([("10.0.0.1", "203.0.113.1"), ("10.0.0.2", None)]):
        doc = {
            "match_body": {
                "session": {"protocol": "http", "session_duration": 5},
                "network": {"src_ip": s, "dst_ip": d},
                "transport": {"src_port": 1, "dst_port": 80},
            },
            "score": 0.9,
            "rule_name": S.ALERT_RULE_NAME,
            "alert_type": S.ALERT_TYPE,
            "alert_category": S.ALERT_CATEGORY,
            "priority": 1,
            "alert_description": S.ALERT_DESCRIPTION,
        }
        with open(os.path.join(tmp_path, f"alert-{i}.json"), "w") as f:
            json.dump(doc, f, indent=4)
    hist = sink.read_alert_documents(spark, str(tmp_path))
    pairs = {(r["src_ip"], r["dst_ip"]) for r in al.known_pairs(hist).collect()}
    assert pairs == {("10.0.0.1", "203.0.113.1"), ("10.0.0.2", None)}


def test_writes_without_an_id_and_of_two_writers_stay_apart(spark, workdir):
    one = _confirmed(spark).limit(1)
    ts = F.timestamp_millis(F.col("start_time"))
    for _ in range(2):
        sink.write_alerts(al.build_alerts(one, alert_ts=ts), workdir)  # a new id each
    sink.write_alerts(al.build_alerts(one, alert_ts=ts, batch_id=7, writer="a"), workdir)
    sink.write_alerts(al.build_alerts(one, alert_ts=ts, batch_id=7, writer="b"), workdir)
    assert sink.read_alerts(spark, workdir).count() == 4


def test_writer_and_reader_in_different_time_zones(spark, workdir):
    import datetime as dt

    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        sink.write_alerts(al.build_alerts(_confirmed(spark), alert_ts=F.timestamp_millis(F.col("start_time"))), workdir)
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        alerts = sink.read_alerts(spark, workdir)
        at = lambda ms: dt.datetime.fromtimestamp((T0 + ms) / 1000, dt.timezone(dt.timedelta(hours=9)))
        assert al.alert_retention(alerts, at(86_400_040)).count() == 2
        assert al.alert_export(alerts, at(10)).count() == 2
        assert {str(r["alert_date"]) for r in alerts.collect()} == {"2024-01-01"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_history_of_a_first_run_is_empty(spark, workdir):
    assert sink.read_alerts(spark, f"{workdir}/none").count() == 0
    assert sink.read_alert_documents(spark, f"{workdir}/none").count() == 0
    assert al.suppress_known(_confirmed(spark), sink.read_alerts(spark, f"{workdir}/none")).count() == 6


def test_documents_have_their_files_time(spark, tmp_path):
    import datetime as dt

    doc = {"match_body": {"network": {"src_ip": "a", "dst_ip": "x"}}, "score": 0.9}
    for name, age in (("old", 100_000), ("new", 10)):
        with open(tmp_path / f"{name}.json", "w") as f:
            json.dump(doc, f, indent=4)
        at = (T0 / 1000) - age
        os.utime(tmp_path / f"{name}.json", (at, at))
    now = dt.datetime.fromtimestamp(T0 / 1000, dt.timezone.utc)
    assert al.alert_retention(sink.read_alert_documents(spark, str(tmp_path)), now).count() == 1


def test_expired_date_partitions_are_removed(spark, workdir):
    import datetime as dt

    days = spark.createDataFrame([(i, "a", "x", 1, 80, 5, T0 + i * 86_400_000, 0.9) for i in range(5)], CONF)
    sink.write_alerts(al.build_alerts(days, alert_ts=F.timestamp_millis(F.col("start_time"))), workdir)
    gone = sink.drop_old_alerts(spark, workdir, dt.datetime(2024, 1, 4, 12), minutes=1440)
    assert gone == ["2024-01-01", "2024-01-02"]
    assert sorted(r["session_id"] for r in sink.read_alerts(spark, workdir).collect()) == [2, 3, 4]
    assert sink.drop_old_alerts(spark, f"{workdir}/none", dt.datetime(2024, 1, 4)) == []


def test_export_moves_its_marker(spark, workdir):
    ts = F.timestamp_millis(F.col("start_time"))
    run = lambda: sink.export_alerts(spark, f"{workdir}/t", f"{workdir}/out", f"{workdir}/ck").awaitTermination()
    count = lambda: sink.read_alert_documents(spark, f"{workdir}/out", lines=True).count()
    sink.write_alerts(al.build_alerts(_confirmed(spark), alert_ts=ts, batch_id=1), f"{workdir}/t")
    run()
    run()
    assert count() == 6
    sink.write_alerts(al.build_alerts(_confirmed(spark).limit(2), alert_ts=ts, batch_id=2), f"{workdir}/t")
    run()
    assert count() == 8


def test_json_sink_replaces_a_retried_batch(spark, workdir):
    alerts = al.build_alerts(_confirmed(spark), alert_ts=F.timestamp_millis(F.col("start_time")), batch_id=3)
    for _ in range(2):
        sink.write_alerts_json(alerts, workdir)
    back = sink.read_alert_documents(spark, workdir, lines=True)
    assert sorted((r["alert_ts"].timestamp() * 1000) for r in back.collect()) == sorted(r["start_time"] for r in _confirmed(spark).collect())


def test_cooldown_chain_of_a_pair(spark):
    gaps = [0, 5, 1439, 1440, 1441, 1500, 2881, 2882, 2883, 9000]
    rows = [(i, "a", "x", 1, 80, 5, T0 + g * 60_000, 0.9) for i, g in enumerate(gaps)] + [(99, None, "x", 1, 80, 5, T0, 0.9)]
    conf = spark.createDataFrame(rows, CONF)
    want, last = [], None
    for i, g in enumerate(gaps):
        if last is None or g - last > 1440:
            want.append(i)
            last = g
    assert sorted(r["session_id"] for r in al.cooldown_alerts(conf).collect()) == [*want, 99]
    before = spark.createDataFrame([("a", "x", T0 + 60_000), (None, "x", T0 - 86_400_001)], "src_ip string, dst_ip string, last_ms long")
    assert sorted(r["session_id"] for r in al.cooldown_alerts(conf, before).collect()) == [5, 9, 99]


def test_alert_time_is_that_of_the_query(spark, workdir):
    """M4: without an event time the alert is stamped when it is written, its
    date is the UTC one."""
    import datetime as dt

    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")  # UTC+14
        before = dt.datetime.now(dt.timezone.utc)
        sink.write_alerts(al.build_alerts(_confirmed(spark), batch_id=1), workdir)
        after = dt.datetime.now(dt.timezone.utc)
        rows = sink.read_alerts(spark, workdir).select(F.unix_micros("alert_ts").alias("us"), "alert_date").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    at = [dt.datetime.fromtimestamp(r["us"] / 1e6, dt.timezone.utc) for r in rows]
    assert len(rows) == 6 and all(before <= t <= after for t in at)
    assert all(r["alert_date"] == t.date() for r, t in zip(rows, at))


def _ids(spark, path):
    return sorted(r["session_id"] for r in sink.read_alerts(spark, path).collect())


def _alerts(spark, batch_id, where="true", writer="batch"):
    return al.build_alerts(_confirmed(spark).filter(where), alert_ts=F.timestamp_millis(F.col("start_time")), batch_id=batch_id, writer=writer)


def test_a_retry_with_fewer_rows_replaces_all_of_its_first_attempt(spark, workdir):
    sink.write_alerts(_alerts(spark, 1), workdir, keys=[("batch", 1)])
    sink.write_alerts(_alerts(spark, 2, "session_id = 1"), workdir)
    sink.write_alerts(_alerts(spark, 1, "session_id = 6"), workdir, keys=[("batch", 1)])
    assert _ids(spark, workdir) == [1, 6]
    sink.write_alerts(_alerts(spark, 1, "false"), workdir, keys=[("batch", 1)])
    assert _ids(spark, workdir) == [1]


def test_a_commit_with_several_keys_can_be_replaced_in_part(spark, workdir):
    both = _alerts(spark, 1, "session_id < 3").unionByName(_alerts(spark, 2, "session_id >= 3", "it=s a/b"))
    sink.write_alerts(both, workdir)
    sink.write_alerts(_alerts(spark, 2, "session_id = 5", "it=s a/b"), workdir)
    assert _ids(spark, workdir) == [1, 2, 5]


def test_writers_that_meet_take_different_numbers(spark, workdir):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(6) as pool:
        numbers = list(pool.map(lambda k: sink.write_alerts(_alerts(spark, k, "session_id = 1"), workdir), range(6)))
    assert sorted(numbers) == [1, 2, 3, 4, 5, 6] and len(_ids(spark, workdir)) == 6


def test_readers_open_few_manifests_and_ignore_one_being_written(spark, workdir, monkeypatch):
    from flowlens.sources import commits, files

    monkeypatch.setattr(commits, "SNAPSHOT_EVERY", 3)
    for k in range(8):
        sink.write_alerts(_alerts(spark, k % 4, "session_id = 2"), workdir)
    assert files.create_text(spark, f"{commits.log_path(workdir)}/{9:020d}.json", '{"n": 9, "fol')
    opened = []
    monkeypatch.setattr(commits, "read_text", lambda s, p: opened.append(p) or files.read_text(s, p))
    assert len(_ids(spark, workdir)) == 4 and len(opened) == 4  # a snapshot at 6, then 7, 8 and the torn 9
    assert sink.write_alerts(_alerts(spark, 7), workdir) == 10 and len(_ids(spark, workdir)) == 10


def test_a_retried_batch_is_exported_once(spark, workdir):
    run = lambda: sink.export_alerts(spark, f"{workdir}/t", f"{workdir}/out", f"{workdir}/ck").awaitTermination()
    count = lambda: sink.read_alert_documents(spark, f"{workdir}/out", lines=True).count()
    sink.write_alerts(_alerts(spark, 1, "session_id < 4"), f"{workdir}/t", keys=[("batch", 1)])
    run()
    assert count() == 3
    sink.write_alerts(_alerts(spark, 1), f"{workdir}/t", keys=[("batch", 1)])  # the retry finds more
    run()
    run()
    assert count() == 6
    sink.write_alerts(_alerts(spark, 2, "session_id = 1"), f"{workdir}/t")
    sink.write_alerts(_alerts(spark, 2, "session_id = 1"), f"{workdir}/t")  # retried before it was exported
    run()
    assert count() == 7


def test_an_early_alert_that_becomes_final_is_exported_once(spark, workdir):
    run = lambda: sink.export_alerts(spark, f"{workdir}/t", f"{workdir}/out", f"{workdir}/ck").awaitTermination()
    for batch, early, final in ((1, "session_id = 1", "false"), (2, "session_id in (1, 2)", "session_id = 3"), (3, "false", "session_id in (1, 2)")):
        rows = _alerts(spark, batch, early, "s-early").unionByName(_alerts(spark, batch, final, "s"))
        sink.write_alerts(rows, f"{workdir}/t", keys=[("s", batch), ("s-early", batch)], instead_of=["s-early"])
        run()
    assert _ids(spark, f"{workdir}/t") == [1, 2, 3]
    assert sink.read_alert_documents(spark, f"{workdir}/out", lines=True).count() == 3


def test_writes_and_retention_do_not_fail_a_running_export(spark, workdir):
    import datetime as dt
    import time

    sink.write_alerts(_alerts(spark, 0), f"{workdir}/t")
    query = sink.export_alerts(spark, f"{workdir}/t", f"{workdir}/out", f"{workdir}/ck", trigger="100 milliseconds")
    try:
        for k in range(4):
            sink.write_alerts(_alerts(spark, k % 2, "session_id <= 2"), f"{workdir}/t", keys=[("batch", k % 2)])
            sink.drop_old_alerts(spark, f"{workdir}/t", dt.datetime(2023, 6, 1))
        query.processAllAvailable()
        time.sleep(0.2)
        assert query.exception() is None
    finally:
        query.stop()
    assert _ids(spark, f"{workdir}/t") == [1, 1, 2, 2]


def test_compaction_keeps_rows_and_takes_out_old_ones_to_the_minute(spark, workdir):
    import datetime as dt

    days = spark.createDataFrame([(i, "a", "x", 1, 80, 5, T0 + i * 3_600_000, 0.9) for i in range(48)], CONF)
    for part in range(4):
        rows = days.filter(F.col("session_id") % 4 == part)
        sink.write_alerts(al.build_alerts(rows, alert_ts=F.timestamp_millis(F.col("start_time")), batch_id=part), workdir)
    before = sorted(map(repr, sink.read_alerts(spark, workdir).collect()))
    assert sink.compact_alerts(spark, workdir, grace_minutes=0) == 5
    assert sorted(map(repr, sink.read_alerts(spark, workdir).collect())) == before
    from flowlens.sources.files import child_names

    assert len([n for n in child_names(spark, workdir) if n.startswith("commit=")]) == 1
    sink.write_alerts(_alerts(spark, 3, "session_id = 6"), workdir)  # a retry after compaction
    assert _ids(spark, workdir) == sorted([i for i in range(48) if i % 4 != 3] + [6])
    sink.compact_alerts(spark, workdir, dt.datetime(2024, 1, 2, 0, 30), minutes=60)
    assert _ids(spark, workdir) == [i for i in range(24, 48) if i % 4 != 3]
    assert sink.compact_alerts(spark, f"{workdir}/none") is None


def test_a_retry_during_compaction_wins(spark, workdir):
    from flowlens.sources import commits

    for k in (1, 2):
        sink.write_alerts(_alerts(spark, k, "session_id = 1"), workdir, keys=[("batch", k)])
    read = commits.live_commits(spark, workdir)
    sink.write_alerts(_alerts(spark, 2, "session_id = 5"), workdir, keys=[("batch", 2)])  # after compaction has read
    sink._read_commits(spark, workdir, read).write.partitionBy("alert_date").parquet(f"{workdir}/commit=c")
    commits.commit(spark, workdir, "commit=c", [("batch", 1), ("batch", 2)], layout="dates", upto=read[-1]["n"])
    assert _ids(spark, workdir) == [1, 5]


def test_a_bit_map_before_the_anti_join_changes_no_row(spark):
    """Few bits (many false positives), enough bits (hardly any), all bits set."""
    rows = spark.range(4000).select((F.col("id") % 1000).cast("string").alias("src_ip"), F.when(F.col("id") % 7 > 0, F.lit("x")).alias("dst_ip"), F.col("id").alias("session_id"))
    history = rows.filter("session_id % 1000 < 100").select("src_ip", "dst_ip")
    want = sorted(r[0] for r in al.suppress_known(rows, history).select("session_id").collect())
    for bits in (6, 10, 20):
        got = al.suppress_known(rows, history, filter_bits=bits)
        assert sorted(r[0] for r in got.select("session_id").collect()) == want and 0 < len(want) < 4000
    assert al.suppress_known(rows, history.limit(0), filter_bits=10).count() == 4000


def test_few_new_rows_get_as_far_as_the_join(spark):
    from flowlens.operators.known import maybe_known

    pairs = spark.range(2000).select(F.col("id").cast("string").alias("src_ip"), F.lit("d").alias("dst_ip"))
    new = spark.range(10_000, 20_000).select(F.col("id").cast("string").alias("src_ip"), F.lit("d").alias("dst_ip"))
    share = lambda df, bits: df.select(maybe_known(df, pairs, bits).alias("m")).filter("m").count() / df.count()
    assert share(pairs, 17) == 1.0  # never a false negative
    assert share(new, 17) < 0.01 and share(new, 10) > 0.5


def test_a_table_from_before_the_log_goes_on(spark, workdir):
    import datetime as dt

    _alerts(spark, 1, "session_id < 3").write.partitionBy("alert_date", "writer", "batch_id").parquet(workdir)
    assert _ids(spark, workdir) == [1, 2]
    sink.write_alerts(_alerts(spark, 2, "session_id = 6"), workdir)
    assert _ids(spark, workdir) == [1, 2, 6]
    assert sink.drop_old_alerts(spark, workdir, dt.datetime(2024, 2, 1)) == ["2024-01-01"]
    assert _ids(spark, workdir) == []
