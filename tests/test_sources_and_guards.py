import os
import re

from pyspark.sql import functions as F

from flowlens import schema as S
from flowlens.operators.features import session_features
from flowlens.sources import sessions as src

from .helpers import session_row, sessions_df

ROOT = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "flowlens")

# Driver-side actions the library is allowed to take, and why.
ALLOWED_ACTIONS = {
    ("streaming/correlate.py", "collect"): "one scalar row per micro-batch (late and ahead counts, max event time)",
    ("streaming/detect.py", "collect"): "one scalar per micro-batch (the first time in the batch)",
    ("streaming/files.py", "collect"): "names of a micro-batch's files (at most those of a trigger, 1,000 unless set)",
    ("sources/claims.py", "collect"): "names of the files that a run claims (at most max_files)",
    ("sources/alerts.py", "collect"): "numbers of the commits in one trigger of the export (at most 200)",
    ("operators/cooldown.py", "collect"): "two summary lines for each range of the sort",
    ("operators/known.py", "toArrow"): "a bit map of fixed size (at most 2**(bits - 6) numbers)",
}


def test_no_rows_through_the_driver():
    found = set()
    for dirpath, folders, files in os.walk(ROOT):
        folders[:] = [f for f in folders if f != "llm"]  # has its own rules and tests
        for name in files:
            if not name.endswith(".py"):
                continue
            rel = os.path.relpath(os.path.join(dirpath, name), ROOT)
            text = open(os.path.join(dirpath, name)).read()
            for act in ("collect", "toPandas", "toArrow", "localCheckpoint"):
                if re.search(rf"\.{act}\(", text):
                    found.add((rel, act))
    assert found <= set(ALLOWED_ACTIONS), found - set(ALLOWED_ACTIONS)


def test_scan_prunes_nested_columns_and_pushes_filters(spark, workdir):
    rows = [session_row(i, protocol="http" if i % 2 else "dns") for i in range(20)]
    sessions_df(spark, rows).write.parquet(f"{workdir}/s")
    df = src.scan_sessions(spark, f"{workdir}/s").filter(F.col("session.start_time") > 0)
    plan = session_features(df).select("src_ip", "Flow_Duration")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(session.protocol)" in plan or "IsNotNull(session.protocol)" in plan
    assert "GreaterThan(session.start_time,0)" in plan
    read_schema = re.search(r"ReadSchema: (struct<.*?>)(,|\s|$)", plan).group(1)
    assert "payload" not in read_schema and "src_port" not in read_schema


def test_scan_derives_stable_ids_when_missing(spark, workdir):
    rows = [session_row(None, src=f"10.0.0.{i}") for i in range(5)]
    sessions_df(spark, rows).write.parquet(f"{workdir}/noid")
    a = sorted(r[0] for r in src.scan_sessions(spark, f"{workdir}/noid").select(S.SESSION_ID).collect())
    b = sorted(r[0] for r in src.scan_sessions(spark, f"{workdir}/noid").select(S.SESSION_ID).collect())
    assert a == b and None not in a and len(set(a)) == 5


def test_quarantine_reports_type_mismatch(spark, workdir):
    good = sessions_df(spark, [session_row(i) for i in range(10)])
    good.coalesce(2).write.parquet(f"{workdir}/in")
    bad = good.withColumn("session", F.col("session").withField("start_time", F.col("session.start_time").cast("string")))
    bad.coalesce(1).write.mode("append").parquet(f"{workdir}/in/bad")
    valid, report = src.read_valid_sessions(spark, f"{workdir}/in")
    reasons = [r["reason"] for r in report.collect()]
    assert len(reasons) == 1 and "session.start_time: string != bigint" in reasons[0]
    assert valid.count() == 10


def test_quarantine_keeps_what_spark_can_read(spark, workdir):
    good = sessions_df(spark, [session_row(i) for i in range(10)])
    folder = f"{workdir}/in dir"
    good.coalesce(1).write.parquet(f"{folder}/a b%20c")  # a space, and an escape as it stands
    narrow = good.withColumn("session", F.col("session").withField("total_bytes", F.col("session.total_bytes").cast("int")))
    narrow.coalesce(1).write.parquet(f"{folder}/narrow")  # INT32 reads into BIGINT
    broken = f"{folder}/broken"
    good.coalesce(1).write.parquet(broken)
    local = broken.removeprefix("file:")
    name = next(n for n in os.listdir(local) if n.endswith(".parquet"))
    with open(os.path.join(local, name), "r+b") as f:
        f.truncate(200)
    os.remove(os.path.join(local, f".{name}.crc"))
    valid, report = src.read_valid_sessions(spark, folder)
    assert [r["reason"].split(":")[0] for r in report.collect()] == ["unreadable"]
    assert valid.count() == 20


def test_sessions_that_differ_only_in_their_url_have_different_ids(spark, workdir):
    rows = [session_row(None, http_get=f"/{i}") for i in range(5)]
    sessions_df(spark, rows).write.parquet(f"{workdir}/urls")
    assert src.scan_sessions(spark, f"{workdir}/urls").select(S.SESSION_ID).distinct().count() == 5


def test_one_bad_port_does_not_fail_the_batch(spark):
    rows = [session_row(1, src_port=2**40), session_row(2)]
    got = {r[S.SESSION_ID]: r["src_port"] for r in session_features(sessions_df(spark, rows)).collect()}
    assert got == {1: None, 2: 40000}


def test_long_content_length_lists_are_linear(spark):
    import time

    from flowlens.functions.arrays import content_length_stats, empty_if_null, parse_content_length

    text = "[" + ",".join(str(i % 977) for i in range(20_000)) + "]"
    df = spark.createDataFrame([(text,)], "t string")
    stats = content_length_stats(empty_if_null(parse_content_length(F.col("t"))))
    out = df.select(*[c.alias(n) for n, c in stats.items()])
    out.collect()  # compiled
    began = time.time()
    row = out.collect()[0]
    assert time.time() - began < 2
    assert row["content_len_count"] == 20_000 and row["content_len_std"] > 0


def test_a_cluster_without_a_checkpoint_folder_is_an_error():
    from types import SimpleNamespace

    import pytest
    from flowlens.config import checkpoint_dir

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d: d))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(session)


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0 and len(df.columns) >= 74
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)


def test_observed_counts_without_extra_jobs(spark):
    from flowlens.plans.metrics import observed

    rows = [session_row(i, protocol="http" if i % 3 else "dns") for i in range(30)]
    feats, obs = observed(session_features(sessions_df(spark, rows)), "http_rows")
    feats.write.format("noop").mode("overwrite").save()  # the job that runs anyway
    assert obs.get == {"rows": 20}
