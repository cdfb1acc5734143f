"""How much of a staged table one task reads or writes."""

import __spark_entry__ as E
from flowlens.sources.files import child_names
from flowlens.sources import sessions as src
from pyspark.sql import functions as F

from .helpers import session_row, sessions_df


def _records(spark, n=40, tasks=8):
    return sessions_df(spark, [session_row(i, start=1_700_000_000_000 + 60_000 * i) for i in range(n)]).repartition(tasks)


def _parts(spark, path):
    return sorted(n for n in child_names(spark, path) if n.endswith(".parquet"))


def test_good_files_are_as_many_as_tasks_and_bad_ones_two(spark, workdir, monkeypatch):
    monkeypatch.setattr(E, "_sessions", lambda spark, sf_dir: _records(spark))
    E._good_and_bad_files(spark, "", f"{workdir}/in", (f"{workdir}/in/bad files", f"{workdir}/in/more"))
    assert len(_parts(spark, f"{workdir}/in")) == 8
    bad = [f"{workdir}/in/bad files", f"{workdir}/in/more"]
    assert [len(_parts(spark, d)) for d in bad] == [1, 1]
    assert spark.read.parquet(*bad).count() == 40  # every record once more
    good, report = src.read_valid_sessions(spark, f"{workdir}/in")
    assert good.select("session_id").distinct().count() == good.count() == 40
    assert [r.reason for r in report.collect()] == ["session.start_time: string != bigint"] * 2


def test_one_good_file_has_two_bad_ones(spark, workdir, monkeypatch):
    monkeypatch.setattr(E, "_sessions", lambda spark, sf_dir: _records(spark, tasks=1))
    E._good_and_bad_files(spark, "", f"{workdir}/chunk=0", (f"{workdir}/chunk=1", f"{workdir}/chunk=2"))
    assert len(_parts(spark, f"{workdir}/chunk=0")) == 1
    assert len(_parts(spark, f"{workdir}/chunk=1")) == 2
    assert spark.read.parquet(f"{workdir}/chunk=1").count() == 40


def test_stream_chunks_have_more_files_where_rows_are_more(spark, workdir, monkeypatch):
    monkeypatch.setattr(E, "CHUNK_FILE_ROWS", 5)
    rows = _records(spark, 60)
    folder, files = E._time_chunks(spark, rows, F.col("session.start_time"), workdir, chunks=3)
    assert files == 4
    for i in range(3):
        assert len(_parts(spark, f"{folder}/chunk={i:03d}")) == 4
    assert spark.read.parquet(folder).count() == 60
    assert E._time_chunks(spark, rows.limit(6), F.col("session.start_time"), f"{workdir}/few", chunks=3)[1] == 2
