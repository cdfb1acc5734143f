import random

import pytest

from flowlens.streaming.keyed import keyed_correlation

from .helpers import ordered_loop

SCHEMA = "session_id long, dst_ip string, start_time long, note string, port int, score double"
T0 = 1_700_000_000_000
MIN = 60_000


def _write(spark, workdir, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{workdir}/in/c={name}")


def _run(spark, workdir, **kw):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{workdir}/in")
    found = keyed_correlation(stream.drop("c"), **kw)
    query = found.writeStream.format("parquet").option("path", f"{workdir}/out").option("checkpointLocation", f"{workdir}/ck").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _rows(seed, n=240):
    rand = random.Random(seed)
    rows = [(i, rand.choice(["a", "b", None]), T0 + rand.randrange(0, 90) * MIN + rand.choice([0, 0, 1]), rand.choice([None, "x"]), rand.choice([None, 7]), 0.1 * i) for i in range(n)]
    return sorted(rows, key=lambda r: r[2] + rand.randrange(0, 8) * MIN)  # out of order within the lateness


def _want(rows):
    return {i: n for i, n in ordered_loop([r[:3] for r in rows]).items() if n >= 3}


@pytest.mark.parametrize("bucket_ms", [None, 120_000])
def test_equals_the_ordered_loop_after_a_restart(spark, workdir, bucket_ms):
    """Two runs over the same checkpoint; a closing row moves the watermark on,
    and nothing is left in the state but its own groups."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        rows = _rows(3)
        _write(spark, workdir, 0, rows[:100] + [(900, "late", None, None, None, 0.0)])
        _write(spark, workdir, 1, rows[100:140])
        _run(spark, workdir, bucket_ms=bucket_ms)
        _write(spark, workdir, 2, rows[140:])
        _write(spark, workdir, 3, [(901, "closing", T0 + 10_000 * MIN, None, None, 0.0)])
        query = _run(spark, workdir, bucket_ms=bucket_ms)
        out = spark.read.parquet(f"{workdir}/out").collect()
        assert len(out) == len({r.session_id for r in out}) and {r.session_id: r.hit_count for r in out} == _want(rows)
        back = {r[0]: r for r in rows}
        assert all(tuple(r)[:6] == back[r.session_id] for r in out)
        left = (600_000 // (bucket_ms or 600_000)) + 1  # the closing row's own bucket and those after it
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == left
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_a_bucket_must_divide_the_window(spark):
    with pytest.raises(ValueError):
        keyed_correlation(spark.createDataFrame([], SCHEMA), bucket_ms=7)
