import random

import pytest
from flowlens.operators.correlate import hit_counts, temporal_correlation

from .helpers import ordered_loop

SCHEMA = "session_id long, dst_ip string, start_time long"


def _random_rows(n, seed, keys=("a", "b", None), hot=None, spread_ms=3_600_000):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = hot if hot is not None and rnd.random() < 0.6 else rnd.choice(keys)
        # coarse times force ties; exact 600 s gaps happen often
        t = 1_700_000_000_000 + rnd.randrange(0, spread_ms // 60_000) * 60_000 + rnd.choice([0, 0, 1, 999])
        if rnd.random() < 0.03:
            t = None
        rows.append((i, key, t))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("bucket_ms", [1000, 7, 600_000, 250_000])
def test_hit_counts_equal_ordered_loop(spark, bucket_ms):
    rows = _random_rows(600, seed=bucket_ms)
    expected = ordered_loop(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r["session_id"]: r["hit_count"] for r in hit_counts(df, bucket_ms=bucket_ms).collect()}
    assert got == expected


def test_hot_destination_same_answer(spark):
    rows = _random_rows(1500, seed=7, hot="hot")
    expected = ordered_loop(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["session_id"]: r["hit_count"] for r in hit_counts(df).collect()}
    assert got == expected




def test_edges(spark):
    t0 = 1_700_000_000_000
    rows = [
        (1, "d", t0),
        (2, "d", t0 + 600_000),  # exactly one window later: counts t0
        (3, "d", t0 + 600_000),  # tie: sees 1, 2 and itself
        (4, "d", t0 + 600_001),  # t0 fell out
        (5, None, t0),
        (6, None, t0),
        (7, None, t0),  # NULL destination is one group
        (8, "d", None),  # NULL time never confirms
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["session_id"]: r["hit_count"] for r in hit_counts(df).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 3, 5: 1, 6: 2, 7: 3}
    confirmed = {r["session_id"] for r in temporal_correlation(df).collect()}
    assert confirmed == {3, 4, 7}


def test_permutation_and_partitioning_invariant(spark):
    rows = _random_rows(300, seed=11)
    a = {tuple(r) for r in temporal_correlation(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()}
    b = {tuple(r) for r in temporal_correlation(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7)).collect()}
    assert a == b


def test_plan_never_groups_by_destination_alone(spark):
    df = spark.createDataFrame(_random_rows(50, seed=3), SCHEMA)
    plan = temporal_correlation(df)._jdf.queryExecution().executedPlan().toString()
    # the big shuffle is keyed by (destination, time bucket)
    assert "_cor_b" in plan and "hashpartitioning(_cor_kn" in plan
