import random

import pytest

from flowlens.operators import cooldown
from flowlens.operators.cooldown import spaced_rows

DDL = "src_ip string, dst_ip string, start_time long, session_id long, note string"


def expected(rows, gap):
    out, last = set(), {}
    for r in sorted(rows, key=lambda r: (r[2], r[3])):
        key = r[:2]
        if key not in last or r[2] > last[key] + gap:
            out.add(r[3])
            last[key] = r[2]
    return out


def spaced(spark, rows, gap, **kw):
    return spaced_rows(spark.createDataFrame(rows, DDL), ["src_ip", "dst_ip"], "start_time", "session_id", gap, **kw)


@pytest.mark.parametrize("few", [0, 20_000])
@pytest.mark.parametrize("shape", ["small pairs", "one hot pair", "ties", "dense then far"])
def test_equals_the_ordered_loop(spark, monkeypatch, few, shape):
    """In one task, and over ranges whose edges cut through pairs."""
    monkeypatch.setattr(cooldown, "FEW", few)
    rand = random.Random(shape)
    key = {"small pairs": lambda: (f"s{rand.randrange(60)}", rand.choice(["d", None])), "ties": lambda: ("s", rand.choice("ab"))}.get(shape)
    key = key or (lambda: ("hot", "d") if rand.random() < 0.8 else (rand.choice(["s", None]), "e"))
    time = {"ties": lambda: rand.randrange(30), "dense then far": lambda: rand.choice([rand.randrange(50), 10_000 + rand.randrange(50), 10_500])}.get(shape, lambda: rand.randrange(3000))
    rows = [(*key(), time(), i, "n") for i in range(1500)]
    for gap in (0, 5, 100, 1_000, 10**6):
        got = [r.session_id for r in spaced(spark, rows, gap).collect()]
        assert len(got) == len(set(got)) and set(got) == expected(rows, gap)


def test_a_hot_pair_is_walked_by_many_tasks_and_few_jobs(spark, monkeypatch):
    """A pair with all rows lies in every range; one that spans days takes no
    more jobs than one that spans minutes."""
    monkeypatch.setattr(cooldown, "FEW", 0)
    asked = []
    walk_again = cooldown._walk_again
    monkeypatch.setattr(cooldown, "_walk_again", lambda w, carried, *a: asked.append(len(carried)) or walk_again(w, carried, *a))
    rows = [("s", "d", i * 10, i, "") for i in range(4000)]
    out = spaced(spark, rows, 10**9)
    assert [r.session_id for r in out.collect()] == [0] and asked == []  # within the gap: nothing to walk again
    many = [(f"s{i % 400}", "d", i * 10, i, "") for i in range(4000)]
    got = {r.session_id for r in spaced(spark, many, 5).collect()}
    assert got == set(range(4000)) and len(asked) <= 1


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([("s", "d", 1, 1, 7), ("s", "d", 2, 2, 8)], "src_ip string, dst_ip string, start_time long, session_id long, kind int")
    out = spaced_rows(df, ["src_ip", "dst_ip"], "start_time", "session_id", 10)
    assert [tuple(r) for r in out.collect()] == [("s", "d", 1, 1, 7)] and out.columns == df.columns
    assert spaced_rows(df.limit(0), ["src_ip", "dst_ip"], "start_time", "session_id", 10).count() == 0
