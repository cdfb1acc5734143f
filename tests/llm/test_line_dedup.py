import collections
import hashlib
import random

import corpus_pipeline
import duckdb
import pytest
from flowlens.llm import line_dedup
from flowlens.llm.line_dedup import LineRuns, ORACLE_SQL, by_batch, dedup_lines, line_hashes, op1_line_dedup
from pyspark.sql import functions as F

from .data import awkward, empty

SPACES = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=20, min_docs=3):
    low = lambda i: -(2**63) if i is None else i
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACES))
    holders = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(low(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < min_docs or max(holders[key(x)]) == low(i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches", [1, 2, 6])
def test_matches_brute_force_at_any_number_of_batches(spark, batches):
    docs = awkward(spark, "keys int, n_lines string, doc string", (7, "mine", "d"))
    out = dedup_lines(docs, batches=batches, fanout=2)
    assert out.columns == [*docs.columns, "_n_lines", "n_dropped"]
    got = sorted(((r.doc_id, r._n_lines, r.n_dropped, r.text or "") for r in out.collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert {(r["keys"], r.n_lines, r.doc) for r in out.collect()} == {(7, "mine", "d")}


def test_empty_table(spark):
    assert dedup_lines(empty(spark)).count() == 0


def added_levels(monkeypatch):
    """Notes the level of every run written: those over 0 are compactions."""
    levels, add = [], LineRuns._add

    def noted(self, rows, level):
        levels.append(level)
        add(self, rows, level)

    monkeypatch.setattr(LineRuns, "_add", noted)
    return levels


def lines_of(n):
    rand = random.Random(n)
    line = lambda: f"a line long enough, number {rand.randrange(4 * n)}"
    return [(i, "\n".join(line() for _ in range(20))) for i in range(n)]


def test_levels_fill_in_the_query(spark, tmp_path, monkeypatch):
    rows = lines_of(40)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    levels = added_levels(monkeypatch)
    got = sorted(tuple(r) for r in op1_line_dedup(spark, str(tmp_path)).collect())
    assert levels == [0, 0, 0, 0, 1, 0]
    assert got == [(i, n, gone, hashlib.sha256(t.encode()).hexdigest()) for i, n, gone, t in sorted(brute(rows))]
    assert sum(r[2] for r in got)


def test_levels_fill_in_the_pipeline(spark, monkeypatch):
    levels = added_levels(monkeypatch)
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in lines_of(40)], "doc_id long, text string, n_chars long")
    assert corpus_pipeline.line_dedup(spark, docs, "").count() == 40
    assert 1 in levels


def test_batches_grow_with_the_lines(spark, monkeypatch):
    rows = lines_of(40)
    levels = added_levels(monkeypatch)
    monkeypatch.setattr(line_dedup, "_BUCKET_LINES", 300)
    out = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), fanout=2, batch_lines=100)
    assert levels.count(0) == 8 and max(levels) == 3
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect()), key=repr) == brute(rows)


def test_a_batch_meets_the_runs_without_shuffling_them(spark):
    pairs = line_hashes(spark.createDataFrame(lines_of(40), "doc_id long, text string"), "text", "doc_id", 20)
    high, low = by_batch(pairs, 2)
    assert {r.doc for r in high.select("doc").distinct().collect()} | {r.doc for r in low.select("doc").distinct().collect()} == set(range(40))
    assert high.agg(F.min("doc")).first()[0] > low.agg(F.max("doc")).first()[0]
    runs, plans = LineRuns(spark, buckets=3), []
    runs.ingest(high)
    write = runs._write
    runs._write = lambda rows: plans.append(rows._jdf.queryExecution().executedPlan().toString()) or write(rows)
    runs.ingest(low)
    runs.close()
    joined, below = plans[0].split("SortMergeJoin")
    assert "Broadcast" not in plans[0] and "Exchange" not in joined
    assert "Bucketed: true" in below and "Exchange" not in below[below.rindex("+- Sort") :]


def test_runs_keep_one_keeper_per_key_through_compaction(spark):
    docs = awkward(spark)
    pairs = line_hashes(docs, "text", "doc_id", 20)
    runs = LineRuns(spark, fanout=2)
    for low, high in ((6, 100), (3, 6), (1, 3), (-(2**63) - 0, 1)):
        runs.ingest(pairs.filter((F.col("doc") >= low) & (F.col("doc") < high)))
    assert max(len(level) for level in runs.levels) < 2
    got = {bytes(r.key): r.keeper for r in runs.frequent(1).collect()}
    want = {bytes(r.key): r.m for r in pairs.groupBy("key").agg(F.max("doc").alias("m")).collect()}
    assert got == want
    runs.close()


def test_query_sql_on_awkward_rows(spark):
    docs = awkward(spark).dropDuplicates(["doc_id"]).filter("doc_id IS NOT NULL")
    documents = docs.toPandas()  # noqa: F841
    want = sorted(duckdb.sql(ORACLE_SQL).fetchall())
    got = dedup_lines(docs).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in got) == want
