"""The pipeline against SQL or brute force, stage by stage, over whole tables."""

import hashlib
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from flowlens.llm import jaccard_join, line_dedup, quality_rules, queries

from .data import awkward
from .test_decontaminate import slow
from .test_packing import whole_ids

SF = "/root/testdata/sf0.001"


def sql(query, documents):
    return duckdb.sql(query).fetchall()


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.staged(stage(spark, out[-1], SF), "test-stage"))
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"]
    assert all(s.columns == stages[0].columns and s.dtypes == stages[0].dtypes for s in stages[1:5])


def test_quality_stage(stages):
    rows = sql(quality_rules.ORACLE_SQL, stages[0].toPandas())
    kept = {r[0] for r in rows if r[-1]}
    got = stages[1].toPandas()
    assert set(got.doc_id) == kept and 0 < len(kept) < stages[0].count()


def test_line_stage(stages):
    want = {(r[0], r[3]) for r in sql(line_dedup.ORACLE_SQL, stages[1].toPandas())}
    got = stages[2].toPandas()
    assert {(r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in got.itertuples()} == want
    assert (got.n_chars == got.text.str.len()).all()


def test_near_duplicate_stage(stages):
    want = {r[0] for r in sql(jaccard_join.ORACLE_SQL, stages[2].toPandas()) if r[0] == r[1]}
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted(want)


def test_decontamination_stage(spark, stages):
    bad = slow(stages[3], spark.read.parquet(f"{SF}/benchmark.parquet"))
    want = {r.doc_id for r in stages[3].collect()} - set(bad)
    assert {r.doc_id for r in stages[4].collect()} == want


def test_packing_stage(stages):
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    pieces = {}
    for r in stages[5].collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(texts)
    for i, own in pieces.items():
        ids = whole_ids(texts[i]) + [1]
        assert sum(p.length for p in own) == len(ids)
        assert all(p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], dtype="<u4").tobytes()) for p in own)


def test_run_is_the_stages_one_after_another(spark, stages):
    cut = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    whole = corpus_pipeline.run(spark, SF)
    assert whole.agg({"length": "sum"}).first() == stages[5].agg({"length": "sum"}).first()
    assert whole.select("doc_id").distinct().count() == stages[5].select("doc_id").distinct().count()
    assert set(cut) <= set(whole.columns)


def test_awkward_rows_pass_through_every_stage(spark):
    docs = awkward(spark, "n_chars long, kept string, items int", (1, "k", 2))
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.staged(stage(spark, docs, SF), "test-stage")
        if name != "packing":
            assert out.columns == docs.columns
            out.count()
        docs = out if name != "packing" else docs
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_sql(spark, name):
    got = queries.QUERIES[name](spark, SF)
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)
