"""Registered queries against their DuckDB oracles (the driver's check, in
pytest): row count, column names and the order-insensitive row multiset."""

import math

import duckdb
import pytest

SF = "/root/testdata/sf0.01"
KEYS = [
    "flatten_sessions",
    "content_length_stats",
    "text_entropy",
    "unigram_long",
    "temporal_correlation",
    "first_alert_per_pair",
    "suppress_known",
    "alert_cooldown",
    "stage_counts",
    "alert_retention",
    "alert_drop",
    "alert_json_sink",
    "alert_export_stream",
    "unigram_vector",
    "assemble_features",
    "quarantine",
    "stream_cooldown",
]


def _norm(v):
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events", "pages", "documents", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    import __spark_entry__ as E

    sdf = E.queries()[key](spark, SF)
    odf = con.execute(E.oracle_sql()[key]).fetch_df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    orows = sorted((tuple(_norm(r[c]) for c in cols) for r in odf.to_dict("records")), key=repr)
    assert len(srows) == len(orows)
    assert srows == orows
