"""Stand-in session records built from the driver's test tables.

The detector reads network-session Parquet files; the test data has none, so
``events`` and ``pages`` are projected into rows of the session schema (the
``sessions`` view defined in FIXTURES.md).  This module only shapes rows: it
computes no feature, score threshold, correlation or alert.

The same SQL text feeds Spark and the DuckDB oracle; only the epoch
millisecond expression differs between the two dialects.  The page of a
session is chosen with an equi-join on ``event_id % (SELECT count(*) FROM
pages)`` (no cross join; on Spark the count is taken once as a number).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S

_SESSIONS_SQL = """
SELECT e.event_id AS session_id,
 '10.0.0.' || CAST(e.user_id % 8 AS STRING) AS src_ip,
 CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE '203.0.113.' || CAST(e.user_id % 2 AS STRING) END AS dst_ip,
 1024 + e.event_id % 60000 AS src_port,
 CASE WHEN e.event_id % 3 = 0 THEN 8080 ELSE 80 END AS dst_port,
 'TCP' AS transport_protocol,
 CASE e.event_id % 5 WHEN 0 THEN 'SAPF' WHEN 1 THEN 'SAP' WHEN 2 THEN 'SR' WHEN 3 THEN 'sapCEU' ELSE NULL END AS src_flags,
 CASE e.event_id % 4 WHEN 0 THEN 'SAF' WHEN 1 THEN 'SAPE' WHEN 2 THEN '' ELSE 'UC' END AS dst_flags,
 CASE e.event_type WHEN 'click' THEN 'HTTP' WHEN 'view' THEN 'http' WHEN 'purchase' THEN 'Http' WHEN 'error' THEN 'dns' ELSE NULL END AS session_protocol,
 e.event_id % 4000 AS duration,
 e.event_id % 7 AS transmitted_packets,
 e.event_id % 11 AS received_packets,
 e.event_id % 7 + e.event_id % 11 AS total_packets,
 (e.event_id % 7) * (40 + e.event_id % 1400) AS transmitted_bytes,
 (e.event_id % 11) * (40 + e.event_id % 1300) AS received_bytes,
 (e.event_id % 7) * (40 + e.event_id % 1400) + (e.event_id % 11) * (40 + e.event_id % 1300) AS total_bytes,
 CASE WHEN e.event_id % 13 = 0 THEN NULL ELSE 40 + e.event_id % 1400 END AS client_max_pkt_size,
 CASE WHEN e.event_id % 17 = 0 THEN NULL ELSE 40 + e.event_id % 1300 END AS server_max_pkt_size,
 e.event_id % 500 AS client_average_interarrival_time,
 e.event_id % 450 AS server_average_interarrival_time,
 CASE WHEN e.event_id % 19 = 0 THEN NULL ELSE e.event_id % 120 END AS client_std_dev_interarrival_time,
 e.event_id % 110 AS server_std_dev_interarrival_time,
 (e.event_id % 5) * (e.event_id % 900) AS client_total_payload_size,
 (e.event_id % 6) * (e.event_id % 800) AS server_total_payload_size,
 e.event_id % 5 AS client_nonempty_packet_count,
 e.event_id % 6 AS server_nonempty_packet_count,
 e.event_id % 9 AS client_entropy,
 e.event_id % 8 AS server_entropy,
 {ms} AS start_time,
 CASE WHEN e.event_id % 23 = 0 THEN NULL ELSE split_part(split_part(p.url, '://', 2), '/', 1) END AS http_host,
 p.url AS http_get,
 CASE e.event_id % 4 WHEN 0 THEN 'text/html' WHEN 1 THEN 'application/json' WHEN 2 THEN '' ELSE NULL END AS http_content_type,
 CASE e.event_id % 4 WHEN 0 THEN 'aaaa' WHEN 1 THEN 'agent/é😀' ELSE 'agent/' || CAST(e.user_id AS STRING) END AS user_agent,
 CASE e.event_id % 3 WHEN 0 THEN 'nginx' WHEN 1 THEN 'Apache/2.4' ELSE NULL END AS http_server,
 CASE e.event_id % 8 WHEN 0 THEN NULL WHEN 1 THEN '[]' WHEN 2 THEN '[12.5]' WHEN 3 THEN 'abc' WHEN 4 THEN '[1,null,3]' WHEN 5 THEN '["7","8"]' WHEN 6 THEN '[' || CAST(e.event_id % 100 AS STRING) || ',250,3.5]' ELSE '[1.5' END AS http_content_length,
 e.value / (e.value + 10.0) AS malicious_score
FROM {events} e JOIN {pages} p ON p.page_id = e.event_id % {npages}
"""

_SPARK_MS = "CAST(floor(unix_millis(CAST(e.ts AS TIMESTAMP))/60000.0)*60000 AS BIGINT)"
_DUCKDB_MS = "CAST(floor(epoch_ms(e.ts)/60000.0)*60000 AS BIGINT)"


def duckdb_sessions_sql() -> str:
    """The flat ``sessions`` view for DuckDB (tables pre-registered by name)."""
    return _SESSIONS_SQL.format(ms=_DUCKDB_MS, events="events", pages="pages", npages="(SELECT count(*) FROM pages)")


def flat_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat ``sessions`` view on Spark, read from ``sf_dir``."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    # The page count is one number from a distributed count; it becomes a
    # literal modulus so the page lookup is a plain equi-join.
    npages = pages.count()
    text = _SESSIONS_SQL.format(ms=_SPARK_MS, events="{events}", pages="{pages}", npages=f"CAST({npages} AS BIGINT)")
    return spark.sql(text, events=events, pages=pages)


def _nest(flat: DataFrame) -> DataFrame:
    c = F.col
    session_cols = []
    for name, dtype in S.SESSION_FIELDS:
        src = "session_protocol" if name == "protocol" else name
        session_cols.append(c(src).cast(dtype).alias(name))
    return flat.select(
        c("session_id").cast("bigint").alias(S.SESSION_ID),
        F.struct(c("src_ip").alias("src_ip"), c("dst_ip").alias("dst_ip")).alias("network"),
        F.struct(
            c("src_port").cast("bigint").alias("src_port"),
            c("dst_port").cast("bigint").alias("dst_port"),
            c("transport_protocol").alias("protocol"),
            c("src_flags").alias("src_flags"),
            c("dst_flags").alias("dst_flags"),
        ).alias("transport"),
        F.struct(*session_cols).alias("session"),
        F.struct(*[c(f.name).alias(f.name) for f in S.PAYLOAD.fields]).alias("payload"),
        c("malicious_score").cast("double").alias(S.SCORE),
    )


def session_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested session records (declared schema + ``session_id`` and the
    fixture's stand-in ``malicious_score``)."""
    return _nest(flat_sessions(spark, sf_dir))
