"""DuckDB oracle SQL for the registered queries.

Each oracle restates an operator independently in SQL over the same parquet
tables (views ``events``, ``pages``, ... registered by the checker) and starts
from the same ``sessions`` stand-in view as the Spark side.
"""

from __future__ import annotations

from flowlens.sources.fixture import duckdb_sessions_sql

# Fixed values, written out here (not taken from the library), so that a wrong
# name, order or constant there cannot agree with itself.
FLAGS = [("FIN", "F"), ("SYN", "S"), ("RST", "R"), ("PSH", "P"), ("ACK", "A"), ("URG", "U"), ("CWE", "C"), ("ECE", "E")]
PAYLOAD = ["http_host", "http_get", "http_content_type", "user_agent", "http_server", "http_content_length"]
NUMERIC = (
    "Flow_Duration Total_Fwd_Packets Total_Backward_Packets Fwd_Packets_Length_Total Bwd_Packets_Length_Total "
    "Fwd_Packet_Length_Max Bwd_Packet_Length_Max Fwd_Packet_Length_Mean Bwd_Packet_Length_Mean "
    "Flow_Bytes_per_s Flow_Packets_per_s Flow_IAT_Mean Flow_IAT_Std Fwd_IAT_Mean Fwd_IAT_Std Bwd_IAT_Mean Bwd_IAT_Std "
    "Fwd_Packets_per_s Bwd_Packets_per_s Packet_Length_Max Packet_Length_Mean Packet_Length_Std Packet_Length_Variance "
    "Down_Up_Ratio Avg_Packet_Size Avg_Fwd_Segment_Size Avg_Bwd_Segment_Size "
    "Fwd_PSH_Flag_Count Bwd_PSH_Flag_Count Fwd_URG_Flag_Count Bwd_URG_Flag_Count "
    "FIN_Flag_Count SYN_Flag_Count RST_Flag_Count PSH_Flag_Count ACK_Flag_Count URG_Flag_Count CWE_Flag_Count ECE_Flag_Count "
    "request_body_entropy response_body_entropy "
    "content_len_min content_len_max content_len_sum content_len_count content_len_mean content_len_std"
).split()

D = "CAST({} AS DOUBLE)"


def _d(x: str) -> str:
    return D.format(x)


def ratio(n: str, d: str) -> str:
    return f"CASE WHEN {d} > 0 THEN {_d(n)} / {_d(d)} ELSE CAST(0 AS DOUBLE) END"


def flag(col: str, letter: str) -> str:
    return f"CASE WHEN contains({col}, '{letter}') THEN 1 ELSE 0 END"


def with_sessions(body: str, extra_ctes: str = "", recursive: bool = False) -> str:
    ctes = f"sessions AS ({duckdb_sessions_sql()})"
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{body}"


HTTP_WHERE = "lower(session_protocol) = 'http'"


def flow_exprs() -> list[tuple[str, str]]:
    dur = "(duration / CAST(1000 AS DOUBLE))"
    plm = ratio("total_bytes", "total_packets")
    cm = ratio("client_total_payload_size", "client_nonempty_packet_count")
    sm = ratio("server_total_payload_size", "server_nonempty_packet_count")
    var = f"((({cm}) - ({plm})) * (({cm}) - ({plm})) + (({sm}) - ({plm})) * (({sm}) - ({plm}))) / CAST(2 AS DOUBLE)"
    return [
        ("src_ip", "src_ip"),
        ("dst_ip", "dst_ip"),
        ("src_port", "CAST(src_port AS INTEGER)"),
        ("dst_port", "CAST(dst_port AS INTEGER)"),
        ("protocol", "transport_protocol"),
        ("Flow_Duration", "duration"),
        ("Total_Fwd_Packets", "transmitted_packets"),
        ("Total_Backward_Packets", "received_packets"),
        ("Fwd_Packets_Length_Total", "transmitted_bytes"),
        ("Bwd_Packets_Length_Total", "received_bytes"),
        ("Fwd_Packet_Length_Max", "client_max_pkt_size"),
        ("Bwd_Packet_Length_Max", "server_max_pkt_size"),
        ("Fwd_Packet_Length_Mean", ratio("transmitted_bytes", "transmitted_packets")),
        ("Bwd_Packet_Length_Mean", ratio("received_bytes", "received_packets")),
        ("Duration_sec", dur),
        ("Flow_Bytes_per_s", ratio("total_bytes", dur)),
        ("Flow_Packets_per_s", ratio("total_packets", dur)),
        (
            "Flow_IAT_Mean",
            f"({_d('transmitted_packets')} * {_d('client_std_dev_interarrival_time')} + "
            f"{_d('received_packets')} * {_d('server_std_dev_interarrival_time')}) / CAST(2 AS DOUBLE)",
        ),
        (
            "Flow_IAT_Std",
            f"({_d('transmitted_packets')} * {_d('client_average_interarrival_time')} + "
            f"{_d('received_packets')} * {_d('server_average_interarrival_time')}) / CAST(3 AS DOUBLE)",
        ),
        ("Fwd_IAT_Mean", "client_average_interarrival_time"),
        ("Fwd_IAT_Std", "client_std_dev_interarrival_time"),
        ("Bwd_IAT_Mean", "server_average_interarrival_time"),
        ("Bwd_IAT_Std", "server_std_dev_interarrival_time"),
        ("Fwd_Packets_per_s", ratio("transmitted_packets", dur)),
        ("Bwd_Packets_per_s", ratio("received_packets", dur)),
        ("Packet_Length_Max", f"greatest({_d('client_max_pkt_size')}, {_d('server_max_pkt_size')})"),
        ("Packet_Length_Mean", plm),
        ("client_mean", cm),
        ("server_mean", sm),
        ("Packet_Length_Variance", var),
        ("Packet_Length_Std", f"sqrt({var})"),
        ("Down_Up_Ratio", ratio("received_packets", "transmitted_packets")),
        ("Avg_Packet_Size", plm),
        ("Avg_Fwd_Segment_Size", cm),
        ("Avg_Bwd_Segment_Size", sm),
    ]


def flag_exprs() -> list[tuple[str, str]]:
    out = []
    for side, col in (("Fwd", "src_flags"), ("Bwd", "dst_flags")):
        for name, letter in FLAGS:
            out.append((f"{side}_{name}_Flag_Count", flag(col, letter)))
    for name, letter in FLAGS:
        out.append((f"{name}_Flag_Count", f"({flag('src_flags', letter)}) + ({flag('dst_flags', letter)})"))
    return out


def http_exprs() -> list[tuple[str, str]]:
    out = [("request_body_entropy", "client_entropy"), ("response_body_entropy", "server_entropy")]
    out += [(n, n) for n in PAYLOAD]
    out.append(("start_time", "start_time"))
    return out


PARSED = (
    "COALESCE(CASE WHEN http_content_length LIKE '%\"%' THEN NULL "
    "ELSE TRY_CAST(http_content_length AS DOUBLE[]) END, CAST([] AS DOUBLE[]))"
)


def content_length_exprs(arr: str = "cl_arr") -> list[tuple[str, str]]:
    n = f"CAST(len({arr}) AS INTEGER)"
    total = f"list_reduce({arr}, lambda acc, x: acc + x, CAST(0 AS DOUBLE))"
    mean = f"CASE WHEN {n} > 0 THEN ({total}) / {n} ELSE CAST(0 AS DOUBLE) END"
    sq = f"list_reduce(list_transform({arr}, lambda x: (x - ({mean})) * (x - ({mean}))), lambda acc, x: acc + x, CAST(0 AS DOUBLE))"
    return [
        ("content_len_min", f"CASE WHEN {n} > 0 THEN list_min({arr}) ELSE CAST(0 AS DOUBLE) END"),
        ("content_len_max", f"CASE WHEN {n} > 0 THEN list_max({arr}) ELSE CAST(0 AS DOUBLE) END"),
        ("content_len_sum", total),
        ("content_len_count", n),
        ("content_len_mean", mean),
        ("content_len_std", f"CASE WHEN {n} > 1 THEN sqrt(({sq}) / ({n} - 1)) ELSE CAST(0 AS DOUBLE) END"),
    ]


def select_list(pairs: list[tuple[str, str]]) -> str:
    return ",\n ".join(f"{expr} AS {name}" for name, expr in pairs)


def feature_cte(source: str = "sessions") -> str:
    """``feat``: HTTP sessions of ``source`` with all 74 flat features (+ id
    and score)."""
    inner = select_list(flow_exprs() + flag_exprs() + http_exprs())
    base = (
        f"flat AS (SELECT session_id, malicious_score, {PARSED} AS cl_arr,\n {inner}\n"
        f" FROM {source} WHERE {HTTP_WHERE})"
    )
    stats = select_list(content_length_exprs())
    feat = f"feat AS (SELECT * EXCLUDE (cl_arr), {stats} FROM flat)"
    return base + ",\n" + feat


def coalesce_empty(col: str) -> str:
    return f"COALESCE({col}, '')"


def entropy_sql(col: str) -> str:
    """Shannon entropy (bits) over the code points of ``col``; '' -> 0."""
    return (
        f"COALESCE((SELECT -sum((cnt / n) * log2(cnt / n)) FROM "
        f"(SELECT CAST(count(*) AS DOUBLE) AS cnt, CAST(length({col}) AS DOUBLE) AS n "
        f"FROM unnest(regexp_extract_all({col}, '(?s).')) AS t(ch) GROUP BY ch)), CAST(0 AS DOUBLE)) + CAST(0 AS DOUBLE)"
    )


def hot_cte(threshold: float = 0.8) -> str:
    """``hot``: HTTP sessions above the score threshold (alert columns)."""
    return (
        "hot AS (SELECT session_id, src_ip, dst_ip, CAST(src_port AS INTEGER) AS src_port, "
        "CAST(dst_port AS INTEGER) AS dst_port, duration AS Flow_Duration, start_time, malicious_score "
        f"FROM sessions WHERE {HTTP_WHERE} AND malicious_score > CAST({threshold} AS DOUBLE))"
    )


def confirmed_cte(window_ms: int = 600_000, repeat: int = 3) -> str:
    """``confirmed``: the ordered trailing-window count restated with window
    functions (range frame minus the later peers at the same instant)."""
    return (
        hot_cte()
        + ",\ncnt AS (SELECT *, count(*) OVER (PARTITION BY dst_ip ORDER BY start_time "
        f"RANGE BETWEEN {window_ms} PRECEDING AND CURRENT ROW) - (count(*) OVER (PARTITION BY dst_ip, start_time) "
        "- row_number() OVER (PARTITION BY dst_ip, start_time ORDER BY session_id)) AS hit_count "
        "FROM hot WHERE start_time IS NOT NULL),\n"
        f"confirmed AS (SELECT * FROM cnt WHERE hit_count >= {repeat})"
    )


def first_cte(source: str = "confirmed") -> str:
    return (
        f"first_pair AS (SELECT * EXCLUDE (rn, hit_count) FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY src_ip, dst_ip ORDER BY start_time, session_id) AS rn FROM {source}) WHERE rn = 1)"
    )


def alert_view(source: str) -> str:
    """Flat alert rows built from ``source`` (stamped at the session start)."""
    return (
        f"SELECT 'http' AS protocol, Flow_Duration AS session_duration, src_ip, dst_ip, src_port, dst_port, "
        "malicious_score AS score, 'ML HTTP_TUNNEL Alert' AS rule_name, 'http-tunnel' AS alert_type, "
        "'Suspicious tunnelling Anomaly' AS alert_category, 1 AS priority, "
        "'HTTP tunnel  Anomaly' AS alert_description, session_id, start_time, start_time AS alert_ms "
        f"FROM {source}"
    )


def document_view(source: str) -> str:
    """``alert_view`` without the columns that alert documents do not have."""
    return f"SELECT * EXCLUDE (session_id, start_time) FROM ({alert_view(source)})"


def cooldown_cte(source: str = "confirmed") -> str:
    """``alerting``: per pair the first confirmed row, then each time the
    first one more than 24 h (86,400,000 ms) after the last alert."""
    pair = "n.src_ip IS NOT DISTINCT FROM {0}.src_ip AND n.dst_ip IS NOT DISTINCT FROM {0}.dst_ip"
    return (
        f"ranked AS (SELECT * EXCLUDE (hit_count), row_number() OVER (PARTITION BY src_ip, dst_ip ORDER BY start_time, session_id) AS rn FROM {source}),\n"
        "chained AS (SELECT c.*, (SELECT min(n.rn) FROM ranked n WHERE " + pair.format("c") + " AND n.start_time > c.start_time + 86400000) AS next_rn FROM ranked c),\n"
        "alerting AS (SELECT * FROM chained WHERE rn = 1 UNION ALL SELECT n.* FROM alerting a JOIN chained n ON " + pair.format("a") + " AND n.rn = a.next_rn)"
    )


#: The model's numeric inputs and text fields, written out here so that a
#: wrong name in the library cannot agree with itself.
TEXT = ["http_host", "http_get", "http_content_type", "user_agent", "http_server"]


def unigram_digest_sql() -> str:
    parts = " UNION ALL ".join(f"SELECT session_id, '{f}' AS field, COALESCE({f}, '') AS txt FROM feat" for f in TEXT)
    return (
        "SELECT session_id, field, CAST(len(list_distinct(hs)) AS INTEGER) AS n_bins, CAST(len(hs) AS BIGINT) AS n_bytes, "
        "CAST(coalesce(list_sum(list_transform(hs, lambda h: CAST('0x' || h AS INTEGER))), 0) AS BIGINT) AS moment "
        f"FROM (SELECT session_id, field, regexp_extract_all(hex(encode(txt)), '[0-9A-F]{{2}}') AS hs FROM ({parts}))"
    )


def assembled_sql() -> str:
    scalars = " + ".join(impute_sql(c) for c in NUMERIC)
    texts = " + ".join(f"length(coalesce({f}, '')) + {entropy_sql(coalesce_empty(f))}" for f in TEXT)
    bins = " + ".join(f"len(list_distinct(regexp_extract_all(hex(encode(coalesce({f}, ''))), '[0-9A-F]{{2}}')))" for f in TEXT)
    return (
        f"SELECT session_id, 1337 AS width, round({scalars} + {texts}, 4) AS scalar_total, CAST({bins} AS INTEGER) AS n_bins FROM feat"
    )


def ms(ts: str) -> str:
    return f"epoch_ms(TIMESTAMP '{ts}')"


def impute_sql(col: str) -> str:
    d = _d(col)
    return f"CASE WHEN {d} IS NULL OR isnan({d}) OR isinf({d}) THEN CAST(0 AS DOUBLE) ELSE {d} END"


def unigram_long_sql(fields: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT session_id, '{f}' AS field, COALESCE({f}, '') AS txt FROM feat" for f in fields
    )
    return (
        "SELECT session_id, field, CAST(('0x' || h) AS INTEGER) AS byte_value, count(*) AS byte_count, "
        "count(*) / max(CAST(strlen(txt) AS DOUBLE)) AS frequency "
        f"FROM (SELECT session_id, field, txt, unnest(regexp_extract_all(hex(encode(txt)), '[0-9A-F]{{2}}')) AS h "
        f"FROM ({parts})) GROUP BY session_id, field, h"
    )
