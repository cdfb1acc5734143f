"""Session features: HTTP filter, flattening and the 74 flat feature columns.

All operators are ``DataFrame -> DataFrame`` over native column expressions,
so the whole feature stage is one projection inside whole-stage codegen, and
Catalyst prunes the nested scan down to the struct fields actually used.

Formulas keep the original detector's definitions, including two that do not
match their names (kept because they are model inputs):
``Flow_IAT_Mean`` = (tx_packets * client_std_iat + rx_packets * server_std_iat) / 2
and ``Flow_IAT_Std`` = (tx_packets * client_avg_iat + rx_packets * server_avg_iat) / 3.
Rates use ``Duration_sec`` = duration_ms / 1000 computed once, and
``start_time`` stays BIGINT epoch milliseconds (no narrowing cast).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.arrays import content_length_stats as _cl_stats
from ..functions.arrays import empty_if_null, parse_content_length
from ..functions.columns import flag_present, ratio

_PASSTHROUGH = (S.SESSION_ID, S.SCORE)


def _passthrough(df: DataFrame) -> list[Column]:
    return [F.col(c) for c in _PASSTHROUGH if c in df.columns]


#: Every letter-case spelling of "http" (the only strings whose lower case is
#: "http").  As an IN-list the predicate reaches the Parquet reader, which can
#: skip row groups and files without HTTP traffic; ``lower()`` cannot.
HTTP_SPELLINGS = sorted(
    "".join(c.upper() if (mask >> i) & 1 else c for i, c in enumerate("http")) for mask in range(16)
)


def http_filter(sessions: DataFrame) -> DataFrame:
    """Keep sessions whose ``session.protocol`` is ``http`` in any letter case
    (``transport.protocol`` is not consulted)."""
    proto = F.col("session.protocol")
    return sessions.filter(proto.isin(HTTP_SPELLINGS) & (F.lower(proto) == F.lit("http")))


def _flow_columns() -> list[tuple[str, Column]]:
    s = lambda name: F.col(f"session.{name}")
    dur_sec = s("duration") / F.lit(1000.0)
    tx_p, rx_p = s("transmitted_packets"), s("received_packets")
    plm = ratio(s("total_bytes"), s("total_packets"))
    client_mean = ratio(s("client_total_payload_size"), s("client_nonempty_packet_count"))
    server_mean = ratio(s("server_total_payload_size"), s("server_nonempty_packet_count"))
    variance = ((client_mean - plm) * (client_mean - plm) + (server_mean - plm) * (server_mean - plm)) / F.lit(2.0)
    return [
        ("src_ip", F.col("network.src_ip")),
        ("dst_ip", F.col("network.dst_ip")),
        ("src_port", F.col("transport.src_port").try_cast("int")),
        ("dst_port", F.col("transport.dst_port").try_cast("int")),
        ("protocol", F.col("transport.protocol")),
        ("Flow_Duration", s("duration")),
        ("Total_Fwd_Packets", tx_p),
        ("Total_Backward_Packets", rx_p),
        ("Fwd_Packets_Length_Total", s("transmitted_bytes")),
        ("Bwd_Packets_Length_Total", s("received_bytes")),
        ("Fwd_Packet_Length_Max", s("client_max_pkt_size")),
        ("Bwd_Packet_Length_Max", s("server_max_pkt_size")),
        ("Fwd_Packet_Length_Mean", ratio(s("transmitted_bytes"), tx_p)),
        ("Bwd_Packet_Length_Mean", ratio(s("received_bytes"), rx_p)),
        ("Duration_sec", dur_sec),
        ("Flow_Bytes_per_s", ratio(s("total_bytes"), dur_sec)),
        ("Flow_Packets_per_s", ratio(s("total_packets"), dur_sec)),
        (
            "Flow_IAT_Mean",
            (
                tx_p.cast("double") * s("client_std_dev_interarrival_time").cast("double")
                + rx_p.cast("double") * s("server_std_dev_interarrival_time").cast("double")
            )
            / F.lit(2.0),
        ),
        (
            "Flow_IAT_Std",
            (
                tx_p.cast("double") * s("client_average_interarrival_time").cast("double")
                + rx_p.cast("double") * s("server_average_interarrival_time").cast("double")
            )
            / F.lit(3.0),
        ),
        ("Fwd_IAT_Mean", s("client_average_interarrival_time")),
        ("Fwd_IAT_Std", s("client_std_dev_interarrival_time")),
        ("Bwd_IAT_Mean", s("server_average_interarrival_time")),
        ("Bwd_IAT_Std", s("server_std_dev_interarrival_time")),
        ("Fwd_Packets_per_s", ratio(tx_p, dur_sec)),
        ("Bwd_Packets_per_s", ratio(rx_p, dur_sec)),
        (
            "Packet_Length_Max",
            F.greatest(s("client_max_pkt_size").cast("double"), s("server_max_pkt_size").cast("double")),
        ),
        ("Packet_Length_Mean", plm),
        ("client_mean", client_mean),
        ("server_mean", server_mean),
        ("Packet_Length_Variance", variance),
        ("Packet_Length_Std", F.sqrt(variance)),
        ("Down_Up_Ratio", ratio(rx_p, tx_p)),
        ("Avg_Packet_Size", plm),
        ("Avg_Fwd_Segment_Size", client_mean),
        ("Avg_Bwd_Segment_Size", server_mean),
    ]


def _flag_columns() -> list[tuple[str, Column]]:
    out: list[tuple[str, Column]] = []
    for side, field in (("Fwd", "transport.src_flags"), ("Bwd", "transport.dst_flags")):
        for name, letter in S.FLAG_LETTERS:
            out.append((f"{side}_{name}_Flag_Count", flag_present(F.col(field), letter)))
    for name, letter in S.FLAG_LETTERS:
        fwd = flag_present(F.col("transport.src_flags"), letter)
        bwd = flag_present(F.col("transport.dst_flags"), letter)
        out.append((f"{name}_Flag_Count", fwd + bwd))
    return out


def _http_columns() -> list[tuple[str, Column]]:
    out = [
        ("request_body_entropy", F.col("session.client_entropy")),
        ("response_body_entropy", F.col("session.server_entropy")),
    ]
    out += [(f.name, F.col(f"payload.{f.name}")) for f in S.PAYLOAD.fields]
    out.append(("start_time", F.col("session.start_time")))
    return out


FLOW_COLUMNS = [
    "src_ip", "dst_ip", "src_port", "dst_port", "protocol",
    "Flow_Duration", "Total_Fwd_Packets", "Total_Backward_Packets",
    "Fwd_Packets_Length_Total", "Bwd_Packets_Length_Total",
    "Fwd_Packet_Length_Max", "Bwd_Packet_Length_Max",
    "Fwd_Packet_Length_Mean", "Bwd_Packet_Length_Mean", "Duration_sec",
    "Flow_Bytes_per_s", "Flow_Packets_per_s", "Flow_IAT_Mean", "Flow_IAT_Std",
    "Fwd_IAT_Mean", "Fwd_IAT_Std", "Bwd_IAT_Mean", "Bwd_IAT_Std",
    "Fwd_Packets_per_s", "Bwd_Packets_per_s", "Packet_Length_Max", "Packet_Length_Mean",
    "client_mean", "server_mean", "Packet_Length_Variance", "Packet_Length_Std",
    "Down_Up_Ratio", "Avg_Packet_Size", "Avg_Fwd_Segment_Size", "Avg_Bwd_Segment_Size",
]
FLAG_COLUMNS = [f"{side}_{n}_Flag_Count" for side in ("Fwd", "Bwd") for n, _ in S.FLAG_LETTERS] + [
    f"{n}_Flag_Count" for n, _ in S.FLAG_LETTERS
]
HTTP_COLUMNS = ["request_body_entropy", "response_body_entropy"] + [f.name for f in S.PAYLOAD.fields] + ["start_time"]
FLAT_COLUMNS = FLOW_COLUMNS + FLAG_COLUMNS + HTTP_COLUMNS  # the 68 flat columns


def _select(df: DataFrame, cols: list[tuple[str, Column]]) -> DataFrame:
    return df.select(*_passthrough(df), *[c.alias(n) for n, c in cols])


def flow_features(sessions: DataFrame) -> DataFrame:
    """Addresses, ports, volumes, means, rates, IAT and packet-length
    statistics."""
    return _select(sessions, _flow_columns())


def flag_features(sessions: DataFrame) -> DataFrame:
    """Per-side flag presence (0/1) and their per-flag sums (0..2)."""
    return _select(sessions, [("src_ip", F.col("network.src_ip")), ("dst_ip", F.col("network.dst_ip"))] + _flag_columns())


def http_fields(sessions: DataFrame) -> DataFrame:
    """Body entropies, the six payload strings and ``start_time``."""
    return _select(sessions, _http_columns())


def flatten_sessions(sessions: DataFrame) -> DataFrame:
    """The 68 flat feature columns of a nested session frame (no filter)."""
    return _select(sessions, _flow_columns() + _flag_columns() + _http_columns())


def with_content_length_stats(flat: DataFrame) -> DataFrame:
    """Parse ``http_content_length`` and append its six statistics."""
    arr = empty_if_null(parse_content_length(F.col("http_content_length")))
    staged = flat.withColumn("_cl_arr", arr)
    stats = _cl_stats(F.col("_cl_arr"))
    return staged.withColumns(stats).drop("_cl_arr")


def session_features(sessions: DataFrame) -> DataFrame:
    """HTTP filter, then the 68 flat columns and the 6 content-length
    statistics (74 columns, plus ``session_id``/``malicious_score`` when the
    input carries them)."""
    return with_content_length_stats(flatten_sessions(http_filter(sessions)))
