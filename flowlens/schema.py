"""Declared schemas, feature name lists and fixed detector constants.

Everything in this module is data, not logic: the nested session record
the detector reads, the alert record it writes, the ordered lists of
feature names the model consumes, and the constants that must equal the
original detector's values for results to agree.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values that must equal the original detector's (do not edit).
# --------------------------------------------------------------------------

# --------------------------------------------------------------------------
# Input: one row per network session, four nested structs.
# Times are epoch milliseconds (BIGINT); entropies arrive as integers.
# --------------------------------------------------------------------------

_L = T.LongType()
_S = T.StringType()

NETWORK = T.StructType([T.StructField("src_ip", _S), T.StructField("dst_ip", _S)])

TRANSPORT = T.StructType(
    [
        T.StructField("src_port", _L),
        T.StructField("dst_port", _L),
        T.StructField("protocol", _S),
        T.StructField("src_flags", _S),
        T.StructField("dst_flags", _S),
    ]
)

SESSION_FIELDS = [
    ("duration", _L),
    ("total_bytes", _L),
    ("transmitted_bytes", _L),
    ("received_bytes", _L),
    ("total_packets", _L),
    ("transmitted_packets", _L),
    ("received_packets", _L),
    ("client_max_pkt_size", _L),
    ("server_max_pkt_size", _L),
    ("client_average_interarrival_time", _L),
    ("server_average_interarrival_time", _L),
    ("client_std_dev_interarrival_time", _L),
    ("server_std_dev_interarrival_time", _L),
    ("client_total_payload_size", _L),
    ("server_total_payload_size", _L),
    ("client_nonempty_packet_count", _L),
    ("server_nonempty_packet_count", _L),
    ("protocol", _S),
    ("start_time", _L),
    ("client_entropy", _L),
    ("server_entropy", _L),
]
SESSION_STRUCT = T.StructType([T.StructField(n, t) for n, t in SESSION_FIELDS])

PAYLOAD = T.StructType(
    [
        T.StructField(n, _S)
        for n in (
            "http_host",
            "http_get",
            "http_content_type",
            "user_agent",
            "http_server",
            "http_content_length",
        )
    ]
)

#: The declared schema of a session record file (all fields nullable).
SESSION = T.StructType(
    [
        T.StructField("network", NETWORK),
        T.StructField("transport", TRANSPORT),
        T.StructField("session", SESSION_STRUCT),
        T.StructField("payload", PAYLOAD),
    ]
)

#: Optional top-level columns carried when present: a stable row key and a
#: precomputed score (used by the fixture before a model exists).
SESSION_ID = "session_id"
SCORE = "malicious_score"

SESSION_WITH_KEYS = T.StructType(
    [T.StructField(SESSION_ID, _L)] + list(SESSION.fields) + [T.StructField(SCORE, T.DoubleType())]
)

# --------------------------------------------------------------------------
# Feature names and detector constants.
# --------------------------------------------------------------------------

# Text fields that get length, entropy and byte-frequency features, in order.
TEXT_FIELDS = ["http_host", "http_get", "http_content_type", "user_agent", "http_server"]

# TCP flag letters and feature names, in the original order.
FLAG_LETTERS = [
    ("FIN", "F"),
    ("SYN", "S"),
    ("RST", "R"),
    ("PSH", "P"),
    ("ACK", "A"),
    ("URG", "U"),
    ("CWE", "C"),
    ("ECE", "E"),
]

# Model inputs: the 41 flow/flag/entropy features, in the original order.
FLOW_MODEL_FEATURES = [
    "Flow_Duration", "Total_Fwd_Packets", "Total_Backward_Packets",
    "Fwd_Packets_Length_Total", "Bwd_Packets_Length_Total",
    "Fwd_Packet_Length_Max", "Bwd_Packet_Length_Max",
    "Fwd_Packet_Length_Mean", "Bwd_Packet_Length_Mean",
    "Flow_Bytes_per_s", "Flow_Packets_per_s",
    "Flow_IAT_Mean", "Flow_IAT_Std", "Fwd_IAT_Mean", "Fwd_IAT_Std",
    "Bwd_IAT_Mean", "Bwd_IAT_Std",
    "Fwd_Packets_per_s", "Bwd_Packets_per_s",
    "Packet_Length_Max", "Packet_Length_Mean", "Packet_Length_Std", "Packet_Length_Variance",
    "Down_Up_Ratio", "Avg_Packet_Size", "Avg_Fwd_Segment_Size", "Avg_Bwd_Segment_Size",
    "Fwd_PSH_Flag_Count", "Bwd_PSH_Flag_Count", "Fwd_URG_Flag_Count", "Bwd_URG_Flag_Count",
    "FIN_Flag_Count", "SYN_Flag_Count", "RST_Flag_Count",
    "PSH_Flag_Count", "ACK_Flag_Count", "URG_Flag_Count",
    "CWE_Flag_Count", "ECE_Flag_Count", "request_body_entropy", "response_body_entropy",
]

# Model inputs: the six content-length statistics, in the original order.
CONTENT_LENGTH_FEATURES = [
    "content_len_min", "content_len_max", "content_len_sum",
    "content_len_count", "content_len_mean", "content_len_std",
]

# The 52 names the model selects (47 numeric + 5 text), original order.
MODEL_FEATURES = FLOW_MODEL_FEATURES + TEXT_FIELDS + CONTENT_LENGTH_FEATURES
NUMERIC_MODEL_FEATURES = FLOW_MODEL_FEATURES + CONTENT_LENGTH_FEATURES

UNIGRAM_BINS = 256

# Detector defaults.
DEFAULT_THRESHOLD = 0.8          # strict ">" on the class-1 probability
CORRELATION_WINDOW_MS = 600_000  # trailing window, 600 s, inclusive at both ends
REPEAT_THRESHOLD = 3             # hits on one dst_ip inside the window, self included
ALERT_RETENTION_MINUTES = 1440   # alerts older than this are dropped / may re-fire

# Alert constants.
ALERT_PROTOCOL = "http"
ALERT_RULE_NAME = "ML HTTP_TUNNEL Alert"
ALERT_TYPE = "http-tunnel"
ALERT_CATEGORY = "Suspicious tunnelling Anomaly"
ALERT_PRIORITY = 1
ALERT_DESCRIPTION = "HTTP tunnel  Anomaly"

# --------------------------------------------------------------------------
# Output: one alert.
# --------------------------------------------------------------------------

ALERT = T.StructType(
    [
        T.StructField(
            "match_body",
            T.StructType(
                [
                    T.StructField(
                        "session",
                        T.StructType(
                            [T.StructField("protocol", _S), T.StructField("session_duration", _L)]
                        ),
                    ),
                    T.StructField("network", NETWORK),
                    T.StructField(
                        "transport",
                        T.StructType(
                            [T.StructField("src_port", T.IntegerType()), T.StructField("dst_port", T.IntegerType())]
                        ),
                    ),
                ]
            ),
        ),
        T.StructField("score", T.DoubleType()),
        T.StructField("rule_name", _S),
        T.StructField("alert_type", _S),
        T.StructField("alert_category", _S),
        T.StructField("priority", T.IntegerType()),
        T.StructField("alert_description", _S),
    ]
)

#: Alert table row: the alert plus bookkeeping columns used for retention,
#: export and idempotent writes.
ALERT_ROW = T.StructType(
    list(ALERT.fields)
    + [
        T.StructField(SESSION_ID, _L),
        T.StructField("start_time", _L),
        T.StructField("alert_ts", T.TimestampType()),
        T.StructField("alert_date", T.DateType()),
        T.StructField("writer", T.StringType()),
        T.StructField("batch_id", _L),
    ]
)
