import math

from flowlens import schema as S
from flowlens.operators import features as feat
from flowlens.operators import matrix as mx

from .helpers import session_row, sessions_df


def _one(spark, **kw):
    df = sessions_df(spark, [session_row(1, **kw)])
    return feat.session_features(df).collect()[0]


def test_http_filter_is_case_insensitive_on_session_protocol(spark):
    rows = [
        session_row(1, protocol="HTTP"),
        session_row(2, protocol="Http"),
        session_row(3, protocol="dns"),
        session_row(4, protocol=None),
    ]
    kept = feat.http_filter(sessions_df(spark, rows)).select(S.SESSION_ID).collect()
    assert sorted(r[0] for r in kept) == [1, 2]


def test_ratio_guards_and_null_numerators(spark):
    r = _one(spark, transmitted_packets=0, transmitted_bytes=100, received_packets=None, duration=0)
    assert r["Fwd_Packet_Length_Mean"] == 0.0
    assert r["Bwd_Packet_Length_Mean"] == 0.0  # NULL denominator -> 0.0
    assert r["Flow_Bytes_per_s"] == 0.0 and r["Fwd_Packets_per_s"] == 0.0
    r = _one(spark, transmitted_packets=4, transmitted_bytes=None)
    assert r["Fwd_Packet_Length_Mean"] is None  # NULL numerator stays NULL


def test_flow_formulas_kept_verbatim(spark):
    r = _one(
        spark,
        duration=2500,
        total_bytes=5000,
        total_packets=10,
        transmitted_packets=3,
        received_packets=7,
        client_std_dev_interarrival_time=11,
        server_std_dev_interarrival_time=13,
        client_average_interarrival_time=17,
        server_average_interarrival_time=19,
        client_total_payload_size=900,
        client_nonempty_packet_count=3,
        server_total_payload_size=1400,
        server_nonempty_packet_count=7,
        client_max_pkt_size=None,
        server_max_pkt_size=1500,
    )
    assert r["Duration_sec"] == 2.5
    assert r["Flow_Bytes_per_s"] == 2000.0
    assert r["Flow_IAT_Mean"] == (3 * 11 + 7 * 13) / 2.0  # std-devs / 2 (as specified)
    assert r["Flow_IAT_Std"] == (3 * 17 + 7 * 19) / 3.0  # averages / 3
    assert r["Packet_Length_Max"] == 1500.0  # greatest() skips NULL
    plm = 500.0
    var = ((300.0 - plm) ** 2 + (200.0 - plm) ** 2) / 2.0
    assert math.isclose(r["Packet_Length_Variance"], var)
    assert math.isclose(r["Packet_Length_Std"], math.sqrt(var))
    assert r["Down_Up_Ratio"] == 7 / 3


def test_flags_are_case_sensitive_presence(spark):
    r = _one(spark, src_flags="sapF", dst_flags=None)
    assert r["Fwd_FIN_Flag_Count"] == 1 and r["Fwd_SYN_Flag_Count"] == 0
    assert r["Bwd_FIN_Flag_Count"] == 0
    r = _one(spark, src_flags="SAPF", dst_flags="SAF")
    assert r["FIN_Flag_Count"] == 2 and r["PSH_Flag_Count"] == 1 and r["ECE_Flag_Count"] == 0


def test_start_time_stays_epoch_milliseconds(spark):
    r = _one(spark, start=1_700_000_000_123)
    assert r["start_time"] == 1_700_000_000_123


def test_content_length_forms(spark):
    cases = {
        None: (0.0, 0.0, 0.0, 0, 0.0, 0.0),
        "[]": (0.0, 0.0, 0.0, 0, 0.0, 0.0),
        "[12.5]": (12.5, 12.5, 12.5, 1, 12.5, 0.0),
        "abc": (0.0, 0.0, 0.0, 0, 0.0, 0.0),
        '["7","8"]': (0.0, 0.0, 0.0, 0, 0.0, 0.0),
        "[1.5": (0.0, 0.0, 0.0, 0, 0.0, 0.0),
        "[1,null,3]": (1.0, 3.0, None, 3, None, None),
    }
    rows = [session_row(i, http_content_length=v) for i, v in enumerate(cases)]
    got = {
        r["http_content_length"]: tuple(r[c] for c in S.CONTENT_LENGTH_FEATURES)
        for r in feat.session_features(sessions_df(spark, rows)).collect()
    }
    assert got == cases
    r = _one(spark, http_content_length="[2,4,9]")
    assert r["content_len_mean"] == 5.0
    assert math.isclose(r["content_len_std"], math.sqrt(((2 - 5) ** 2 + (4 - 5) ** 2 + (9 - 5) ** 2) / 2))


def test_impute_replaces_null_nan_inf(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (3, float("inf")), (4, float("-inf")), (5, 2.5)], "k int, x double")
    got = dict(mx.impute_features(df, ["x"]).collect())
    assert got == {1: 0.0, 2: 0.0, 3: 0.0, 4: 0.0, 5: 2.5}


def test_model_matrix_width_and_order(spark):
    rows = [session_row(1, http_host="a.example", user_agent="agent/é😀")]
    feats = feat.session_features(sessions_df(spark, rows))
    assert mx.model_features(feats).columns[2:] == S.MODEL_FEATURES
    vec = mx.assemble_features(feats).select("features").collect()[0][0].toArray()
    assert vec.size == mx.MODEL_WIDTH == 1337
    # 47 numeric, then host_len, host_entropy: 'a.example' has 9 code points
    assert vec[47] == 9.0
    # host unigram block starts after the 57 scalars and sums to 1
    assert math.isclose(sum(vec[57:57 + 256]), 1.0, rel_tol=1e-6)


def test_score_threshold_is_strict(spark):
    from flowlens.operators.scoring import score_filter

    rows = [session_row(1, score=0.8), session_row(2, score=0.8000001), session_row(3, score=None)]
    kept = score_filter(feat.session_features(sessions_df(spark, rows))).select(S.SESSION_ID).collect()
    assert [r[0] for r in kept] == [2]
