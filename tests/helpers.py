"""Builders for small literal session tables (edge cases)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from flowlens import schema as S


def session_row(
    sid,
    src="10.0.0.1",
    dst="203.0.113.9",
    start=1_700_000_000_000,
    protocol="http",
    score=0.9,
    **overrides,
):
    """One nested session record; ``overrides`` set session/transport/payload
    leaves by name."""
    sess = {name: 1 for name, _ in S.SESSION_FIELDS}
    sess.update(protocol=protocol, start_time=start)
    trans = {"src_port": 40000, "dst_port": 80, "protocol": "TCP", "src_flags": "SAP", "dst_flags": "SA"}
    pay = {f.name: None for f in S.PAYLOAD.fields}
    for k, v in overrides.items():
        if k in sess:
            sess[k] = v
        elif k in trans:
            trans[k] = v
        elif k in pay:
            pay[k] = v
        else:
            raise KeyError(k)
    return (
        sid,
        (src, dst),
        tuple(trans[f.name] for f in S.TRANSPORT.fields),
        tuple(sess[n] for n, _ in S.SESSION_FIELDS),
        tuple(pay[f.name] for f in S.PAYLOAD.fields),
        score,
    )


def sessions_df(spark: SparkSession, rows):
    return spark.createDataFrame(rows, S.SESSION_WITH_KEYS)


def ordered_loop(rows, window_ms=600_000, threshold=3):
    """Plain restatement of the ordered correlation loop: rows are
    (session_id, dst_ip, start_time); visit in (start_time, session_id) order,
    keep each destination's times inside [t - window, t], confirm at
    >= threshold.  Returns {session_id: count} for every non-NULL time."""
    seen = {}
    counts = {}
    for sid, dst, t in sorted((r for r in rows if r[2] is not None), key=lambda r: (r[2], r[0])):
        lst = seen.setdefault(dst, [])
        lst.append(t)
        seen[dst] = [x for x in lst if x >= t - window_ms]
        counts[sid] = len(seen[dst])
    return counts
