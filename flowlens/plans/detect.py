"""Batch detection: sessions -> features -> score -> correlate -> alerts.

One lazy Catalyst plan up to the sink: no ``collect``/``toPandas`` and no
re-alignment of rows by position.  Without a model the input is scanned twice,
the second time narrowly (key and time of the rows above the threshold).

Order of the alert steps: confirmed sessions are first reduced to one row per
pair (a map-side partial aggregate), and only then compared with the alert
history.  Suppression removes whole pairs, so this order gives the same
result as suppress-then-reduce while the anti-join only ever sees one row
per pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from .. import schema as S
from ..config import staged
from ..operators.alerts import alert_cooldown, build_alerts, first_alert_per_pair, suppress_known
from ..operators.correlate import temporal_correlation
from ..operators.features import session_features
from ..operators.scoring import score_filter, score_sessions

#: Columns the alert steps need after scoring (everything else is pruned
#: before the correlation shuffle).
ALERT_INPUT = [S.SESSION_ID, "src_ip", "dst_ip", "src_port", "dst_port", "Flow_Duration", "start_time", S.SCORE]


def scored_sessions(sessions: DataFrame, model=None) -> DataFrame:
    """Features for HTTP sessions, scored by ``model`` when one is given
    (otherwise the input's own ``malicious_score`` is used)."""
    feats = session_features(sessions)
    return score_sessions(feats, model) if model is not None else feats


def confirmed_sessions(
    sessions: DataFrame,
    model=None,
    threshold: float = S.DEFAULT_THRESHOLD,
    window_ms: int = S.CORRELATION_WINDOW_MS,
    repeat_threshold: int = S.REPEAT_THRESHOLD,
    materialize: bool | None = None,
    bucket_ms: int = 1000,
) -> DataFrame:
    """Scored sessions above ``threshold`` that repeat on their destination
    (narrow: only the columns an alert needs, plus ``hit_count``).

    The correlation reads its input twice (the bucketed window and the small
    per-bucket count table).  With a model in the plan (``materialize``
    defaults to True then) the narrow above-threshold rows are checkpointed
    once to the shared checkpoint folder, so features and scores are computed
    once and the lineage is cut; without a model the input is a pruned,
    filter-pushed scan and is simply read twice.
    """
    hot = score_filter(scored_sessions(sessions, model), threshold).select(*ALERT_INPUT)
    if materialize if materialize is not None else model is not None:
        hot = staged(hot, "hot-sessions")
    return temporal_correlation(hot, window_ms, repeat_threshold, bucket_ms=bucket_ms)


def detect_alerts(
    sessions: DataFrame,
    history: DataFrame | None = None,
    model=None,
    threshold: float = S.DEFAULT_THRESHOLD,
    window_ms: int = S.CORRELATION_WINDOW_MS,
    repeat_threshold: int = S.REPEAT_THRESHOLD,
    now: Column | str | None = None,
    cooldown_minutes: int | None = None,
    alert_ts: Column | None = None,
    batch_id: int | Column | None = None,
    materialize: bool | None = None,
    bucket_ms: int = 1000,
    writer: str = "batch",
) -> DataFrame:
    """End-to-end batch detection returning alert rows (``ALERT_ROW``).

    ``history`` (alert rows or any frame with ``src_ip``/``dst_ip``) suppresses
    known pairs; with ``now`` and ``cooldown_minutes`` only alerts inside the
    cool-down window suppress.  ``bucket_ms`` (see ``operators.correlate``)
    can be lowered for a destination with extreme traffic in one second.
    """
    confirmed = confirmed_sessions(sessions, model, threshold, window_ms, repeat_threshold, materialize, bucket_ms)
    first = first_alert_per_pair(confirmed.drop("hit_count"))
    if history is not None:
        if now is not None and cooldown_minutes is not None:
            first = alert_cooldown(first, history, now, cooldown_minutes)
        else:
            first = suppress_known(first, history)
    return build_alerts(first, alert_ts, batch_id, writer)
