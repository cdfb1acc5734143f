"""Alert operators: suppression, one alert per pair, cool-down, alert records.

Pairs are ``(src_ip, dst_ip)`` compared null-safely (a NULL address matches a
NULL address, as the original text key ``"{src}_{dst}"`` did).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..config import staged
from .cooldown import spaced_rows
from .known import maybe_known

PAIR = ("src_ip", "dst_ip")


def known_pairs(history: DataFrame) -> DataFrame:
    """Distinct ``(src_ip, dst_ip)`` of an alert history (flat or nested).

    The distinct is a partial (map-side) aggregate, so the join side is at
    most one row per pair however many alerts a pair has.
    """
    if "src_ip" in history.columns:
        pairs = history.select(*PAIR)
    else:
        pairs = history.select(
            F.col("match_body.network.src_ip").alias("src_ip"),
            F.col("match_body.network.dst_ip").alias("dst_ip"),
        )
    return pairs.dropDuplicates()


def suppress_known(sessions: DataFrame, history: DataFrame, filter_bits: int | None = None) -> DataFrame:
    """Drop sessions whose pair already has an alert (null-safe anti-join).

    The known-pair side is a deduplicated pair list; Spark broadcasts it when
    its estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` and
    otherwise shuffles both sides (AQE splits a skewed pair).  For a history
    larger than that, ``filter_bits`` (27, say) puts a bit map of that many bits
    before the join (``operators.known``): only rows whose pair may be known
    are shuffled.  The sessions are staged once for it.
    """
    known = known_pairs(history)
    pairs = known.select(F.col("src_ip").alias("_k_src"), F.col("dst_ip").alias("_k_dst"))
    cond = F.col("src_ip").eqNullSafe(F.col("_k_src")) & F.col("dst_ip").eqNullSafe(F.col("_k_dst"))
    if filter_bits is None:
        return sessions.join(pairs, cond, "left_anti")
    marked = staged(sessions.withColumn("_maybe", maybe_known(sessions, known, filter_bits)), "maybe-known")
    new = marked.filter(~F.col("_maybe")).drop("_maybe")
    return new.unionByName(marked.filter("_maybe").drop("_maybe").join(pairs, cond, "left_anti"))


def first_alert_per_pair(confirmed: DataFrame, time_col: str = "start_time", order_col: str = S.SESSION_ID) -> DataFrame:
    """The earliest confirmed session per pair, by ``(start_time,
    session_id)``.

    A ``min`` over a struct led by the ordering key: an aggregate with a
    map-side partial step, so a hot pair is reduced before the shuffle and no
    group is ever sorted in one task.
    """
    rest = [c for c in confirmed.columns if c not in PAIR and c not in (time_col, order_col)]
    first = F.min(F.struct(F.col(time_col).alias(time_col), F.col(order_col).alias(order_col), *rest)).alias("_first")
    agg = confirmed.groupBy(*PAIR).agg(first)
    out = agg.select(*PAIR, "_first.*")
    return out.select(*confirmed.columns)


def utc_date(ts: Column) -> Column:
    """The UTC calendar date of an instant, whatever the session time zone
    (``alert_date`` must mean the same to every writer and reader)."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.unix_micros(ts) / F.lit(86_400_000_000)).cast("int"))


def alert_retention(alerts: DataFrame, now: Column | str | dt.datetime, minutes: int = S.ALERT_RETENTION_MINUTES) -> DataFrame:
    """Keep alerts no older than ``minutes`` at ``now``.  With the alert
    table partitioned by ``alert_date`` the date bound prunes partitions."""
    lower = _ts(now) - F.make_interval(mins=F.lit(int(minutes)))
    kept = alerts.filter(F.col("alert_ts") >= lower)
    return kept.filter(F.col("alert_date") >= utc_date(lower)) if "alert_date" in alerts.columns else kept


def alert_export(alerts: DataFrame, marker: Column | str | dt.datetime) -> DataFrame:
    """Alerts strictly newer than the export marker."""
    m = _ts(marker)
    newer = alerts.filter(F.col("alert_ts") > m)
    return newer.filter(F.col("alert_date") >= utc_date(m)) if "alert_date" in alerts.columns else newer


def alert_cooldown(
    sessions: DataFrame, history: DataFrame, now: Column | str | dt.datetime, minutes: int = S.ALERT_RETENTION_MINUTES
) -> DataFrame:
    """Suppress pairs alerted within the last ``minutes`` (J1 over the
    history kept by S10); older alerts no longer suppress."""
    return suppress_known(sessions, alert_retention(history, now, minutes))


def cooldown_alerts(confirmed: DataFrame, last: DataFrame | None = None, minutes: int = S.ALERT_RETENTION_MINUTES) -> DataFrame:
    """R5/J3 applied to every confirmed row: per pair, in ``(start_time,
    session_id)`` order, a row alerts when the pair's last alert is more than
    ``minutes`` older (or there is none).  ``last`` has the pairs' latest
    earlier alerts (``src_ip``, ``dst_ip``, ``last_ms``).  Rows without a time
    do not alert.

    One ordered scan (``operators.cooldown``): two jobs however long a time the
    rows span, and a pair with very many rows is spread over tasks.
    """
    gap = int(minutes) * 60_000
    rows = confirmed.filter(F.col("start_time").isNotNull())
    if last is not None:
        keyed = last.select(F.col("src_ip").alias("_p_src"), F.col("dst_ip").alias("_p_dst"), F.col("last_ms").alias("_p_ms"))
        same = F.col("src_ip").eqNullSafe(F.col("_p_src")) & F.col("dst_ip").eqNullSafe(F.col("_p_dst"))
        joined = rows.join(keyed, same, "left")
        rows = joined.filter(F.col("_p_ms").isNull() | (F.col("start_time") > F.col("_p_ms") + F.lit(gap))).select(*confirmed.columns)
    return spaced_rows(rows, list(PAIR), "start_time", S.SESSION_ID, gap)


def _ts(v: Column | str | dt.datetime) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:  # an instant: no session time zone involved
            micros = (v - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
            return F.timestamp_micros(F.lit(micros))
        v = v.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp(F.lit(v))


def alert_struct() -> Column:
    """B1: the nested alert object with its fixed fields."""
    return F.struct(
        F.struct(
            F.struct(
                F.lit(S.ALERT_PROTOCOL).alias("protocol"),
                F.col("Flow_Duration").cast("bigint").alias("session_duration"),
            ).alias("session"),
            F.struct(F.col("src_ip").alias("src_ip"), F.col("dst_ip").alias("dst_ip")).alias("network"),
            F.struct(
                F.col("src_port").cast("int").alias("src_port"), F.col("dst_port").cast("int").alias("dst_port")
            ).alias("transport"),
        ).alias("match_body"),
        F.col(S.SCORE).cast("double").alias("score"),
        F.lit(S.ALERT_RULE_NAME).alias("rule_name"),
        F.lit(S.ALERT_TYPE).alias("alert_type"),
        F.lit(S.ALERT_CATEGORY).alias("alert_category"),
        F.lit(S.ALERT_PRIORITY).alias("priority"),
        F.lit(S.ALERT_DESCRIPTION).alias("alert_description"),
    )


def new_batch_id() -> int:
    """A batch id that no other write has (random, positive)."""
    return uuid.uuid4().int >> 65


def build_alerts(
    sessions: DataFrame,
    alert_ts: Column | None = None,
    batch_id: int | Column | None = None,
    writer: str | Column = "batch",
) -> DataFrame:
    """B1/M4: alert rows (schema ``ALERT_ROW``): the alert fields plus
    ``session_id``, ``start_time``, ``alert_ts`` (default: the query's current
    timestamp), ``alert_date`` (UTC), and the key of the write: ``writer`` and
    ``batch_id`` (default: a new one)."""
    ts = alert_ts if alert_ts is not None else F.current_timestamp()
    bid = batch_id if isinstance(batch_id, Column) else F.lit(new_batch_id() if batch_id is None else int(batch_id)).cast("bigint")
    whose = writer if isinstance(writer, Column) else F.lit(writer)
    a = sessions.select(alert_struct().alias("_a"), S.SESSION_ID, "start_time", ts.alias("alert_ts"))
    return a.select(
        "_a.*",
        S.SESSION_ID,
        F.col("start_time").cast("bigint").alias("start_time"),
        F.col("alert_ts").cast("timestamp").alias("alert_ts"),
        utc_date(F.col("alert_ts")).alias("alert_date"),
        whose.alias("writer"),
        bid.alias("batch_id"),
    )


def alert_json(alerts: DataFrame) -> DataFrame:
    """One JSON document per alert (the alert fields only)."""
    return alerts.select(F.to_json(F.struct(*[F.col(f.name) for f in S.ALERT.fields])).alias("json"))


def flatten_alerts(alerts: DataFrame) -> DataFrame:
    """Flat view of alert rows (for display, export checks and joins)."""
    return alerts.select(
        F.col("match_body.session.protocol").alias("protocol"),
        F.col("match_body.session.session_duration").alias("session_duration"),
        F.col("match_body.network.src_ip").alias("src_ip"),
        F.col("match_body.network.dst_ip").alias("dst_ip"),
        F.col("match_body.transport.src_port").alias("src_port"),
        F.col("match_body.transport.dst_port").alias("dst_port"),
        *[F.col(f.name) for f in S.ALERT.fields[1:]],
        *[F.col(c) for c in (S.SESSION_ID, "start_time", "alert_ts") if c in alerts.columns],
    )


def malicious_summary(confirmed: DataFrame) -> DataFrame:
    """The display projection of confirmed sessions."""
    return confirmed.select("src_ip", "dst_ip", S.SCORE)
