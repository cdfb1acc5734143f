"""Stage row counts (S13) without extra passes over the data.

``observed`` attaches named metrics to a plan with ``DataFrame.observe``: they
are computed by the job that runs anyway and read after it finishes.
``stage_counts`` is the same information as a table (one row per stage), for
reports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from .. import schema as S
from ..config import staged
from ..operators.correlate import temporal_correlation


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row-count observation named ``name`` attached."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def _is_http():
    return F.coalesce(F.lower(F.col("session.protocol")) == F.lit("http"), F.lit(False))


def early_counts(threshold: float = S.DEFAULT_THRESHOLD) -> list:
    """The first three stages as aggregates over session records."""
    is_http = _is_http()
    hot = is_http & F.coalesce(F.col(S.SCORE) > F.lit(float(threshold)), F.lit(False))
    return [F.count(F.lit(1)).alias("sessions"), F.count_if(is_http).alias("http"), F.count_if(hot).alias("above_threshold")]


class StageCountListener(StreamingQueryListener):
    """S13 on a stream: per micro-batch the counts that ``observed_stream``
    attached to the query, as they come with its progress: no extra job.  Add it
    with ``spark.streams.addListener``."""

    def __init__(self, name: str = "stage_counts"):
        self.name = name
        self.batches: dict[tuple[str, int], dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None and event.progress.numInputRows:
            self.batches[str(event.progress.id), int(event.progress.batchId)] = {k: int(v) for k, v in row.asDict().items()}

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def counts(self) -> list[tuple[int, dict[str, int]]]:
        """(batch, counts) in order of query and batch."""
        return [(batch, self.batches[query, batch]) for query, batch in sorted(self.batches)]


def observed_stream(sessions: DataFrame, threshold: float = S.DEFAULT_THRESHOLD, name: str = "stage_counts") -> DataFrame:
    """A stream of session records with the counts of the early stages
    attached to the micro-batch's own plan."""
    return sessions.observe(name, *early_counts(threshold))


def stage_counts(sessions: DataFrame, threshold: float = S.DEFAULT_THRESHOLD) -> DataFrame:
    """(stage, n_rows): input sessions, HTTP sessions, above the threshold,
    confirmed by correlation, and distinct alert pairs.

    The first three are observations on the one job that reads the input and
    stages the narrow rows above the threshold; the last two come from one
    correlation over those, reduced to a count per pair.
    """
    is_http = _is_http()
    is_hot = is_http & F.coalesce(F.col(S.SCORE) > F.lit(float(threshold)), F.lit(False))
    obs = Observation()
    flat = sessions.select(
        S.SESSION_ID,
        F.col("network.src_ip").alias("src_ip"),
        F.col("network.dst_ip").alias("dst_ip"),
        F.col("session.start_time").alias("start_time"),
        is_http.alias("_http"),
        is_hot.alias("_hot"),
    ).observe(
        obs,
        F.count(F.lit(1)).alias("sessions"),
        F.count_if("_http").alias("http"),
        F.count_if("_hot").alias("above_threshold"),
    )
    hot = staged(flat.filter("_hot").drop("_http", "_hot"), "hot-sessions")
    early = [(n, int(obs.get[n])) for n in ("sessions", "http", "above_threshold")]
    per_pair = temporal_correlation(hot).groupBy("src_ip", "dst_ip").agg(F.count(F.lit(1)).alias("n"))
    totals = per_pair.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("confirmed"), F.count(F.lit(1)).alias("alert_pairs"))
    late = totals.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("stage"), F.col(n).cast("bigint").alias("n_rows")) for n in ("confirmed", "alert_pairs")]))
    )
    return sessions.sparkSession.createDataFrame(early, "stage string, n_rows bigint").unionByName(late)
