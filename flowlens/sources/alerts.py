"""Alert table sink and history source.

The alert table is Parquet partitioned by ``alert_date`` (UTC, so retention
and history prune partitions whatever the session time zone) and every write is
keyed by ``(writer, batch_id)``.  Writes are commits of a small log
(``sources.commits``): a retried batch replaces its first attempt as one step,
also when it has fewer rows, two writers never meet, and files that a reader has
listed are not overwritten.  The JSON sink has one folder per write under the
same key.  Documents of the original detector (one indented file per alert) are
read as history with the file's modification time as alert time.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schema as S
from . import commits
from .files import child_names, delete_path, make_folder, path_exists, read_text, write_text


def write_alerts(alerts: DataFrame, path: str, keys: list[tuple[str, int]] | None = None, instead_of: list[str] = ()) -> int:
    """Commit alert rows to the table at ``path`` (idempotent per writer
    and batch; ``build_alerts`` sets both).  ``keys``: the (writer, batch_id)
    that the write stands for, also where it has no rows (default: those of its
    rows).  ``instead_of``: writers whose earlier commits it replaces.  Returns
    the commit's number."""
    spark = alerts.sparkSession
    folder = f"commit={uuid.uuid4().hex}"
    alerts.write.partitionBy("alert_date", "writer", "batch_id").parquet(f"{path}/{folder}")
    return commits.commit(spark, path, folder, _keys_in(spark, f"{path}/{folder}") if keys is None else keys, instead_of)


def _keys_in(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """The (writer, batch_id) of a commit's partition folders."""
    values = lambda at, name: [n[len(name) + 1 :] for n in child_names(spark, at) if n.startswith(f"{name}=")]
    out = set()
    for date in values(folder, "alert_date"):
        for writer in values(f"{folder}/alert_date={date}", "writer"):
            out.update((unquote(writer), int(b)) for b in values(f"{folder}/alert_date={date}/writer={writer}", "batch_id"))
    return sorted(out)


def write_alerts_json(alerts: DataFrame, path: str) -> None:
    """Alerts as JSON lines (alert fields + ``alert_ts``), for log shippers;
    the same key as the table, so a retried write replaces itself."""
    cols = [F.col(f.name) for f in S.ALERT.fields] + [F.col(c) for c in ("alert_ts", "writer", "batch_id")]
    (
        alerts.select(*cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("timeZone", "UTC")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .partitionBy("writer", "batch_id")
        .json(path)
    )


def _read_commits(spark: SparkSession, path: str, entries: list[dict]) -> DataFrame:
    """The rows of commits, of each only the keys it counts for."""
    names = S.ALERT_ROW.fieldNames()
    out = spark.createDataFrame([], S.ALERT_ROW)
    read = spark.read.schema(S.ALERT_ROW).option("basePath", path)
    for layout in ("keys", "dates"):
        whole = [f"{path}/{e['folder']}" for e in entries if e["layout"] == layout and not e["partial"]]
        if whole:
            out = out.unionByName(read.parquet(*whole).select(*names))
    for e in entries:
        if e["partial"]:
            kept = reduce(lambda x, y: x | y, [(F.col("writer") == F.lit(w)) & (F.col("batch_id") == F.lit(int(b))) for w, b in e["keys"]])
            out = out.unionByName(read.parquet(f"{path}/{e['folder']}").select(*names).filter(kept))
    return out


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The alert table written by ``write_alerts``; no rows before the
    first write.  Date folders of a table from before the log count as they
    are."""
    rows = _read_commits(spark, path, commits.live_commits(spark, path))
    old = [f"{path}/{n}" for n in child_names(spark, path) if n.startswith("alert_date=")]
    if not old:
        return rows
    return rows.unionByName(spark.read.schema(S.ALERT_ROW).option("basePath", path).parquet(*old).select(*rows.columns))


def read_alert_documents(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Alert history from JSON documents, with ``alert_ts``: the
    document's own, else the file's modification time.  One indented document
    per file, as the original detector wrote them, or with ``lines`` one
    document per line, as the JSON sink and the export write them.  No folder:
    no rows."""
    schema = T.StructType([*S.ALERT.fields, T.StructField("alert_ts", T.TimestampType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    docs = (
        spark.read.schema(schema)
        .option("multiLine", not lines)
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", "true")
        .json(path)
    )
    return docs.withColumn("alert_ts", F.coalesce(F.col("alert_ts"), F.col("_metadata.file_modification_time")))


def drop_old_alerts(spark: SparkSession, path: str, now: dt.datetime, minutes: int = S.ALERT_RETENTION_MINUTES) -> list[str]:
    """S10, physical: remove the ``alert_date`` partitions whose every alert
    is older than ``minutes`` at ``now`` (a naive ``now`` is UTC).  Returns
    the removed dates.  Only folder names are listed.  ``compact_alerts`` takes
    out single rows, to the minute."""
    now = now if now.tzinfo is not None else now.replace(tzinfo=dt.timezone.utc)
    oldest = (now - dt.timedelta(minutes=int(minutes))).astimezone(dt.timezone.utc).date()
    gone = set()
    folders = [path, *(f"{path}/{n}" for n in child_names(spark, path) if n.startswith("commit="))]
    for folder in folders:
        for name in child_names(spark, folder):
            if name.startswith("alert_date=") and name[11:] < oldest.isoformat():
                delete_path(spark, f"{folder}/{name}")
                gone.add(name[11:])
    return sorted(gone)


def compact_alerts(
    spark: SparkSession,
    path: str,
    now: dt.datetime | None = None,
    minutes: int = S.ALERT_RETENTION_MINUTES,
    grace_minutes: int = 2 * S.ALERT_RETENTION_MINUTES,
) -> int | None:
    """One commit in place of all that count now, a file or so a date; with
    ``now`` (naive: UTC) without alerts older than ``minutes``.  Folders that no
    longer count go once they are ``grace_minutes`` old.  A write that comes in
    between keeps its place: the commit only stands for the keys it has read."""
    entries = commits.live_commits(spark, path)
    if not entries:
        return None
    rows = _read_commits(spark, path, entries)
    if now is not None:
        now = now if now.tzinfo is not None else now.replace(tzinfo=dt.timezone.utc)
        micros = (now - dt.timedelta(minutes=int(minutes)) - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
        rows = rows.filter(F.col("alert_ts") >= F.timestamp_micros(F.lit(micros)))
    folder = f"commit={uuid.uuid4().hex}"
    rows.repartition("alert_date").write.partitionBy("alert_date").parquet(f"{path}/{folder}")
    n = commits.commit(spark, path, folder, [tuple(k) for e in entries for k in e["keys"]], layout="dates", upto=entries[-1]["n"])
    commits.vacuum(spark, path, int(dt.datetime.now(dt.timezone.utc).timestamp() * 1000), int(grace_minutes) * 60_000)
    return n


_MANIFEST = "n long, folder string, keys array<array<string>>, instead_of array<string>, layout string"


def export_alerts(spark: SparkSession, path: str, output: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """S9 with a moving marker: a stream over the alert table's commits into
    JSON lines, a folder per micro-batch (rewritten when it is retried).  The
    checkpoint is the marker: every alert is exported once, also after a
    restart, also when its batch is retried and committed again, and when an
    early alert becomes final.  ``trigger=None`` exports what is there.

    A commit that no longer counts is passed over: the one in its place has a
    manifest of its own.  One that replaces a commit exported before is exported
    without the rows of that commit, which ``_exported`` in ``output`` lists."""
    make_folder(spark, commits.log_path(path))

    def process(batch: DataFrame, batch_id: int) -> None:
        numbers = sorted(r["n"] for r in batch.select("n").collect() if r["n"] is not None)  # at most the files of a trigger
        live = {e["n"]: e for e in commits.live_commits(spark, path)}
        done = set()
        for name in child_names(spark, f"{output}/_exported"):
            if name.endswith(".txt") and int(name[:-4]) < batch_id:
                done.update(json.loads(read_text(spark, f"{output}/_exported/{name}")))
        now = [live[n] for n in numbers if n in live and live[n]["layout"] == "keys"]
        before = _replaced(spark, path, now, done)
        identity = [S.SESSION_ID, "alert_ts"]
        rows = _read_commits(spark, path, now)
        if before:
            told = _read_commits(spark, path, before).select(*[F.col(c).alias(f"_{c}") for c in identity]).distinct()
            same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in identity]
            rows = rows.join(told, reduce(lambda x, y: x & y, same), "left_anti")
        cols = [F.col(f.name) for f in S.ALERT.fields] + [F.col("alert_ts")]
        rows.select(*cols).write.mode("overwrite").option("timeZone", "UTC").json(f"{output}/export={int(batch_id)}")
        write_text(spark, f"{output}/_exported/{int(batch_id)}.txt", json.dumps([e["n"] for e in now]))

    source = spark.readStream.schema(_MANIFEST).option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", 200)
    writer = source.json(commits.log_path(path)).writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)).start()


def _replaced(spark: SparkSession, path: str, now: list[dict], done: set[int]) -> list[dict]:
    """The exported commits whose rows may come again in ``now``: of every key
    and every replaced writer the last one."""
    if not done or not now:
        return []
    keys = {tuple(k) for e in now for k in e["keys"]}
    writers = {w for e in now for w in e["instead_of"]}
    out = {}
    for n in sorted(done, reverse=True):
        if not keys and not writers:
            break
        manifest = commits.manifest_of(spark, path, n)
        own = {tuple(k) for k in manifest["keys"]} if manifest else set()
        if (own & keys or {w for w, _ in own} & writers) and path_exists(spark, f"{path}/{manifest['folder']}"):
            out[n] = {**manifest, "partial": False}
        keys -= own
        writers -= {w for w, _ in own}
    return list(out.values())


def alert_history(alerts: DataFrame) -> DataFrame:
    """Known pairs with their latest alert time (one row per pair)."""
    flat = alerts.select(
        F.col("match_body.network.src_ip").alias("src_ip"),
        F.col("match_body.network.dst_ip").alias("dst_ip"),
        *([F.col("alert_ts")] if "alert_ts" in alerts.columns else [F.lit(None).cast("timestamp").alias("alert_ts")]),
    )
    return flat.groupBy("src_ip", "dst_ip").agg(F.max("alert_ts").alias("alert_ts"))


def append_training_set(features: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Append flat features to a training set (Parquet).

    With ``batch_id`` the rows land in partition ``batch_id=<id>`` with
    dynamic partition overwrite, so re-running a batch replaces its rows
    instead of appending them twice.
    """
    if batch_id is None:
        features.write.mode("append").parquet(path)
        return
    (
        features.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )
