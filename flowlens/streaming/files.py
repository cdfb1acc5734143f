"""Session files as a stream of paths, with a quarantine for bad ones.

The source streams the *names* of new files (each once, by its checkpoint; file
contents are not read).  Per micro-batch the executors check the files' footers;
bad ones go to the quarantine table with the reason and the version that met
them, the good ones are read with the declared schema.  When reading fails on a
file whose footer is sound, the batch's files are checked page by page, and the
batch is read again without those that are damaged: nothing is skipped unseen,
and a batch of good files costs no second read.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..config import staged
from ..sources.files import path_exists
from ..sources.sessions import _REPORT, derived_session_id, file_check


def read_file_stream(
    spark: SparkSession,
    input_dir: str,
    max_files_per_trigger: int | None = None,
    clean_source: str | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """(file, path) of new ``*.parquet`` files: Spark's path and the URI.  At
    most 1,000 a micro-batch unless told otherwise, which bounds the names that
    reach the driver."""
    named = "path string, modificationTime timestamp, length long, content binary"
    reader = spark.readStream.format("binaryFile").schema(named).option("pathGlobFilter", "*.parquet")
    reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger or 1000))
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if clean_source == "archive":
            reader = reader.option("sourceArchiveDir", archive_dir)
    return reader.load(input_dir).select(F.col("path").alias("file"), F.col("_metadata.file_path").alias("path"))


def _literal(path: str) -> str:
    """A path that is read as it is, not as a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def sessions_of(spark: SparkSession, files: list[str]) -> DataFrame:
    """The records of session files, with a derived id where they have none."""
    if not files:
        return spark.createDataFrame([], S.SESSION_WITH_KEYS)
    rows = spark.read.schema(S.SESSION_WITH_KEYS).option("ignoreCorruptFiles", "false").parquet(*map(_literal, files))
    return rows.withColumn(S.SESSION_ID, F.coalesce(F.col(S.SESSION_ID), derived_session_id()))


def with_quarantine(spark: SparkSession, listing: DataFrame, version: int, quarantine_dir: str, use: Callable[[DataFrame], None]) -> None:
    """``use`` (run at least once, must be repeatable) on the sessions of a
    micro-batch's good files; the bad ones are listed in
    ``<quarantine_dir>/version=<version>``."""
    files = staged(listing, "batch-files")
    found = staged(files.select("path").mapInPandas(file_check(), _REPORT), "file-report")

    def good(report: DataFrame) -> list[str]:
        kept = files.join(report.filter("ok").select("path"), "path", "left_semi")
        return sorted(r["file"] for r in kept.select("file").collect())  # at most the files of a trigger

    def report_bad(report: DataFrame) -> None:
        bad = report.filter("NOT ok").select("path", "reason")
        if not bad.isEmpty():
            bad.write.mode("overwrite").parquet(f"{quarantine_dir}/version={int(version)}")

    report_bad(found)
    try:
        use(sessions_of(spark, good(found)))
    except (PySparkException, Py4JJavaError):
        pages = files.join(found.filter("ok").select("path"), "path", "left_semi").select("path").mapInPandas(file_check(pages=True), _REPORT)
        deep = staged(found.filter("NOT ok").unionByName(pages), "file-report")
        if deep.filter("NOT ok").count() == found.filter("NOT ok").count():
            raise
        report_bad(deep)
        use(sessions_of(spark, good(deep)))


def quarantined_files(spark: SparkSession, quarantine_dir: str) -> DataFrame:
    """(path, reason, version) of all files a stream has left out."""
    schema = "path string, reason string, version long"
    if not path_exists(spark, quarantine_dir):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(quarantine_dir)
