"""Session record sources: declared-schema scan, file validation, unions.

* ``scan_sessions`` (S1/S2/U1): one scan of a whole directory (or several)
  with the declared nested schema and a ``*.parquet`` glob -- not one scan
  and one ``count()`` per file.  Missing columns read as NULL.
* ``validate_files`` / ``read_valid_sessions`` (S6): footers are checked in
  parallel on the executors; files whose column types disagree with the
  declared schema (or that are not readable Parquet) are listed with a
  reason, and the valid ones are read.  A bad file can then never fail the
  batch half-way (a lazy read with a mismatched type only fails when values
  are decoded).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..config import staged


def session_schema(with_keys: bool = True) -> T.StructType:
    return S.SESSION_WITH_KEYS if with_keys else S.SESSION


def scan_sessions(
    spark: SparkSession, *paths: str, with_keys: bool = True, ignore_corrupt: bool = False
) -> DataFrame:
    """Read session Parquet files under ``paths`` with the declared schema.

    When the files carry no ``session_id``, a stable one is derived from the
    fields that identify a session (addresses, ports, protocol, start time,
    duration, sizes, HTTP payload), so later steps never need row positions; a
    query that does not use the id does not read them.  ``ignore_corrupt`` skips unreadable files
    (``ignoreCorruptFiles``); type-mismatched files are caught up front by
    ``read_valid_sessions`` instead.
    """
    df = (
        spark.read.schema(session_schema(with_keys))
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .option("ignoreCorruptFiles", str(bool(ignore_corrupt)).lower())
        .parquet(*paths)
    )
    if with_keys:
        df = df.withColumn(S.SESSION_ID, F.coalesce(F.col(S.SESSION_ID), derived_session_id()))
    return df


def derived_session_id():
    """``xxhash64`` over the identifying fields of a session record, byte
    counts and the HTTP payload included: sessions that differ only in their
    URL get different ids, and so a fixed order among equal times."""
    return F.xxhash64(
        F.col("network.src_ip"),
        F.col("network.dst_ip"),
        F.col("transport.src_port"),
        F.col("transport.dst_port"),
        F.col("transport.protocol"),
        F.col("session.start_time"),
        F.col("session.duration"),
        F.col("session.total_bytes"),
        F.col("session.total_packets"),
        F.col("payload"),
    )


def union_sources(*frames: DataFrame) -> DataFrame:
    """Union session frames by column name (missing columns -> NULL)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _leaf_types(st: T.StructType, prefix: str = "") -> dict[str, str]:
    out = {}
    for f in st.fields:
        name = f"{prefix}{f.name}"
        if isinstance(f.dataType, T.StructType):
            out.update(_leaf_types(f.dataType, name + "."))
        else:
            out[name] = f.dataType.simpleString()
    return out


#: Arrow types that Spark's Parquet reader turns into a declared type.
_READABLE = {
    "bigint": {"int8", "int16", "int32", "int64", "uint8", "uint16", "uint32"},
    "int": {"int8", "int16", "int32", "uint8", "uint16"},
    "double": {"float", "double", "int8", "int16", "int32"},
    "string": {"string", "large_string", "binary", "large_binary"},
}

_REPORT = "path string, ok boolean, reason string"


def file_check(schema: T.StructType = S.SESSION_WITH_KEYS, pages: bool = False):
    """A ``mapInPandas`` function from rows with a file's URI (``path``) to
    (path, ok, reason).  A file is bad when it is not readable Parquet or when
    a declared leaf column exists with a type that Spark does not widen to the
    declared one; missing columns are fine (they read as NULL).  Only footers
    are read; with ``pages`` the declared columns, too, a piece at a time, which
    finds damage behind a sound footer."""
    expected = _leaf_types(schema)
    readable = dict(_READABLE)
    top = [f.name for f in schema.fields]

    def check(batches):
        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        def leaves(t, prefix=""):
            out = {}
            for fld in t:
                name = f"{prefix}{fld.name}"
                if pa.types.is_struct(fld.type):
                    out.update(leaves(fld.type, name + "."))
                else:
                    kind = fld.type.value_type if pa.types.is_dictionary(fld.type) else fld.type
                    out[name] = str(kind)
            return out

        for pdf in batches:
            rows = []
            for p in pdf["path"]:
                try:
                    uri = p.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1)
                    fs, inner = pafs.FileSystem.from_uri(uri)
                    with fs.open_input_file(inner) as fh:
                        file = pq.ParquetFile(fh)
                        arrow = file.schema_arrow
                        found = leaves(arrow)
                        bad = [
                            f"{k}: {found[k]} != {v}"
                            for k, v in expected.items()
                            if k in found and found[k] not in readable.get(v, {v})
                        ]
                        if pages and not bad:
                            n = sum(b.num_rows for b in file.iter_batches(65_536, columns=[c for c in top if c in arrow.names]))
                            if n != file.metadata.num_rows:
                                bad = [f"rows: {n} != {file.metadata.num_rows}"]
                    rows.append((p, not bad, "; ".join(bad) or None))
                except Exception as e:  # noqa: BLE001 - report, never fail the batch
                    rows.append((p, False, f"unreadable: {type(e).__name__}"))
            yield pd.DataFrame(rows, columns=["path", "ok", "reason"])

    return check


def validate_files(spark: SparkSession, path: str, schema: T.StructType = S.SESSION_WITH_KEYS, pages: bool = False) -> DataFrame:
    """(path, ok, reason) per ``*.parquet`` file under ``path``; ``path`` is
    the file's URI, as in ``_metadata.file_path``.

    Files are listed by Spark (``binaryFile`` without reading contents) and
    each executor checks its files with pyarrow (``file_check``).
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("_metadata.file_path").alias("path"))
    )
    return listing.mapInPandas(file_check(schema, pages), _REPORT)


def read_valid_sessions(spark: SparkSession, path: str, pages: bool = True) -> tuple[DataFrame, DataFrame]:
    """(sessions from the valid files, report of the quarantined files).

    The report is staged once; the scan skips corrupt files and drops the
    rows of any quarantined file by a join on the file's path, so neither rows
    nor paths reach the driver however many files there are.  With ``pages`` the
    check reads the files' values, so a file that the scan would lose rows of is
    in the report, and none of its rows are read; without, only footers are read.
    """
    report = staged(validate_files(spark, path, pages=pages), "file-report")
    quarantined = report.filter(~F.col("ok"))
    rows = scan_sessions(spark, path, ignore_corrupt=True).withColumn("_file", F.col("_metadata.file_path"))
    bad = quarantined.select(F.col("path").alias("_file"))
    return rows.join(bad, "_file", "left_anti").drop("_file"), quarantined
