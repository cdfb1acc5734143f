"""Names, existence and removal of paths, on any file system Spark reads."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _file_system(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path`` (none if it does not exist)."""
    p, fs = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _file_system(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    p, fs = _file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file; readers see the whole text or none of it."""
    p, fs = _file_system(spark, path)
    part, _ = _file_system(spark, f"{path}.part")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(part, p):
        raise OSError(f"cannot write {path}")


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file unless there is one of that name; whether it did."""
    p, fs = _file_system(spark, path)
    fs.mkdirs(p.getParent())
    try:
        stream = fs.create(p, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName() or fs.exists(p):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def make_folder(spark: SparkSession, path: str) -> None:
    p, fs = _file_system(spark, path)
    fs.mkdirs(p)


def modified_ms(spark: SparkSession, path: str) -> int:
    p, fs = _file_system(spark, path)
    return int(fs.getFileStatus(p).getModificationTime())
