"""Folders of any Hadoop file system: listing, deleting, and small files
that are replaced in one step."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, sorted; empty if there is no such folder."""
    p, fs = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def complete(spark: SparkSession, folder: str) -> bool:
    """A job has written the folder to its end."""
    p, fs = _path(spark, f"{folder}/_SUCCESS")
    return fs.exists(p)


def delete(spark: SparkSession, folder: str) -> None:
    p, fs = _path(spark, folder)
    if fs.exists(p):
        fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file: readers see the old text or the new one."""
    part, fs = _path(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm = spark.sparkContext._jvm
    to = jvm.org.apache.hadoop.fs.Path(path)
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    # the context of the file's own system: its rename replaces in one step
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(part), fs.makeQualified(to), over)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file, null if there is none."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return None
    return "\n".join(r[0] for r in spark.read.option("wholetext", True).text(str(p)).collect())
