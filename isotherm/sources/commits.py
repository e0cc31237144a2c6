"""Small driver-side commits through the session's Hadoop file systems: text documents that appear
whole or not at all, existence, listings and removal.  Paths may be any Hadoop URI."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return bool(fs.exists(p))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``, sorted; none if it does not exist."""
    p, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def size_and_files(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes and number of data files below ``path`` (names that start with _ or . are not data)."""
    p, fs = _at(spark, path)
    total = files = 0
    found = fs.listFiles(p, True)
    while found.hasNext():
        s = found.next()
        if not s.getPath().getName().startswith(("_", ".")):
            total, files = total + s.getLen(), files + 1
    return total, files


def read_text(spark: SparkSession, path: str) -> str | None:
    p, fs = _at(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def commit_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace the document at ``path``: written beside it, then renamed over it, so that readers see
    the old text or the new one.  (Object stores whose rename is a copy need a committer of their own.)"""
    p, fs = _at(spark, path)
    tmp, _ = _at(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri() if p.toUri().getScheme() else fs.getUri(),
                                                       spark._jsc.hadoopConfiguration()).rename(tmp, p, options)


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _at(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a written folder to ``to``, which must not exist."""
    (p, fs), (q, _) = _at(spark, path), _at(spark, to)
    fs.mkdirs(q.getParent())
    if fs.exists(q) or not fs.rename(p, q):
        raise OSError(f"{path} could not be renamed to {to}")
