"""Small files beside tables in any store that Spark reaches: written whole or not at all."""

from __future__ import annotations

import hashlib
import uuid
from functools import cache
from pathlib import Path

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def get_text(spark: SparkSession, path: str) -> str | None:
    """The file's text, or None if there is no such file."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new file beside its name and rename it; False if the name is taken already."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return False
    fs.mkdirs(p.getParent())
    temp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(temp, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    done = not fs.exists(p) and fs.rename(temp, p)
    if not done:
        fs.delete(temp, False)
    return done


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def fingerprint(spark: SparkSession, folder: str) -> str:
    """Hash of all files below a folder: their paths from there, lengths and times of change."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return hashlib.sha1(folder.encode()).hexdigest()
    real = fs.resolvePath(p)  # may be of another file system (viewfs)
    base, found, files = real.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(real).toString(), [], fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString().removeprefix(base), f.getLen(), f.getModificationTime()))
    return hashlib.sha1(repr(sorted(found)).encode()).hexdigest()


@cache
def code_version() -> str:
    """Hash of this package's sources, the optional subpackage left out."""
    root = Path(__file__).resolve().parents[1]
    files = sorted(f for f in root.rglob("*.py") if f.relative_to(root).parts[0] != "llm")
    return hashlib.sha1(b"".join(f.read_bytes() for f in files)).hexdigest()
