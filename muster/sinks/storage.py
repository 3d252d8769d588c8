"""Marks in the storage that the tables live in: small files that say what is complete and who holds what.

Only names and short notes pass here, never rows. Paths may be of any storage that Spark's Hadoop client reaches.
"""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Name of the mark in a folder whose rows are all written. Spark does not read names that begin like this.
COMPLETE = "_COMPLETE"


def _open(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _open(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of a run's own; nothing happens if it is not there."""
    fs, at = _open(spark, path)
    fs.delete(at, True)


def find(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a glob pattern matches, sorted."""
    fs, at = _open(spark, pattern)
    found = [status.getPath() for status in fs.globStatus(at) or []]
    return sorted(path.toString() for path in found if not path.getName().startswith("."))


def claim(spark: SparkSession, path: str, note: str = "") -> bool:
    """Create a file that must not exist yet, with its whole note; False if it does. Of several at once, one succeeds.

    The note is written beside and put in place by one step that fails if the name is taken: a hard link locally, a
    rename on HDFS and its like. Object stores of the s3 family have no rename; there the file is created exclusively and seen
    when it is closed.
    """
    fs, at = _open(spark, path)
    scheme = fs.getUri().getScheme()
    beside = f".{at.getName()}-{uuid.uuid4().hex}"
    if scheme == "file":
        local = at.toUri().getPath()
        written = os.path.join(os.path.dirname(local), beside)
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(written, "w", encoding="utf-8") as out:
            out.write(note)
        try:
            os.link(written, local)
        except FileExistsError:
            return False
        finally:
            os.unlink(written)
        return True
    if scheme.startswith("s3"):
        try:
            _write(fs, at, note)
        except Py4JJavaError:
            if fs.exists(at):
                return False
            raise
        return True
    written = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), beside)
    _write(fs, written, note)
    placed = not fs.exists(at) and fs.rename(written, at)
    if not placed:
        fs.delete(written, False)
    return placed


def _write(fs, at, note: str) -> None:
    out = fs.create(at, False)
    out.write(bytearray(note, "utf-8"))
    out.close()


def note(spark: SparkSession, path: str) -> str:
    """What the owner of a claim wrote into it."""
    fs, at = _open(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def age_seconds(spark: SparkSession, path: str) -> float:
    fs, at = _open(spark, path)
    return (spark._jvm.System.currentTimeMillis() - fs.getFileStatus(at).getModificationTime()) / 1000


def complete(spark: SparkSession, folder: str) -> bool:
    return exists(spark, f"{folder}/{COMPLETE}")


def mark_complete(spark: SparkSession, folder: str) -> None:
    claim(spark, f"{folder}/{COMPLETE}")
