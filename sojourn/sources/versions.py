"""Versions of a published folder: numbered files, each written once, that name the run readers see.

A publisher remembers the latest number it saw and creates the next one. Creating is exclusive, so of several
publishers that saw the same version one wins and the others learn it; no reader ever sees a
half-promoted run.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class PublishConflict(RuntimeError):
    """Another run was promoted since this one began."""


def _hadoop(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    found, fs = _hadoop(spark, path)
    return fs.exists(found)


def remove_folder(spark: SparkSession, path: str) -> None:
    found, fs = _hadoop(spark, path)
    fs.delete(found, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, whole."""
    found, fs = _hadoop(spark, path)
    stream = fs.open(found)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write(spark: SparkSession, fs, path, text: str) -> None:
    stream = fs.create(path, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file if there is none; of several writers at once exactly one gets True.

    A store's own exclusive create decides. A local disk's looks first and writes then, so there the
    written file is linked to its name, which fails if the name is taken.
    """
    target, fs = _hadoop(spark, path)
    fs.mkdirs(target.getParent())
    try:
        if fs.getUri().getScheme() != "file":
            _write(spark, fs, target, text)
            return True
        own, _ = _hadoop(spark, f"{path}.{uuid.uuid4().hex}.tmp")
        _write(spark, fs, own, text)
        try:
            nio, local = spark._jvm.java.nio.file, lambda p: spark._jvm.java.io.File(fs.makeQualified(p).toUri()).toPath()
            nio.Files.createLink(local(target), local(own))
            return True
        finally:
            fs.delete(own, False)
    except Py4JJavaError as failure:
        if "FileAlreadyExists" in failure.java_exception.getClass().getName():
            return False
        raise


def versions(spark: SparkSession, gold: str) -> list[int]:
    """Numbers of all promoted versions, rising."""
    folder, fs = _hadoop(spark, f"{gold}/versions")
    if not fs.exists(folder):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(folder))
    return sorted(int(name) for name in names if name.isdigit())


def latest(spark: SparkSession, gold: str) -> int:
    """Number of the version readers see, 0 if there is none."""
    return max(versions(spark, gold), default=0)


def run_of(spark: SparkSession, gold: str, version: int) -> str:
    """Folder of the run that a version names."""
    return read_text(spark, f"{gold}/versions/{version:012d}").strip()


def promote(spark: SparkSession, gold: str, seen: int, run: str) -> int:
    """Make the run the version after the one seen; raises if there is one already."""
    number = seen + 1
    if not create_once(spark, f"{gold}/versions/{number:012d}", f"{run}\n"):
        raise PublishConflict(f"version {number} of {gold} was promoted by another publisher; this run is {run}")
    return number
