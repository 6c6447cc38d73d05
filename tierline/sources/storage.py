"""Small text files and folders through the Hadoop file system of their path.

Only names and a few kilobytes of text pass here; rows never do.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class AlreadyExists(Exception):
    """Another writer created the file first."""


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; empty when the folder does not exist."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return [status.getPath().getName() for status in fs.listStatus(target)]


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _open(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def length(spark: SparkSession, path: str) -> int:
    """Bytes of a file; 0 when it is empty or there is none."""
    fs, target = _open(spark, path)
    return fs.getFileStatus(target).getLen() if fs.exists(target) else 0


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.mkdirs(target)


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a file with all its text, or not at all; raises ``AlreadyExists`` if there is one.

    The text is written under another name first and then renamed without overwriting. An empty
    file in the way is what a writer that died has left, and is removed.
    """
    fs, target = _open(spark, path)
    if fs.exists(target) and fs.getFileStatus(target).getLen() == 0:
        fs.delete(target, False)
    hadoop = spark._jvm.org.apache.hadoop.fs
    draft = hadoop.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.NONE
    try:
        context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), options)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            raise AlreadyExists(path) from error
        raise


def create_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A new small file."""
    fs, target = _open(spark, path)
    stream = fs.create(target, False)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder; false when there was none."""
    fs, target = _open(spark, path)
    return fs.delete(target, True)


def full_path(spark: SparkSession, path: str) -> str:
    """Path with its scheme, without ``.`` and ``..`` steps."""
    fs, target = _open(spark, path)
    plain = fs.makeQualified(target).toUri().normalize().toString()
    return plain.rstrip("/")
