"""Small file operations on whatever file system a path belongs to."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def any_match(spark: SparkSession, pattern: str) -> bool:
    fs, target = _open(spark, pattern)
    found = fs.globStatus(target)
    return found is not None and len(found) > 0


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _open(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """Writes a small file; without ``overwrite`` an existing one makes this fail."""
    fs, target = _open(spark, path)
    stream = fs.create(target, overwrite)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def write_text_once(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a small file if there is none; says whether it did."""
    try:
        write_text(spark, path, text)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise
    return True


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, in order; none where there is no such folder."""
    fs, target = _open(spark, folder)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def replace(spark: SparkSession, staged: str, target: str) -> None:
    """Renames ``staged`` over ``target`` in one step."""
    jvm = spark._jvm
    source = jvm.org.apache.hadoop.fs.Path(staged)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        source.toUri(), spark._jsc.hadoopConfiguration()
    ) if source.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        spark._jsc.hadoopConfiguration()
    )
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(source, jvm.org.apache.hadoop.fs.Path(target), options)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)
