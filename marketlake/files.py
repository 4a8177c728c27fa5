"""Listing and deleting folders on whatever file system the lake lives on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def same_place(spark: SparkSession, one: str, other: str) -> bool:
    """Whether two paths, with or without their scheme, name the same place."""

    def full(path: str) -> tuple[str, str, str]:
        fs, target = _open(spark, path)
        uri = fs.makeQualified(target).toUri()
        return uri.getScheme() or "", uri.getAuthority() or "", uri.getPath().rstrip("/")

    return full(one) == full(other)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder, none when it does not exist."""
    fs, target = _open(spark, folder)
    return [entry.getPath().getName() for entry in fs.listStatus(target)] if fs.exists(target) else []


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    fs, target = _open(spark, path)
    fs.create(target, True).close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, whole."""
    fs, target = _open(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place at once: written under another name, then renamed."""
    fs, target = _open(spark, path)
    _, part = _open(spark, f"{path}.part")
    stream = fs.create(part, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    if not fs.rename(part, target):
        raise OSError(f"can't put {path} in place")


def delete_at_end(spark: SparkSession, folder: str) -> None:
    """Remove a folder when this application's file systems are closed."""
    fs, target = _open(spark, folder)
    fs.deleteOnExit(target)


def delete(spark: SparkSession, folder: str) -> None:
    fs, target = _open(spark, folder)
    fs.delete(target, True)
