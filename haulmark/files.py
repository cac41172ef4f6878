"""Small files and folders on whatever file system Spark writes to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def names(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds, hidden files aside; nothing if it is not there."""
    fs, at = _at(spark, folder)
    found = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(n for n in found if not n.startswith("."))


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _at(spark, path)
    stream = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not be there yet; False if it is. Written aside and renamed: nobody meets half a file."""
    fs, at = _at(spark, path)
    folder, _, _ = path.rpartition("/")
    _, aside = _at(spark, f"{folder}/.{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(at) or not fs.rename(aside, at):
        fs.delete(aside, False)
        return False
    return True


def versions(spark: SparkSession, paths) -> list[str]:
    """Path, size and time of change of each file, by name; one listing per folder."""
    wanted, found = set(paths), []
    for folder in sorted({p.rpartition("/")[0] for p in wanted}):
        fs, at = _at(spark, folder)
        for s in fs.listStatus(at):
            if s.getPath().toUri().toString() in wanted or s.getPath().toString() in wanted:
                found.append(f"{s.getPath()} {s.getLen()} {s.getModificationTime()}")
    return sorted(found)
