"""Small things that the driver reads and writes itself, through Hadoop's file systems."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, address: str):
    """The file system of an address, and the address as a path of it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(address)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def list_files(spark: SparkSession, address: str) -> list[str]:
    """Files that Spark would read at a folder, a file or a pattern, by name."""
    files, path = file_system(spark, address)
    found: list[str] = []

    def add(statuses) -> None:
        for status in statuses or []:
            name = status.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            if status.isDirectory():
                add(files.listStatus(status.getPath()))
            else:
                found.append(status.getPath().toString())

    matches = files.globStatus(path)
    if not matches:
        raise FileNotFoundError(f"no such path: {address}")
    add(matches)
    return sorted(found)


def list_folders(spark: SparkSession, address: str) -> list[tuple[str, float]]:
    """(name, seconds since its last change) of the folders in a folder; none where there is none."""
    files, path = file_system(spark, address)
    if not files.exists(path):
        return []
    now = time.time()
    return [
        (status.getPath().getName(), now - status.getModificationTime() / 1000)
        for status in files.listStatus(path)
        if status.isDirectory()
    ]


def read_head(spark: SparkSession, address: str, encoding: str = "UTF-8") -> str | None:
    """The first line of a text file without its line end; None for an empty file.

    Compressed files are read through the codec of their name. A byte order mark is
    left out."""
    jvm = spark.sparkContext._jvm
    files, path = file_system(spark, address)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = files.open(path)
    try:
        plain = codec.createInputStream(stream) if codec is not None else stream
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, encoding)).readLine()
    finally:
        stream.close()
    return line.removeprefix("\ufeff") if line is not None else None


def read_small(spark: SparkSession, address: str) -> str | None:
    """A small text file, or None where there is none."""
    files, path = file_system(spark, address)
    if not files.exists(path):
        return None
    stream = files.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_small(spark: SparkSession, address: str, text: str) -> None:
    """Put a small text file in the place of another in one step: written beside it, renamed over it."""
    jvm = spark.sparkContext._jvm
    files, target = file_system(spark, address)
    target = files.makeQualified(target)
    fresh = jvm.org.apache.hadoop.fs.Path(f"{target.toString()}-{uuid.uuid4().hex}")
    stream = files.create(fresh, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(kind, 1)
    overwrite[0] = kind.OVERWRITE
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(
        fresh, target, overwrite
    )


def delete(spark: SparkSession, address: str) -> None:
    files, path = file_system(spark, address)
    files.delete(path, True)
