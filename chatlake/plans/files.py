"""Small files and listings on any file system that Spark reads."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    path: str
    modified: float
    is_folder: bool


def _place(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def listed(spark: SparkSession, folder: str) -> list[Entry]:
    """What stands in a folder, by name; nothing if there is none."""
    where, fs = _place(spark, folder)
    try:
        found = fs.listStatus(where)
    except Py4JJavaError as e:
        if "FileNotFound" not in str(e.java_exception):
            raise
        return []
    entries = [Entry(s.getPath().getName(), f"{folder}/{s.getPath().getName()}", s.getModificationTime() / 1000, s.isDirectory()) for s in found]
    return sorted(entries, key=lambda e: e.name)


def read_text(spark: SparkSession, path: str) -> str:
    where, fs = _place(spark, path)
    stream = fs.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def put(spark: SparkSession, path: str, text: str, once: bool = False) -> bool:
    """A small file that appears whole, in place of an older one or, ``once``, only where there is none (else False)."""
    fs_package = spark._jvm.org.apache.hadoop.fs
    place, fs = _place(spark, path)
    draft = fs_package.Path(place.getParent(), f"_{uuid.uuid4().hex}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(fs_package, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 0 if once else 1)
    if not once:
        options[0] = rename.OVERWRITE
    try:
        fs_package.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(draft, place, options)
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if not once or "FileAlreadyExists" not in str(e.java_exception):
            raise
        return False
    return True
