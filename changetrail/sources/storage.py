"""Folder checks through the file system Spark itself uses, whatever the path's scheme."""

from __future__ import annotations

import re
import tempfile
import time
import uuid

from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    file_system, target = _handle(spark, path)
    return file_system.exists(target)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly below a folder, none if there is no such folder."""
    file_system, target = _handle(spark, folder)
    return [s.getPath().getName() for s in file_system.listStatus(target)] if file_system.exists(target) else []


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern with ``*``."""
    file_system, target = _handle(spark, pattern)
    return [s.getPath().toString() for s in file_system.globStatus(target) or ()]


def create(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False, and nothing done, if it exists. This is what decides between two writers."""
    file_system, target = _handle(spark, path)
    return file_system.createNewFile(target)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    file_system, target = _handle(spark, path)
    stream = file_system.create(target, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    file_system, target = _handle(spark, path)
    stream = file_system.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def age_seconds(spark: SparkSession, path: str) -> float:
    """How long ago a file or folder was last written."""
    file_system, target = _handle(spark, path)
    return time.time() - file_system.getFileStatus(target).getModificationTime() / 1000


def delete(spark: SparkSession, path: str) -> bool:
    file_system, target = _handle(spark, path)
    return file_system.delete(target, True)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder that every executor can reach.

    It lies in the folder named by ``spark.checkpoint.dir``. Only a local session may do
    without one, in which case this machine's temporary folder serves.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="changetrail-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
