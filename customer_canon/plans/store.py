"""Small files and folders on whatever storage a path names."""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str) -> tuple:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    store, at = _at(spark, path)
    return store.exists(at)


def names(spark: SparkSession, folder: str) -> list[str]:
    """What the folder holds, sorted; nothing if it is not there."""
    store, at = _at(spark, folder)
    return sorted(status.getPath().getName() for status in store.listStatus(at)) if store.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    store, at = _at(spark, path)
    store.delete(at, True)


def put_json(spark: SparkSession, path: str, value: dict) -> None:
    """Writes the file whole or not at all: under another name first, which readers pass over.

    FileExistsError if it is there already. Of two writers at the same moment one gets that error where renaming
    refuses to overwrite, as on HDFS.
    """
    store, at = _at(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f"_{uuid4().hex}-{at.getName()}")
    out = store.create(aside, True)
    try:
        out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    finally:
        out.close()
    if store.exists(at) or not store.rename(aside, at):
        store.delete(aside, False)
        raise FileExistsError(path)


def get_json(spark: SparkSession, path: str) -> dict | None:
    """What ``put_json`` wrote; None if the file is not there."""
    store, at = _at(spark, path)
    if not store.exists(at):
        return None
    stream = store.open(at)
    try:
        return json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
    finally:
        stream.close()


def listing(spark: SparkSession, path: str | list[str]) -> list[tuple[str, int, int]]:
    """Name, length and time of change of every file that a path or pattern names, folders with all below them."""
    found = []
    for one in [path] if isinstance(path, str) else path:
        store, at = _at(spark, one)
        for status in store.globStatus(at) or []:
            files = store.listFiles(status.getPath(), True)
            while files.hasNext():
                file = files.next()
                if not file.getPath().getName().startswith(("_", ".")):
                    found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return sorted(found)
