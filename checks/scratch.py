"""Folders for intermediate tables, on storage that every executor shares."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

_ROOTS: dict[str, str] = {}


def _file_system(spark: SparkSession, folder: str) -> tuple:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _root(spark: SparkSession) -> str:
    """One folder for each application, deleted when its driver ends, in whatever way it ends."""
    application = spark.sparkContext.applicationId
    if application not in _ROOTS:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not spark.conf.get("spark.master", "").startswith("local"):
                raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.gettempdir()
        root = f"{shared.rstrip('/')}/customer-canon-{application}-{uuid4().hex}"
        store, path = _file_system(spark, root)
        store.mkdirs(path)
        store.deleteOnExit(path)
        _ROOTS[application] = root
    return _ROOTS[application]


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder below ``spark.checkpoint.dir``.

    Without that setting a local session uses the machine's temporary folder;
    a cluster session must name a shared one.
    """
    return f"{_root(spark)}/{label}-{uuid4().hex}"


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder made by ``scratch_folder`` on whatever storage it lives."""
    store, path = _file_system(spark, folder)
    store.delete(path, True)
