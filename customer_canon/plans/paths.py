"""Paths that a run must not confuse."""

from __future__ import annotations

import re
from itertools import combinations

from pyspark.sql import SparkSession


def _qualified(spark: SparkSession, path: str) -> str:
    """Scheme, authority and path without detours, closed by a slash; a pattern counts as the folder it starts in."""
    literal = re.split(r"[*?{\[]", path, maxsplit=1)
    if len(literal) > 1:
        path = literal[0].rpartition("/")[0] or ("/" if literal[0].startswith("/") else ".")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = store.makeQualified(hadoop).toUri().normalize()
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}{uri.getPath()}".rstrip("/") + "/"


def check_apart(spark: SparkSession, **paths: str | list[str] | None) -> None:
    """ValueError if one of the named paths equals or contains another, in whatever spelling."""
    each = [
        (name, one, _qualified(spark, one))
        for name, given in paths.items()
        if given is not None
        for one in ([given] if isinstance(given, str) else given)
    ]
    for (name, path, at), (other, other_path, other_at) in combinations(each, 2):
        if name != other and (at.startswith(other_at) or other_at.startswith(at)):
            raise ValueError(f"paths must differ and lie apart: {name} {path} and {other} {other_path}")
