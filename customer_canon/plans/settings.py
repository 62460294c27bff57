"""Session settings for the length of one write."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# With the columns at hand a few dozen MB of shuffle data per partition.
ROWS_PER_SHUFFLE_PARTITION = 500_000

# Options belong to the session, which runs in several threads may share.
_ONE_AT_A_TIME = threading.RLock()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Sets SQL options and puts the previous ones back afterwards; other threads wait until then."""
    with _ONE_AT_A_TIME:
        yield from _set(spark, values)


def _set(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shuffle_for(
    spark: SparkSession, rows: int, rows_per_partition: int = ROWS_PER_SHUFFLE_PARTITION
) -> dict[str, str]:
    """Shuffle partitions to suit ``rows`` rows, and never fewer than the session has.

    Adaptive execution merges partitions that turn out small but cannot add any,
    so a number that does not grow with the data would end in spills.
    """
    key = "spark.sql.shuffle.partitions"
    return {key: str(max(-(-rows // rows_per_partition), int(spark.conf.get(key))))}
