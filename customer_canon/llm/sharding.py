"""Sharding by a permutation of global row numbers.

Rows are numbered from 0 without gaps: a hash deals them into ranges, one aggregate counts the ranges, and a
row's number is its range's start plus its place there. A Feistel network over just enough bits, walked again
while it lands beyond the last row, permutes those numbers; place ``p`` goes to shard ``p % shards``, slot
``p // shards``. So the shuffle can be repeated, shard sizes differ by one row at most, and ``place_of`` computes
where any row number is without reading anything.

The numbering depends on ids and texts only, not on files or tasks. Equal rows are counted first, so that they
cannot crowd one range, and take consecutive numbers.

Nulls: a null text has no bytes and checksum 0; null ids are ids. Rows that repeat are placed one by one. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that rows are numbered in; a row of the table that sums them is a few bytes.
RANGES = 4096
ROUNDS = 6


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 well mixed bits of each value."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _network(numbers: np.ndarray, half: int, seed: int) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = numbers >> np.uint64(half), numbers & mask
    for turn in range(ROUNDS):
        key = np.uint64((seed * 0x9E3779B97F4A7C15 + (turn + 1) * 0xD1B54A32D192ED03) % (1 << 64))
        left, right = right, left ^ (_mixed(right + key) & mask)
    return (left << np.uint64(half)) | right


def permuted(numbers: np.ndarray, rows: int, seed: int = 0) -> np.ndarray:
    """The place of each of the given row numbers in a permutation of ``range(rows)``."""
    half = max(1, ((max(rows, 2) - 1).bit_length() + 1) // 2)
    with np.errstate(over="ignore"):
        places = _network(np.asarray(numbers, dtype=np.uint64), half, seed)
        beyond = places >= rows
        while beyond.any():
            places[beyond] = _network(places[beyond], half, seed)
            beyond = places >= rows
    return places.astype(np.int64)


def place_of(number: int, rows: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """Shard and slot of one row number."""
    place = int(permuted(np.array([number]), rows, seed)[0])
    return place % shards, place // shards


def shard_rows(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 0, overhead: int = 16
) -> DataFrame:
    """``<id_col>, size, text_crc32, number, shard, slot`` for every row.

    ``size`` is the text's UTF-8 bytes plus ``overhead``, ``number`` the global row number.
    """

    @F.pandas_udf("long")
    def place(number: pd.Series, rows: pd.Series) -> pd.Series:
        return pd.Series(permuted(number.to_numpy(), int(rows.iloc[0]), seed) if len(number) else [], dtype="int64")

    text = F.coalesce(F.col(text_col), F.lit(""))
    same = (
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text).cast("long") + overhead).alias("size"),
            F.crc32(text).alias("text_crc32"),
        )
        .groupBy("id", "size", "text_crc32")
        .agg(F.count("*").alias("copies"))
        .withColumn("span", F.pmod(F.xxhash64("id", "size", "text_crc32"), F.lit(RANGES)))
    )
    earlier = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        same.groupBy("span")
        .agg(F.sum("copies").alias("held"))
        .withColumn("before", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
        .withColumn("rows", F.sum("held").over(Window.partitionBy(F.lit(0))))
        .select("span", "before", "rows")
    )
    inside = (
        Window.partitionBy("span").orderBy("id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    )
    numbered = (
        same.withColumn("inside", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
        .join(spans, "span")
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
        .withColumn("number", F.col("before") + F.col("inside") + F.col("copy"))
        .withColumn("place", place("number", "rows"))
    )
    return numbered.select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        "number",
        (F.col("place") % shards).cast("int").alias("shard"),
        F.floor(F.col("place") / shards).alias("slot"),
    )
