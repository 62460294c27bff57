"""Exact duplicates by Grace hash deduplication.

Tasks first combine the equal texts among their own rows, then deal what is left to buckets by a hash of the text. The
task of a bucket keeps an open-addressing table of whole texts: a hash finds the slot, and only equal bytes make two
rows members of one group. A table takes new texts until they fill its memory. From then on, rows of texts that it does
not hold go to a spill file, and all spill files together are dealt again by another hash, until nothing is spilled. A
text is in the table of its bucket or none of its rows are, so each group is complete where it is closed.

A bucket holds each text at most once for every task that read it. Texts with more than a thousandth of all rows, of
which there are fewer than a thousand, are dealt to as many buckets as the square root of the number of tasks first,
and meet in one table a level later. Rows find their group again by hash and SHA-256 of their text: groups with more
than a thousandth of the rows are broadcast, all others joined by a shuffle.

Nulls: a null text is empty. A null id is smaller than any other. Empty texts are equal to each other. Rows with equal
ids and texts are members each, and one of them stays. An empty table gives an empty result. Texts of any length are
compared whole; one that is larger than a table's memory gets a table alone. Other columns are ignored, or kept by
``deduplicated``, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import ceil

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from customer_canon.llm.common import Scratch, as_rows, columns_of, cut, shuffle_partitions

#: Bytes of distinct texts that one table holds.
FITS = 64 << 20
#: Texts and groups with more than one row of so many count as large; there are fewer of them than this.
LARGE = 1000
#: What a row is found again by.
SAME = ["hash", "sha"]


class ContentTable:
    """Open-addressing table of texts, each with its number of rows, its largest id and that id's number of rows."""

    def __init__(self, fits: int):
        self.fits = fits
        self.clear()

    def clear(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.texts: list[bytes] = []
        self.rows: list[int] = []
        self.keep: list = []
        self.keep_rows: list[int] = []
        self.bytes = 0

    def full(self) -> bool:
        return self.bytes >= self.fits

    def _slot(self, key: int, text: bytes) -> int:
        """The slot that holds ``text``, or the empty one where it would go."""
        mask = len(self.slots) - 1
        slot = (key ^ key >> 32) & mask
        while (place := self.slots[slot]) >= 0 and (self.hashes[place] != key or self.texts[place] != text):
            slot = (slot + 1) & mask
        return slot

    def add(self, key: int, text: bytes, rows: int, keep, keep_rows: int) -> bool:
        """Counts the rows in; False if the table does not hold the text and is full."""
        slot = self._slot(key, text)
        place = self.slots[slot]
        if place < 0:
            if self.full():
                return False
            self.slots[slot] = len(self.texts)
            self.hashes.append(key)
            self.texts.append(text)
            self.rows.append(rows)
            self.keep.append(keep)
            self.keep_rows.append(keep_rows)
            self.bytes += len(text)
            if 2 * len(self.texts) > len(self.slots):
                self._grow()
            return True
        self.rows[place] += rows
        before = self.keep[place]
        if keep == before:
            self.keep_rows[place] += keep_rows
        elif before is None or (keep is not None and keep > before):
            self.keep[place], self.keep_rows[place] = keep, keep_rows
        return True

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for place, key in enumerate(self.hashes):
            slot = (key ^ key >> 32) & mask
            while self.slots[slot] >= 0:
                slot = (slot + 1) & mask
            self.slots[slot] = place


#: Rows dealt to buckets. ``salt`` is above zero for the parts of a large text, null where a group is closed; then
#: ``text`` is null too.
PARTS = "hash long, sha binary, text binary, bytes long, rows long, keep {id}, keep_rows long, salt int"
#: Rows of a batch that leaves a table, and about how many bytes of texts.
OUT_ROWS, OUT_BYTES = 10_000, 16 << 20


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2] or b"")
        if len(held) >= OUT_ROWS or size >= OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _parts_schema(id_type: pa.DataType) -> pa.Schema:
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), id_type, pa.int64(), pa.int32()]
    return pa.schema(list(zip(("hash", "sha", "text", "bytes", "rows", "keep", "keep_rows", "salt"), kinds)))


def _combined(records: DataFrame, fits: int, salts: int, schema: str) -> DataFrame:
    """``hash, text, id, large`` of all rows as parts: each task's distinct texts, as far as its table holds them."""

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, large, id_type = ContentTable(fits), set(), pa.null()
        salt = 1 + TaskContext.get().partitionId() % salts

        def parts() -> Iterator[tuple]:
            for place, text in enumerate(table.texts):
                key = table.hashes[place]
                part = (table.rows[place], table.keep[place], table.keep_rows[place], salt if key in large else 0)
                yield (key, None, text, len(text), *part)

        for batch in batches:
            id_type = batch.schema.field("id").type
            for key, text, row_id, is_large in zip(*(batch.column(c).to_pylist() for c in ("hash", "text", "id", "large"))):
                if is_large:
                    large.add(key)
                if not table.add(key, text, 1, row_id, 1):
                    yield from _batches(parts(), _parts_schema(id_type))
                    table.clear()
                    large = {key} if is_large else set()
                    table.add(key, text, 1, row_id, 1)
        yield from _batches(parts(), _parts_schema(id_type))

    return records.mapInArrow(combined, schema)


def _bucketed(parts: DataFrame, fits: int, schema: str) -> DataFrame:
    """Every partition as one bucket: its closed groups without their texts, and what goes to the next level."""

    def bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, salted, id_type = ContentTable(fits), set(), pa.null()

        def spilled(batch: pa.RecordBatch) -> Iterator[tuple]:
            for key, _, text, size, rows, keep, keep_rows, salt in zip(*(c.to_pylist() for c in batch.columns)):
                if not table.add(key, text, rows, keep, keep_rows):
                    yield key, None, text, size, rows, keep, keep_rows, salt
                elif salt:
                    salted.add(key)

        def groups() -> Iterator[tuple]:
            for place, text in enumerate(table.texts):
                key, size = table.hashes[place], len(text)
                counts = (table.rows[place], table.keep[place], table.keep_rows[place])
                if key in salted:
                    yield key, None, text, size, *counts, 0
                else:
                    yield key, hashlib.sha256(text).digest(), None, size, *counts, None

        for batch in batches:
            id_type = batch.schema.field("keep").type
            yield from _batches(spilled(batch), _parts_schema(id_type))
        yield from _batches(groups(), _parts_schema(id_type))

    return parts.mapInArrow(bucketed, schema)


def _hashed(rows: DataFrame, hash_of: Callable[[Column], Column]) -> DataFrame:
    """``rows`` with ``id`` and ``text``, and the hash and SHA-256 of the text."""
    return rows.withColumns({"hash": hash_of(F.col("text")), "sha": F.unhex(F.sha2(F.col("text").cast("binary"), 256))})


def _id_and_text(row_id: Column, text: Column) -> list[Column]:
    return [row_id.alias("id"), F.coalesce(text, F.lit("")).alias("text")]


def _narrow(texts: DataFrame, hash_of: Callable[[Column], Column]) -> DataFrame:
    """``id, hash, sha, bytes`` of every row, and its ``place``, of which the upper bits number the task that read it."""
    size = F.octet_length("text").cast("long").alias("bytes")
    return _hashed(texts, hash_of).select("id", *SAME, size, F.monotonically_increasing_id().alias("place"))


def _groups(texts: DataFrame, narrow: DataFrame, fits: int, hash_of: Callable[[Column], Column], scratch: Scratch) -> DataFrame:
    """``hash, sha, rows, keep, keep_rows, large`` of each distinct text, out of the tables of all buckets."""
    schema = PARTS.format(id=texts.schema["id"].dataType.simpleString())
    total, size, tasks = narrow.agg(
        F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.max(F.shiftright("place", 33)) + 1, F.lit(1))
    ).first()
    counts = narrow.groupBy("hash").agg(F.count("*").alias("rows"))
    large = counts.where(F.col("rows") * LARGE > total).select("hash", F.lit(True).alias("large"))
    records = texts.withColumn("hash", hash_of(F.col("text"))).join(F.broadcast(large), "hash", "left")
    records = records.select("hash", F.col("text").cast("binary").alias("text"), "id", F.coalesce("large", F.lit(False)).alias("large"))

    salts = ceil(tasks**0.5)
    parts, closed, level = _combined(records, fits, salts, schema), [], 0
    while True:
        buckets = max(shuffle_partitions(texts), ceil(2 * size / fits))
        dealt = parts.repartition(buckets, F.xxhash64(F.lit(level), "hash", "salt"))
        done = scratch.keep(_bucketed(dealt, fits, schema))
        closed.append(done.where("text IS NULL"))
        parts = done.where("text IS NOT NULL")
        left, size = done.where("sha IS NULL").agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
        if not left:
            break
        level += 1
    groups = closed[0]
    for more in closed[1:]:
        groups = groups.unionByName(more)
    return groups.select(*SAME, "rows", "keep", "keep_rows", (F.col("rows") * LARGE > total).alias("large"))


def _with_group(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with what their group holds; nulls for texts that occur once."""
    large = F.broadcast(groups.where("large"))
    others = groups.where("rows > 1 AND NOT large")
    return rows.join(large, SAME).unionByName(rows.join(large, SAME, "left_anti").join(others, SAME, "left"))


def duplicate_rows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    fits: int = FITS,
    hash_of: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """``<id_col>, keep_id, group_size, kept, text_sha256`` of every row; of equal texts the one with the largest id stays.

    ``fits`` is the memory of a table in bytes. ``hash_of`` deals texts to buckets and slots; any function is right.
    """
    texts = docs.select(*_id_and_text(docs[id_col], docs[text_col]))
    with Scratch(docs.sparkSession) as scratch:
        narrow = scratch.keep(_narrow(texts, hash_of))
        groups = scratch.keep(_groups(texts, narrow, fits, hash_of, scratch))
        found = _with_group(narrow, groups)
        stays = F.col("rows").isNull() | F.col("id").eqNullSafe(F.col("keep"))
        repeated = groups.where("rows > 1 AND keep_rows > 1")
        if not repeated.isEmpty():
            # rows with the group's largest id and the same text: the first of them stays
            first = found.where("rows > 1 AND keep_rows > 1 AND id <=> keep").groupBy(*SAME).agg(F.min("place").alias("first"))
            first = scratch.keep(first)
            repeated = repeated.select(*SAME, "large").join(first, SAME)
            large = F.broadcast(repeated.where("large").drop("large"))
            others = repeated.where("NOT large").drop("large")
            is_large = F.coalesce("large", F.lit(False))
            found = found.where(is_large).join(large, SAME, "left").unionByName(found.where(~is_large).join(others, SAME, "left"))
            stays = stays & F.coalesce(F.col("place") == F.col("first"), F.lit(True))
        return cut(
            found.select(
                F.col("id").alias(id_col),
                F.when(F.col("rows").isNull(), F.col("id")).otherwise(F.col("keep")).alias("keep_id"),
                F.coalesce("rows", F.lit(1)).cast("long").alias("group_size"),
                stays.alias("kept"),
                F.lower(F.hex("sha")).alias("text_sha256"),
            )
        )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fits: int = FITS) -> DataFrame:
    """The rows of ``docs`` that stay, one for each text, with all their columns as they are."""
    row = F.col("row")
    whole = as_rows(docs).select("row", *_id_and_text(row.getField(id_col), row.getField(text_col)))
    with Scratch(docs.sparkSession) as scratch:
        texts = whole.drop("row")
        groups = scratch.keep(_groups(texts, scratch.keep(_narrow(texts, F.xxhash64)), fits, F.xxhash64, scratch))
        found = _with_group(_hashed(whole, F.xxhash64).drop("text"), groups)
        kept = found.where("rows IS NULL OR id <=> keep")
        single = kept.where("rows IS NULL OR keep_rows = 1").select("row")
        repeated = kept.where("keep_rows > 1").dropDuplicates(SAME).select("row")
        return cut(single.unionByName(repeated)).select(*columns_of(docs.columns))


EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
WINDOW same AS (PARTITION BY text)
"""
