"""Ranked lexical search by NRA: sequential reads of impact-sorted lists, with score intervals for each document.

One pass over the documents cuts them into shards and writes, for each, the postings of the terms that are asked for.
The counts of all shards give every term its weight. Then each shard's lists are sorted by impact, the share of
a score that a posting gives, and every item reads its lists from the top, in rounds that double in size. A
document's lower bound is what has been read of it; its upper bound adds, for each list where it has not been met, the
impact that comes next there. Reading goes on until no document that was not met can reach the least score among the
best, and the bounds of all that can have closed. So membership, ties and scores are exact. A task carries the best of
its earlier shards along as the score to reach; the best of all tasks are ranked at the end.

A shard is bounded by its postings and documents, so nothing depends on how common a term is; a text with more terms
is a shard alone. Items are searched for in blocks, each a pass over the documents; the terms of one block go to all tasks.

Nulls: a null text has no terms, as a document and as an item; items without terms have no rows. A null id of a
document comes last among equal scores. Rows with an equal id are documents of their own; items with an equal id, null
included, are one item with the terms of all. Empty tables give an empty result. Whole texts are searched, however
long. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from customer_canon.llm.common import Scratch, cut

#: Letters and digits of ASCII, lowered, and all bytes beyond; others end a term.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Items that are searched for in one pass.
BLOCK_ITEMS = 1000
#: Postings and documents of a shard.
SHARD_POSTINGS, SHARD_DOCS = 1 << 21, 1 << 14
#: Postings of each list that are read in the first round.
FIRST_READ = 64

_SHARD = "doc_ids array<{id}>, lengths binary, terms binary, postings binary, places binary, tfs binary, docs long, words long"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_TERM_BYTES).split()


class _Shard:
    """Documents and their occurrences of known terms."""

    def __init__(self):
        self.ids: list = []
        self.lengths: list[int] = []
        self.found: list[np.ndarray] = []
        self.postings = self.docs = self.words = 0

    def add(self, doc_id, length: int, found: list[int]) -> None:
        self.docs += 1
        self.words += length
        if found:
            self.ids.append(doc_id)
            self.lengths.append(length)
            self.found.append(np.array(found, dtype=np.int64))
            self.postings += len(found)

    def full(self) -> bool:
        return self.postings >= SHARD_POSTINGS or len(self.ids) >= SHARD_DOCS

    def batch(self, id_type: pa.DataType) -> pa.RecordBatch:
        # places follow the ids, so that of equal scores the smaller place comes first
        order = sorted((i for i, doc_id in enumerate(self.ids) if doc_id is not None), key=self.ids.__getitem__)
        order += [i for i, doc_id in enumerate(self.ids) if doc_id is None]
        places = np.empty(len(order), dtype=np.int64)
        places[order] = np.arange(len(order))
        owner = np.repeat(places, [len(f) for f in self.found])
        keys = np.concatenate([np.empty(0, dtype=np.int64), *self.found]) * max(1, len(order)) + owner
        keys, tfs = np.unique(keys, return_counts=True)
        terms, postings = np.unique(keys // max(1, len(order)), return_counts=True)
        blobs = (np.array(self.lengths, dtype=np.int64)[order], terms, postings, keys % max(1, len(order)), tfs)
        columns = [pa.array([[self.ids[i] for i in order]], type=pa.list_(id_type))]
        columns += [pa.array([b.astype(np.int64 if k == 0 else np.int32).tobytes()]) for k, b in enumerate(blobs)]
        columns += [pa.array([self.docs]), pa.array([self.words])]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _SHARD.split(", ")])


def _index(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """``id, text`` rows as shards: postings of the terms in ``numbers``, and counts of all documents and words."""

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, id_type, number_of = _Shard(), pa.null(), numbers.get
        for batch in batches:
            id_type = batch.schema.field("id").type
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                terms = terms_of(text.as_py() or b"")
                if terms:
                    shard.add(doc_id, len(terms), [n for n in map(number_of, terms) if n is not None])
                    if shard.full():
                        yield shard.batch(id_type)
                        shard = _Shard()
        if shard.docs:
            yield shard.batch(id_type)

    return docs.mapInArrow(indexed, _SHARD.format(id=docs.schema["id"].dataType.simpleString()))


def _document_counts(index: DataFrame) -> DataFrame:
    """``term, df`` of all shards."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for terms, postings in zip(*(c.to_pylist() for c in batch.columns)):
                each = np.bincount(np.frombuffer(terms, dtype=np.int32), np.frombuffer(postings, dtype=np.int32)).astype(np.int64)
                short, long = sorted((total, each), key=len)
                total = long.copy()
                total[: len(short)] += short
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "df"])

    counts = index.select("terms", "postings").mapInArrow(counted, "term long, df long")
    return counts.groupBy("term").agg(F.sum("df").alias("df"))


def no_random_access(lists: list[tuple[np.ndarray, np.ndarray]], docs: int, most: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores, best first, of the ``most`` best documents that reach ``least`` (above 0); ties by place.

    Each list holds places and impacts, falling by impact. All values are whole numbers that doubles hold exactly.
    """
    lower = np.zeros(docs)
    missing = np.ones((docs, len(lists)))
    alive, at, step = None, 0, FIRST_READ
    while True:
        ahead = np.zeros(len(lists))
        for number, (places, impacts) in enumerate(lists):
            some = places[at : at + step]
            lower[some] += impacts[at : at + step]
            missing[some, number] = 0
            if at + step < len(places):
                ahead[number] = impacts[at + step]
        at, step = at + step, 2 * step
        if docs > most:
            least = max(least, np.partition(lower, docs - most)[docs - most])
        if alive is not None:
            met = alive
        elif ahead.sum() < least:
            met = np.flatnonzero(lower)  # no document that has not been met can reach it any more
        else:
            continue
        upper = lower[met] + missing[met] @ ahead
        alive = met[upper >= least]
        if (lower[alive] == upper[upper >= least]).all():
            best = alive[np.lexsort((alive, -lower[alive]))][:most]
            return best, lower[best].astype(np.int64)


def _best(index: DataFrame, asked: list[tuple[list[int], object]], weights: np.ndarray, docs: int, words: int, most: int, item_type: str, id_type: str) -> DataFrame:
    """``item_id, doc_id, score``: the best of each task's shards for each of ``asked`` (terms, item)."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in asked]
        kind = None
        for batch in batches:
            kind = batch.schema.field("doc_ids").type.value_type
            for ids, *blobs in zip(*(c.to_pylist() for c in batch.columns)):
                lengths, terms, postings, places, tfs = (
                    np.frombuffer(b, dtype=np.int64 if k == 0 else np.int32).astype(np.int64) for k, b in enumerate(blobs)
                )
                mean = 50 + (50 * lengths * docs) // words
                owner = np.repeat(np.arange(len(terms)), postings)
                impacts = weights[terms][owner] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * mean[places]))
                order = np.lexsort((places, -impacts, owner))
                places, impacts = places[order], impacts[order].astype(float)
                ends = np.cumsum(postings)
                lists = {
                    int(t): (places[e - p : e], impacts[e - p : e]) for t, p, e in zip(terms, postings, ends) if weights[t] > 0
                }
                for number, (wanted, _) in enumerate(asked):
                    some = [lists[t] for t in wanted if t in lists]
                    if some:
                        reach = best[number][most - 1][0] if len(best[number]) >= most else 1
                        found = no_random_access(some, len(ids), most, reach)
                        both = best[number] + [(int(s), ids[p]) for p, s in zip(*found)]
                        both.sort(key=lambda x: (-x[0], x[1] is None, 0 if x[1] is None else x[1]))
                        best[number] = both[:most]
        rows = [(item, doc_id, score) for (_, item), found in zip(asked, best) for score, doc_id in found]
        if rows:
            items, doc_ids, scores = zip(*rows)
            columns = [pa.array(items), pa.array(doc_ids, type=kind), pa.array(scores, type=pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["item_id", "doc_id", "score"])

    columns = index.select("doc_ids", "lengths", "terms", "postings", "places", "tfs")
    return columns.mapInArrow(searched, f"item_id {item_type}, doc_id {id_type}, score long")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    most: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``<item_col>, rank, <id_col>, score`` of each item's ``most`` best documents with a score above 0."""
    spark = docs.sparkSession
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("binary").alias("text"))
    wanted = items.select(items[item_col].alias("item"), items[item_text_col].cast("binary").alias("text"))
    item_type, id_type = (f.schema[0].dataType.simpleString() for f in (wanted, texts))
    blocks = max(1, ceil(wanted.count() / BLOCK_ITEMS))
    with Scratch(spark, batch_rows=200) as scratch:
        found = spark.createDataFrame([], f"item_id {item_type}, doc_id {id_type}, score long")
        for block in range(blocks):
            rows = wanted.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()
            terms: dict = {}
            for item, text in rows:
                terms.setdefault(item, set()).update(terms_of(bytes(text or b"")))
            numbers = {term: n for n, term in enumerate(sorted(set().union(*terms.values())))}
            index = scratch.keep(_index(texts, numbers))
            total, words = index.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
            weights = np.zeros(len(numbers), dtype=np.int64)
            for term, df in _document_counts(index).collect():
                weights[term] = floor(1000 * log((2 * total + 2) / (2 * df + 1)))
            asked = [(sorted(map(numbers.__getitem__, held)), item) for item, held in terms.items()]
            with Scratch(spark, batch_rows=2):
                best = _best(index, asked, weights, total, words, most, item_type, id_type)
                found = found.unionByName(scratch.keep(best))
        order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
        return cut(ranked.select(F.col("item_id").alias(item_col), "rank", F.col("doc_id").alias(id_col), "score"))


SEARCH_SQL = r"""
WITH terms AS (
  SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents) GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf) AS n FROM terms GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(n) AS words FROM lengths),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM terms, totals GROUP BY term, docs),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words)))) AS BIGINT) AS score
  FROM asked JOIN terms USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 50
"""
