"""Sharding: a permutation, gapless slots, repeatable whatever the layout."""

import zlib
from collections import Counter

import numpy as np
import pytest

from customer_canon.llm import sharding


@pytest.mark.parametrize("rows", [1, 2, 3, 40, 1000, 4097])
def test_permutation(rows):
    places = sharding.permuted(np.arange(rows), rows, seed=5)
    assert sorted(places) == list(range(rows))
    assert rows < 40 or not np.array_equal(places, np.arange(rows))
    assert sharding.place_of(rows - 1, rows, 7, seed=5) == (places[-1] % 7, places[-1] // 7)


def test_shards_of_documents(make_docs):
    rows = [*[(i, f"text {i}é" * (i % 5)) for i in range(300)], *[(7, "same")] * 50, (None, None), (None, None), (900, "")]
    docs = make_docs(rows).selectExpr("*", "1 AS span", "2 AS copies", "3 AS size")
    got = sharding.shard_rows(docs, 8).collect()
    sizes = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == sizes
    held = Counter(r.shard for r in got)
    assert set(held) == set(range(8)) and max(held.values()) - min(held.values()) <= 1
    for shard, n in held.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    for r in got[:20]:
        assert sharding.place_of(r.number, len(rows), 8) == (r.shard, r.slot)
    again = sharding.shard_rows(docs.repartition(7, "n_chars"), 8).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_empty_table_and_single_row(make_docs):
    assert sharding.shard_rows(make_docs([]), 4).collect() == []
    (row,) = sharding.shard_rows(make_docs([(1, "x")]), 4).collect()
    assert (row.shard, row.slot) == (0, 0)
