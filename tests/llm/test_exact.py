"""Exact duplicates against brute force: nulls, repeated rows, crowded hashes, tables that spill."""

import random
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from customer_canon.llm import exact


def brute(rows):
    """``id, keep, size, sha`` of every row, and how many rows stay for each text and id."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)

    def largest(ids):
        return max(ids, key=lambda i: (i is not None, i or 0))

    each = [(i, largest(groups[t or ""]), len(groups[t or ""]), sha256((t or "").encode()).hexdigest()) for i, t in rows]
    return sorted(each, key=repr), sorted(((largest(ids), t) for t, ids in groups.items()), key=repr)


def check(frame, rows):
    got = frame.collect()
    every, kept = brute(rows)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == every
    stays = sorted([(r.doc_id, r.text_sha256) for r in got if r.kept], key=repr)
    assert stays == sorted([(i, sha256(t.encode()).hexdigest()) for i, t in kept], key=repr)


CASES = [
    (1, "a"), (2, "a"), (3, "a "), (4, None), (5, ""), (6, "ä"), (7, "ä"), (8, "x" * 300_000), (9, "x" * 300_000),
    (10, "x" * 299_999 + "y"), (11, "a"), (11, "a"), (11, "a"), (None, "a"), (None, "only null"), (None, "only null"),
    (12, "B"), (13, "b"), (14, "line\n"), (15, "line\r\n"), (16, "nul\x00"), (17, "nul"),
]


def test_all_cases(make_docs):
    check(exact.duplicate_rows(make_docs(CASES)), CASES)


@pytest.mark.parametrize("fits", [900, 1 << 20])
def test_spilled_levels_and_crowded_hashes(make_docs, fits):
    rng = random.Random(5)
    rows = [(i, "t%d " % rng.randrange(40) * 9) for i in range(150)] + [(300 + i, "hot") for i in range(80)]
    docs = make_docs(rows).repartition(7)
    check(exact.duplicate_rows(docs, fits=fits), rows)
    few = exact.duplicate_rows(docs, fits=fits, hash_of=lambda t: F.pmod(F.length(t), 2).cast("long"))
    check(few, rows)


def test_many_repeated_rows_of_one_text(make_docs):
    rows = [(7, "again")] * 3000 + [(i, f"single {i}") for i in range(50)]
    check(exact.duplicate_rows(make_docs(rows).repartition(5)), rows)


def test_string_ids(spark):
    rows = [("b", "x"), ("ab", "x"), ("z", "y")]
    got = exact.duplicate_rows(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in got) == [("ab", "b", False), ("b", "b", True), ("z", "z", True)]


def test_empty_table(make_docs):
    assert exact.duplicate_rows(make_docs([])).collect() == []
    assert exact.deduplicated(make_docs([])).collect() == []


def test_deduplicated_rows_keep_all_columns(make_docs):
    names = ["hash", "sha", "rows", "keep", "large", "row", "keep_rows", "id", "bytes"]
    docs = make_docs(CASES).withColumns({c: F.lit(c) for c in names})
    got = exact.deduplicated(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert sorted(((r.doc_id, r.text or "") for r in rows), key=repr) == brute(CASES)[1]
    assert all(r[c] == c for r in rows for c in names)


def test_table_probes_past_equal_hashes():
    table = exact.ContentTable(fits=1 << 20)
    for i in range(3000):
        assert table.add(7, b"%d" % (i % 1500), 1, i, 1)
    assert table.rows == [2] * 1500 and table.keep == list(range(1500, 3000))
    assert table.bytes == sum(map(len, table.texts))


def test_full_table_takes_no_new_text():
    table = exact.ContentTable(fits=1)
    assert table.add(1, b"long enough", 1, 1, 1)
    assert not table.add(2, b"other", 1, 2, 1)
    assert table.add(1, b"long enough", 2, 5, 2)
    assert (table.rows, table.keep, table.keep_rows) == ([3], [5], [2])
