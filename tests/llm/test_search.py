"""Ranked search against scoring every document."""

import random
import re
from math import floor, log

import numpy as np
import pytest

from customer_canon.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, most):
    held = [(i, terms(t)) for i, t, *_ in docs]
    held = [(i, ts) for i, ts in held if ts]
    total, words = len(held), sum(len(ts) for _, ts in held)
    rows = []
    for item in sorted({i for i, _ in items}, key=repr):
        wanted = {t for i, text in items if i == item for t in terms(text)}
        found = []
        for doc_id, ts in held:
            score = 0
            for term in wanted & set(ts):
                df, tf = sum(term in other for _, other in held), ts.count(term)
                weight = floor(1000 * log((2 * total + 2) / (2 * df + 1)))
                score += weight * ((10**9 * tf) // (1000 * tf + 20 * (50 + (50 * len(ts) * total) // words)))
            if score > 0:
                found.append((score, doc_id))
        found.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        rows += [(item, rank, doc_id, score) for rank, (score, doc_id) in enumerate(found[:most], 1)]
    return sorted(rows, key=repr)


def result(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


CASES = [
    (1, "Alpha beta ALPHA"), (2, "beta, gamma; delta"), (3, None), (4, ""), (5, "  .,; "), (6, "äpfel Äpfel ÄPFEL"),
    (7, "alpha " * 30_000), (8, "beta"), (8, "beta"), (None, "beta"), (9, "x1 1x x_1 x-1"), (10, "nul\x00alpha"),
]
ITEMS = [(1, "alpha, Beta"), (2, None), (3, "nothing known"), (4, "x 1 äpfel"), (5, "gamma"), (5, "delta"), (None, "beta"), (6, "beta beta")]


@pytest.mark.parametrize("most", [2, 50])
def test_all_cases(spark, make_docs, most):
    got = search.ranked_search(make_docs(CASES).repartition(3), items_of(spark, ITEMS), most=most)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert result(got) == brute(CASES, ITEMS, most)


def test_many_shards_and_blocks(spark, make_docs, monkeypatch):
    monkeypatch.setattr(search, "SHARD_DOCS", 40)
    monkeypatch.setattr(search, "BLOCK_ITEMS", 4)
    monkeypatch.setattr(search, "FIRST_READ", 2)
    rng = random.Random(3)
    words = [f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(5000)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 40)))) for i in range(400)]
    docs += [(400 + i, "w1 w2 w3") for i in range(80)]
    items = [(i, " ".join(rng.choices(words, k=8))) for i in range(9)]
    assert result(search.ranked_search(make_docs(docs).repartition(2), items_of(spark, items), most=7)) == brute(docs, items, 7)


def test_intervals_close_on_the_best(monkeypatch):
    monkeypatch.setattr(search, "FIRST_READ", 1)
    rng = np.random.default_rng(0)
    for turn in range(200):
        docs, lists, scores = 30, [], np.zeros(30)
        for _ in range(rng.integers(1, 6)):
            places = rng.permutation(docs)[: rng.integers(1, docs)]
            impacts = -np.sort(-rng.integers(0, 6, len(places))).astype(float)
            scores[places] += impacts
            lists.append((places, impacts))
        least = int(rng.integers(1, 9))
        best = np.lexsort((np.arange(docs), -scores))[:5]
        best = best[scores[best] >= least]
        got, values = search.no_random_access(lists, docs, 5, least)
        assert got.tolist() == best.tolist() and values.tolist() == scores[best].tolist()


def test_empty_tables(spark, make_docs):
    assert search.ranked_search(make_docs([]), items_of(spark, ITEMS)).collect() == []
    assert search.ranked_search(make_docs(CASES), items_of(spark, [])).collect() == []
