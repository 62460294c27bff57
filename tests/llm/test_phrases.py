"""Collocations against counting every phrase."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from customer_canon.llm import phrases


def brute(rows, support=10, most=2000, inside=50):
    f = defaultdict(Counter)
    for lang, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^ \t]+", piece)
            for size in (1, 2, 3):
                f["und" if lang is None else lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    found = []
    for lang, count in f.items():
        n = sum(c for p, c in count.items() if len(p) == 1)
        ranked = []
        for p, a in count.items():
            if len(p) == 1 or a < support:
                continue
            longer = [c for q, c in count.items() if len(q) == 3 and c >= support and p in (q[:2], q[1:])]
            if len(p) == 2 and any(100 * c >= inside * a for c in longer):
                continue
            cuts = [(10**6 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        ranked.sort()
        found += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(ranked[:most], 1)]
    return sorted(found)


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


CASES = [
    ("en", "New York\tCity new york city, NEW YORK. city\x0bnew york " * 8), (None, "null lang here " * 12), ("en", None),
    ("", "empty name empty name " * 6), ("en", ""), ("de", "Ä ä über\x00 über " * 20), ("de", " .,;! "), ("de", "a" * 50_000),
    ("en", "aa aa aa aa aa aa aa aa aa aa aa aa aa"), ("fr", "x\x1cy z\x85w " * 11), ("und", "null lang here"),
]


def test_all_cases(spark):
    docs = frame(spark, CASES).repartition(3).withColumns({c: F.lit(1) for c in ("phrase", "count", "hash", "n", "a")})
    got = phrases.collocations(docs)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(CASES)


@pytest.mark.parametrize("share", [0.01, 0.5])
def test_border_failures_and_small_blocks(spark, monkeypatch, share):
    """A sample of a few texts proposes next to nothing, so that all is found by further passes."""
    monkeypatch.setattr(phrases, "BLOCK_WORDS", 500)
    monkeypatch.setattr(phrases, "OUT_ROWS", 50)
    rng = random.Random(1)
    words = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(250):
        text = rng.choices(words, weights=[1 / (k + 1) for k in range(30)], k=rng.randrange(5, 60))
        at = rng.randrange(len(text))
        text[at:at] = rng.choice([["red", "blue", "green"], ["salt", "and", "pepper"], ["w1", "w2"], [","], ["."]])
        rows.append((rng.choice(["en", "en", "de"]), " ".join(text)))
    got = phrases.collocations(frame(spark, rows).repartition(4), share=share, most=40)
    assert sorted(map(tuple, got.collect())) == brute(rows, most=40)


def test_crowded_map_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MAP_BITS", 6)
    monkeypatch.setattr(phrases, "ROW_BITS", 5)
    assert sorted(map(tuple, phrases.collocations(frame(spark, CASES)).collect())) == brute(CASES)


def test_counts_beyond_64_bits(spark):
    rows = [("en", "big numbers " * 30_000)] * 120
    got = phrases.collocations(frame(spark, rows)).collect()
    a, n = 30_000 * 120, 60_000 * 120
    assert {(r.phrase, r.a, r.l, r.r, r.n) for r in got if r.phrase == "numbers big numbers"} <= {("numbers big numbers", a - 120, a, a, n)}
    assert all(r.score == 10**6 * r.a * r.a // (r.l * r.r) for r in got) and got


def test_empty_table(spark):
    assert phrases.collocations(frame(spark, [])).collect() == []
    assert phrases.collocations(frame(spark, [("en", None), ("en", " ,")])).collect() == []
