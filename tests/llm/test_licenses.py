"""License scan against a plain search for phrases, and planted passages."""

import random
import re
from collections import Counter

import pytest

from customer_canon.llm import common, licenses
from customer_canon.llm.queries import QUERIES


def plain(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
    places = []
    for label, phrase in licenses.PHRASES:
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


TEXTS = [
    "This is the MIT License. The MIT\nlicense, again: mit-license; emit license; mit licenses",
    "cc by cc by, CC-BY 4.0 and cc: by",
    "GNU General Public License / Apache License",
    "gnu general public public license apache license K mit licenſe İ MIT LICENSE İ",
    "mit",
    "license",
    "",
    None,
    "... !!",
    "word " * 30_000 + "apache license",
    "mit license " * 400,
    "中文 mit license 中文",
]


def test_base_equals_a_plain_search(make_docs):
    rows = [*enumerate(TEXTS), (0, TEXTS[0]), (0, TEXTS[0]), (None, TEXTS[1])]
    docs = make_docs(rows).selectExpr("*", "1 AS id", "2 AS place", "3 AS tag", "'x' AS words")
    got = licenses.scan_licenses(docs).collect()
    found = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got)
    assert found == Counter((i, *plain(t)) for i, t in rows)
    for r in got:
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))


def test_passages_with_a_changed_word_are_found(make_docs, text_of):
    passage = licenses.PASSAGES[3][1].split()
    changed = " ".join(passage[:9] + ["inserted", "words"] + passage[9:20] + passage[21:])
    docs = make_docs([(1, f"{text_of(1)} {changed} {text_of(2)}"), (2, text_of(3)), (3, " ".join(reversed(passage)))])
    rows = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    assert rows[1].labels == "apache-2.0" and 0.7 <= rows[1].score < 1
    assert [(s.start, s.label) for s in rows[1].spans] == [(80, "apache-2.0")]
    assert rows[2].labels == rows[3].labels == "" and rows[2].score == 0


def test_empty_table(make_docs):
    assert licenses.scan_licenses(make_docs([])).collect() == []


def changed(words, rng, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at : at + 1] = rng.choice([[], ["other"], [words[at], "more"]])
    return words


def test_library_of_whole_texts(spark, make_docs, text_of, monkeypatch):
    rng = random.Random(8)
    library = [(f"owner's {i}", text_of(900 + i, 600)) for i in range(12)]
    table = spark.createDataFrame(library, "label string, text string")
    rows = [(i, f"{text_of(i)} {' '.join(changed(text.split(), rng, 30))} {text_of(50 + i)}") for i, (_, text) in enumerate(library)]
    rows += [(100 + i, text_of(300 + i, 600)) for i in range(12)] + [(200, " ".join(library[0][1].split()[:200]))]
    want = {i: label for i, (label, _) in enumerate(library)}
    found = []
    for most in (50_000, 10):  # sent to every task, or shuffled
        monkeypatch.setattr(licenses.broadcast_if_small, "__defaults__", (most,))
        for passages in (table, library):
            got = licenses.scan_licenses(make_docs(rows), passages=passages, share=0.6).collect()
            assert {r.doc_id: r.labels for r in got if r.labels} == want
            found.append(Counter(map(str, got)))
    assert all(f == found[0] for f in found)


def test_template_of_one_word(make_docs):
    with pytest.raises(ValueError, match="needs 2 words"):
        licenses.scan_licenses(make_docs([(1, "x")]), phrases=[("a", "one")])


def test_row_repeated_often(spark, make_docs, monkeypatch):
    monkeypatch.setattr(common, "COPIES", 7)
    docs = spark.range(50).selectExpr("1L AS doc_id", "'the mit license' AS text")
    got = licenses.scan_licenses(docs.unionByName(make_docs([(2, "x")]).select("doc_id", "text"))).collect()
    assert Counter((r.doc_id, r.n_base) for r in got) == {(1, 1): 50, (2, 0): 1}


def test_registered_query_equals_a_plain_search(spark, query_dir):
    rows = spark.read.parquet(f"{query_dir}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op3_licenses"](spark, query_dir).collect()
    found = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got)
    assert found == Counter((r.doc_id, *plain(r.text)) for r in rows) and any(r.n_base for r in got)
    assert all(set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
