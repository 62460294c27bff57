"""Mixing of sources, against a plain version and the SQL."""

from collections import Counter, defaultdict

import pytest

from customer_canon.llm import mixing


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by resharing, round after round."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    wanted, fixed = share * sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in fixed]
        if not left:
            return fixed
        level = (wanted - sum(fixed.values())) / sum(weight[s] for s in left)
        over = [s for s in left if level * weight[s] >= most * sizes[s]]
        if not over:
            return fixed | {s: level * weight[s] for s in left}
        fixed |= {s: float(most * sizes[s]) for s in over}


ROWS = [
    *[(i, f"w{i} " * (i % 7), f"s{i % 3}") for i in range(200)],
    (None, "no id here", "s1"),
    (901, None, "s1"),
    (902, "", "s2"),
    (903, "word " * 30_000, "s0"),
    (904, "alone in a nameless source", None),
    *[(905, "the same row again", "tiny")] * 5,
]


def test_targets_and_taken(make_docs):
    rows = mixing.mix_plan(make_docs(ROWS)).collect()
    assert len(rows) == len(ROWS)
    size = {}
    sizes = defaultdict(int)
    for i, text, source in ROWS:
        sizes[source] += len((text or "").split())
    expected = plain_targets(sizes)
    per_target = defaultdict(int)
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        per_target[r.source_size, r.target] += r.taken
        size[r.doc_id] = r.size
    assert size[901] == size[902] == 0 and size[903] == 30_000
    for source, target in expected.items():
        ((_, got),) = [k for k in per_target if k[0] == sizes[source] and k[1] == pytest.approx(target)]
        assert per_target[sizes[source], got] == pytest.approx(target, abs=6)  # five equal rows share a cut


def test_reruns_agree(make_docs):
    docs = make_docs(ROWS)
    assert Counter(mixing.mix_plan(docs).collect()) == Counter(mixing.mix_plan(docs.repartition(5)).collect())


def test_mixture_holds_what_was_taken(make_docs):
    docs = make_docs(ROWS)
    taken = Counter()
    for r in mixing.mix_plan(docs).collect():
        taken[r.doc_id] += r.taken
    got = Counter()
    texts = {i: t for i, t, _ in ROWS}
    for r in mixing.mixture(docs.selectExpr("*", "1 AS size", "'x' AS `key`", "2 AS mix_of")).collect():
        got[r.doc_id] += len(r.text.split())
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text) and r["size"] == 1
    assert got == +taken


def test_empty_table_and_no_words(make_docs):
    assert mixing.mix_plan(make_docs([])).collect() == []
    assert mixing.mixture(make_docs([])).collect() == []
    (row,) = mixing.mix_plan(make_docs([(1, None)])).collect()
    assert (row.size, row.source_size, row.target, row.taken) == (0, 0, 0.0, 0)
