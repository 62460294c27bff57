"""Near-duplicate documents against all pairs, and their alignment against a plain one."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from customer_canon.llm import common, near
from customer_canon.llm.queries import QUERIES


def shingles(text):
    return near.labelled_shingles(text, 5, near._WordHashes())


def plain_alignment(a, b):
    """Longest common subsequence by the full table."""
    table = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
    common = table[-1, -1]
    return common / (len(a) + len(b) - common)


def plain_components(rows, least=0.8):
    parts = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if len(parts[i]) and len(parts[j]) and find(i) != find(j):
                if rows[i][1] == rows[j][1] or plain_alignment(parts[i], parts[j]) >= least:
                    root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    found = []
    for i, (doc_id, _) in enumerate(rows):
        found.append((doc_id, min((x for x in groups[find(i)] if x is not None), default=None)))
    return Counter(found)


def edited(text, rng, edits):
    words = text.split()
    for _ in range(edits):
        spot = rng.randrange(len(words))
        words[spot : spot + 1] = rng.choice([[], ["changed"], [words[spot], "added"]])
    return " ".join(words)


@pytest.mark.parametrize("seed", range(6))
def test_alignment_equals_the_full_table(seed, text_of):
    rng = random.Random(seed)
    text = text_of(seed, 60)
    for edits in (0, 1, 2, 4, 9):
        a, b = shingles(text), shingles(edited(text, rng, edits))
        exact = plain_alignment(a, b)
        got = near.alignment(a, b, 0.8)
        assert got == pytest.approx(exact) if exact >= 0.8 else got < 0.8


def test_moved_and_repeated_text():
    words = "a b c d e f g h".split()
    a, b = shingles(" ".join(words * 8)), shingles(" ".join(words * 8 + ["tail"]))
    assert len(set(a.tolist())) == len(a)  # repeats carry different labels
    assert near.alignment(a, b, 0.8) == pytest.approx(plain_alignment(a, b))


def cases(text_of):
    rng = random.Random(1)
    rows = []
    for group in range(12):
        text = text_of(group, rng.choice([6, 12, 36, 60]))
        base = 100 * group
        rows += [(base, text), (base + 1, text), (base + 2, edited(text, rng, 1)), (base + 3, edited(text, rng, 2))]
    passage = text_of(77, 40)
    rows += [(5000 + i, f"{text_of(200 + i, 30)} {passage} {text_of(300 + i, 30)}") for i in range(20)]
    rows += [(7000, None), (7001, None), (7002, ""), (7003, " \n "), (7004, "one two"), (7005, "one  two"), (7006, "two one")]
    rows += [(None, rows[0][1]), (None, text_of(400)), (7010, text_of(401)), (7010, text_of(402)), (8003, rows[0][1]), (8003, rows[0][1])]
    return rows


def test_components_equal_all_pairs(make_docs, text_of):
    rows = cases(text_of)
    docs = make_docs(rows).selectExpr("*", "1 AS node", "2 AS key_a", "'x' AS component", "3 AS bucket")
    got = near.duplicate_classes(docs).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == plain_components(rows)
    # of every group one row is kept, also where its id repeats or is null; texts without shingles are all kept
    texts = defaultdict(set)
    for doc_id, text in rows:
        texts[doc_id].add(text)
    bare = {i for i, t in rows if not (t or "").split()}
    groups, kept = Counter(), Counter()
    for r in got:
        if r.doc_id in bare:
            assert r.kept
        else:
            groups[r.component_id] += 1
            kept[r.component_id] += r.kept
            assert not r.kept or r.doc_id == r.component_id
    named = {c for c in groups if c is not None and len(texts[c]) == 1}
    assert all(kept[c] == 1 for c in named)
    assert sum(r.kept for r in got) == near.deduplicated(docs).count()
    assert Counter(r.doc_id for r in got if r.kept) == Counter(r.doc_id for r in near.deduplicated(docs).collect())


def test_repeated_rows_keep_one(spark, make_docs, text_of, monkeypatch):
    monkeypatch.setattr(common, "COPIES", 3)
    rows = [(1, text_of(1))] * 8 + [(2, text_of(1)), (None, text_of(2)), (None, text_of(2)), (3, None), (3, None), (4, text_of(3))]
    got = Counter(map(tuple, near.duplicate_classes(make_docs(rows)).collect()))
    want = {(1, 1, True): 1, (1, 1, False): 7, (2, 1, False): 1, (None, None, True): 1, (None, None, False): 1}
    assert got == Counter(want | {(3, 3, True): 2, (4, 4, True): 1})
    assert sorted(str(r.doc_id) for r in near.deduplicated(make_docs(rows)).collect()) == ["1", "3", "3", "4", "None"]


def test_registered_query_agrees_with_what_stays(spark, query_dir):
    docs = spark.read.parquet(f"{query_dir}/documents.parquet")
    got = QUERIES["op4_near_duplicates"](spark, query_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert sorted(r.doc_id for r in got if r.kept) == sorted(r.doc_id for r in near.deduplicated(docs).select("doc_id").collect())


def test_large_groups_are_linked_through_finer_buckets(make_docs, text_of, monkeypatch):
    monkeypatch.setattr(near, "HUBS", 1)
    rng = random.Random(3)
    texts = [text_of(1, 90), text_of(2, 90)]
    rows = [(1000 * k + i, edited(t, rng, i % 4)) for k, t in enumerate(texts) for i in range(40)]
    got = near.duplicate_classes(make_docs(rows)).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == plain_components(rows)


def copies(text, count, edits, seed):
    """Each with some words replaced by ones that no other copy has."""
    rng, rows = random.Random(seed), []
    for i in range(count):
        words = text.split()
        for spot in rng.sample(range(len(words)), edits):
            words[spot] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    return rows


def joined(links, count):
    root = list(range(count))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in links:
        root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(count)]


def test_many_copies_without_their_original(make_docs, text_of):
    rows = copies(text_of(11, 104), 300, 2, 1)
    parts = [shingles(t) for _, t in rows]
    links = [(i, j) for i in range(300) for j in range(i) if near.alignment(parts[i], parts[j], 0.8) >= 0.8]
    got = {r.doc_id: r.component_id for r in near.duplicate_classes(make_docs(rows)).collect()}
    assert [got[i] for i in range(300)] == joined(links, 300)


@pytest.mark.parametrize("block", [16, 128])
def test_hubs_that_link_nothing_end_no_bucket(make_docs, text_of, monkeypatch, block):
    monkeypatch.setattr(near, "HUBS", 0)
    monkeypatch.setattr(near, "BLOCK", block, raising=False)
    monkeypatch.setattr(near, "COUNTED", 50, raising=False)
    rng = random.Random(6)
    rows = [(1000 * k + i, edited(text_of(20 + k, 60), rng, 1 + i % 3)) for k in range(2) for i in range(50)]
    got = near.duplicate_classes(make_docs(rows)).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == plain_components(rows)


def test_common_counts():
    rng = np.random.default_rng(4)
    sides = [[rng.choice(9000, n, replace=False) for n in sizes] for sizes in ([0, 5, 8000], [7000, 0, 30, 1])]
    counts = near.common_counts(*sides)
    assert counts.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sides[1]] for a in sides[0]]


def test_one_of_each_group_stays(make_docs, text_of):
    rows = cases(text_of)
    docs = make_docs(rows).selectExpr("*", "1 AS row", "2 AS near_a", "'x' AS stays")
    stay = near.deduplicated(docs)
    assert stay.columns == docs.columns
    left = Counter(r.doc_id for r in stay.collect())
    linked = plain_components([r for r in rows if (r[1] or "").split()])
    groups = {component for (_, component) in linked if component is not None}
    assert left[7000] == left[7001] == left[7002] == left[7003] == 1
    expected = len(groups) + 4 + 1 + 1  # texts without words, the text with no id, the second text of id 7010
    assert sum(left.values()) == expected and left[0] == 1 and left[8003] == 0


def test_empty_table(make_docs):
    assert near.duplicate_classes(make_docs([])).collect() == []
    assert near.deduplicated(make_docs([])).collect() == []


def test_long_text(make_docs, text_of):
    text = text_of(5, 25_000)
    rng = random.Random(2)
    rows = [(1, text), (2, edited(text, rng, 300)), (3, text_of(6, 25_000))]
    assert {(r.doc_id, r.component_id) for r in near.duplicate_classes(make_docs(rows)).collect()} == {(1, 1), (2, 1), (3, 3)}


def test_profiles_never_undercount(text_of):
    rng = random.Random(6)
    texts = [text_of(k % 4, rng.choice([3, 30, 90, 100, 400, 2000])) for k in range(40)] + ["same words " * 40]
    whole = [shingles(edited(t, rng, rng.randrange(6))) for t in texts]
    profiles = [near.profile(s) for s in whole]
    may = np.ones((len(whole), len(whole)), dtype=bool)
    most = near.most_common(profiles, profiles, may)
    assert (most >= near.common_counts(whole, whole)).all() and (np.diag(most) == [len(s) for s in whole]).all()
    crowded = near.profile(np.arange(300, dtype=np.uint64) << np.uint64(20))
    assert len(crowded) == 0 and np.isinf(near.most_common([crowded], profiles, may[:1])).all()


def test_shared_passage_leaves_few_rows(text_of):
    """Texts that have a third of their words in common share a bucket, but their sequences are not asked for."""
    passage = text_of(999, 60)
    whole = [shingles(passage + " " + text_of(k, 120)) for k in range(100)]
    whole.append(shingles(passage + " " + text_of(7, 120) + " more"))
    none = [np.empty(0, dtype=np.int64)] * len(whole)
    size = np.array([len(s) for s in whole], dtype=float)
    rows = near.tile_rows(1, np.zeros(101), np.arange(101), size, none, [near.profile(s) for s in whole], 0.8)
    assert rows[[7, 100]].all() and rows.sum() <= 10
    assert near.tile_links(1, np.zeros(101), np.arange(101), whole, none, 0.8) == [(7, 100)]


def counted_tiles(monkeypatch):
    rows, tiled = [], near._tiled

    def counting(tiles, *rest):
        rows.append(tiles.count())
        return tiled(tiles, *rest)

    monkeypatch.setattr(near, "_tiled", counting)
    return rows


def test_rows_of_tiles_do_not_grow_with_the_square_of_a_group(make_docs, text_of, monkeypatch):
    """Copies with edits of their own share buckets, but no other text holds enough of their shingles."""
    monkeypatch.setattr(near, "BLOCK", 16)
    made = counted_tiles(monkeypatch)
    own = copies(text_of(11, 104), 240, 5, 1)
    shared = [(1000 + i, f"{text_of(12, 60)} {text_of(2000 + i, 40)}") for i in range(240)]
    near_ones = [(5000, own[7][1] + " more"), (5001, shared[9][1] + " more")]
    got = {r.doc_id: r.component_id for r in near.duplicate_classes(make_docs(own + shared + near_ones)).collect()}
    assert got == {i: i for i, _ in own + shared} | {5000: 7, 5001: 1009}
    assert made[0] <= 100


@pytest.mark.parametrize(("block", "compared"), [(16, 3), (64, 16)])
def test_sides_of_a_tile_in_parts_miss_no_pair(make_docs, text_of, monkeypatch, block, compared):
    for name, value in {"HUBS": 0, "BLOCK": block, "COMPARED": compared, "LISTED": 500}.items():
        monkeypatch.setattr(near, name, value, raising=False)
    rng = random.Random(8)
    rows = [(1000 * k + i, edited(text_of(40 + k, 50 + i % 20), rng, i % 5)) for k in range(2) for i in range(45)]
    got = near.duplicate_classes(make_docs(rows)).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == plain_components(rows)


def test_alone_counts_shingles_of_one_text(spark, text_of):
    texts = [text_of(1, 60), edited(text_of(1, 60), random.Random(1), 3), text_of(2, 30), text_of(2, 30), "one two", ""]
    whole = [shingles(t) for t in texts]
    frame = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(whole)], "node long, sequence binary")
    found = {r.node: r.alone for r in near._alone(frame.repartition(3)).collect()}
    texts_of = Counter(x for s in whole for x in s.tolist())
    want = {i: sum(texts_of[x] == 1 for x in s.tolist()) for i, s in enumerate(whole)}
    assert found == {i: n for i, n in want.items() if n}
