"""Near-duplicate vectors against all pairs in double precision."""

import math
import random

import numpy as np
import pytest

from customer_canon.llm import vectors
from customer_canon.llm.components import components

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, least=0.98):
    """links and component of each row, by all pairs."""

    def usable(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links = [[] for _ in rows]
    for i, (_, v, a) in enumerate(rows):
        for j, (_, w, b) in enumerate(rows):
            if i != j and usable(v, a) and usable(w, b) and a == b and len(v) == len(w):
                x, y = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    links[i].append(j)
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            low = min([root[i], *(root[j] for j in links[i])])
            changed |= low != root[i]
            root[i] = low
    found = []
    for i, (vec_id, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        component = min(ids, default=None)
        found.append((vec_id, len(links[i]), component, vec_id is not None and vec_id == component))
    return sorted(found, key=str)


def near(v, rng, spread):
    return [x + rng.gauss(0, spread) for x in v]


def test_all_cases(spark):
    rng = random.Random(4)
    rows = []
    for label in (0, 1):
        for group in range(3):
            centre = [rng.gauss(0, 1) for _ in range(24)]
            rows += [(1000 * label + 100 * group + i, near(centre, rng, 0.12), label) for i in range(40)]
        rows += [(1000 * label + 900 + i, [rng.gauss(0, 1) for _ in range(24)], label) for i in range(60)]
    same = rows[0][1]
    rows += [(5000 + i, same, 0) for i in range(5)] + [(5000, same, 0), (None, same, 0), (None, None, 0)]
    rows += [(6000, same, None), (6001, [], 0), (6002, [0.0] * 24, 0), (6003, [math.nan] * 24, 0)]
    rows += [(6004, [math.inf] * 24, 0), (6005, [None, 1.0], 0), (6006, [1.0], 0), (6007, [2.0], 0), (6008, [-1.0], 0)]
    rows += [(6009, [1e30, 1e30], 0), (6010, [1e-30, 1e-30], 0), (6011, [x * 3 for x in same], 0)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS node", "2 AS n", "'x' AS tile")
    got = vectors.link_vectors(frame).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)


def test_large_bucket_is_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rng = random.Random(9)
    centre = [rng.gauss(0, 1) for _ in range(16)]
    rows = [(i, near(centre, rng, 0.1), 3) for i in range(150)]
    got = vectors.link_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)


def test_doubles_and_empty(spark):
    rows = [(1, [1.0, 2.0], 1), (2, [2.0, 4.0], 1), (3, [2.0, -4.0], 1)]
    got = vectors.link_vectors(spark.createDataFrame(rows, SCHEMA.replace("float", "double"))).collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    assert vectors.link_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_estimates_are_unbiased():
    rng = np.random.default_rng(0)
    units = vectors.unit_rows(rng.normal(size=(400, 64)))
    errors = []
    for seed in range(5):
        code, factor = vectors.codes_of(units, seed)
        signs = np.unpackbits(np.frombuffer(b"".join(c.tobytes() for c in code), np.uint8).reshape(400, -1), axis=1) * 2.0 - 1
        estimate = (units @ vectors.rotation(64, 0, seed)) @ signs.T / (8 * factor)
        errors.append(estimate - units @ units.T)
    off = np.stack(errors)[:, ~np.eye(400, dtype=bool)]
    assert abs(off.mean()) < 0.002 and off.std() < 0.12


@pytest.mark.parametrize("shape", ["path", "star", "none"])
def test_components(spark, shape):
    edges = {"path": [(i + 1, i) for i in range(60)], "star": [(7, i) for i in range(40)], "none": [(1, 1)]}[shape]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    nodes = {n for e in edges for n in e} if shape != "none" else set()
    assert {r.node for r in got} == nodes and len(got) == len(nodes) and {r.component for r in got} <= {0}


def test_bounds_hold_and_spare_exact_computations():
    """No pair at the threshold is ruled out, and few of the others are left."""
    import pandas as pd

    rng = np.random.default_rng(5)
    for length in (2, 24, 64, 100):
        centres = rng.normal(size=(30, length))
        units = vectors.unit_rows(np.repeat(centres, 10, axis=0) + rng.normal(size=(300, length)) * 0.12)
        code, factor = vectors.codes_of(units, 3)
        planes, low, step = vectors.planes_of(units, 3)
        words = vectors.words_of(np.unpackbits(code, axis=1)[:, :length])
        rows = pd.DataFrame({"tile": 1, "band": 0, "half": 0, "node": range(300), "length": length, "factor": factor, "low": low, "step": step})
        rows = rows.assign(code=[c.tobytes() for c in words], planes=[p.tobytes() for p in planes], marks=[bytes(4)] * 300)
        tiles = vectors.Tiles(rows, 0.98, 20)
        kept = {(i, j) for first, second in tiles.pairs() for i, j in zip(first.tolist(), second.tolist())}
        cosines = units @ units.T
        linked = {(i, j) for i in range(300) for j in range(i + 1, 300) if cosines[i, j] >= 0.98}
        assert linked <= kept
        if length >= 64:
            assert linked and len(kept) < 0.05 * 300 * 299 / 2
            assert set(tiles.hopeful()["node"]) == {i for pair in kept for i in pair}
