"""Near-duplicate vectors by randomly rotated binary codes.

Vectors are compared within one label and one length. Equal vectors become one class first. A seeded random rotation
turns a unit vector into sign bits; stored next to them is the correction factor, the inner product of the vector
with its own code. Dividing by it makes the code's inner product with a rotated query an unbiased estimate of their
cosine, with an error bound that follows from the factor. The query side is held in 256 levels, as eight planes of bits,
so an estimate is a few bit counts on packed words; what the levels round off is added to the bound. Only pairs whose
bound reaches the threshold are computed exactly, in double precision.

Which pairs are looked at: bits of further rotations are cut into bands, about as long as the number of vectors
has binary digits, and as many that a pair at the threshold agrees in none of them with probability ``miss``. So the
number of unrelated pairs that meet grows with the number of vectors, not with its square. Vectors that agree in a
band form a bucket. Large buckets are split into blocks, and every two blocks of a bucket meet in one tile, so
a dense group is spread over many tasks and no pair of it is left out. Tiles are formed twice: first of codes alone, which
says for each row whether any pair of it may link, then of the rows left, now with their vectors. So a vector travels
only where a pair of it is computed. A tile sends on counts and a spanning forest of its links, not pairs; a pair that
meets in several bands is looked at in the first of them.

Nulls: a vector that is null, empty, zero, or holds null or non-finite components, or has a null label, links with
nothing. Ids may be null or repeat; the component is named after the smallest id in it, and stays null if there is
none. Repeated rows are vectors of their own. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from customer_canon.llm.common import Scratch, cut
from customer_canon.llm.components import components

#: Vectors of a block; a tile holds two blocks.
BLOCK = 256
#: Width of the error bound of estimates, in standard errors.
DEVIATIONS = 5.0
#: Planes of bits that hold the levels of a query.
PLANES = 8
#: Components of the vectors of a batch that goes to Python, and rows of it at most.
BATCH_COMPONENTS = 1 << 21
MOST_BATCH_ROWS = 10_000


def rotation(length: int, turn: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    normal = np.random.default_rng([seed, length, turn]).normal(size=(length, length))
    q, r = np.linalg.qr(normal)
    return q * np.sign(np.diag(r))


@lru_cache(maxsize=1)
def rotations(length: int, turns: int, seed: int) -> list[np.ndarray]:
    """The rotations that bands are taken from."""
    return [rotation(length, turn, seed) for turn in range(1, turns + 1)]


def band_plan(classes: int, least: float, miss: float) -> tuple[int, int]:
    """Bits of a band and number of bands for so many vectors.

    Three bits more than the number of vectors has leave one unrelated vector to meet in every eighth band; each further
    bit halves that and takes 1 / (1 - angle / pi) times as many bands, 7% more at a cosine of 0.98.
    """
    bits = max(8, min(60, math.ceil(math.log2(max(classes, 2))) + 3))
    same = (1 - math.acos(least) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-same))


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # so that squares stay in range
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def codes_of(units: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits of the rotated vectors, packed, and their correction factors."""
    turned = units @ rotation(units.shape[1], 0, seed)
    return np.packbits(turned >= 0, axis=1), np.abs(turned).sum(axis=1) / math.sqrt(units.shape[1])


def words_of(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    packed = np.packbits(bits, axis=1)
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


def planes_of(units: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rotated vectors in levels, as planes of words, with the lowest level and the step of each."""
    turned = units @ rotation(units.shape[1], 0, seed)
    low = turned.min(axis=1)
    step = (turned.max(axis=1) - low) / (2**PLANES - 1)
    levels = np.rint((turned - low[:, None]) / np.where(step > 0, step, 1)[:, None]).astype(np.uint8)
    return np.stack([words_of(levels >> plane & 1) for plane in range(PLANES)], axis=1), low, step


def bands_of(units: np.ndarray, bits: int, bands: int, seed: int) -> np.ndarray:
    length = units.shape[1]
    turns = math.ceil(bits * bands / length)
    signs = np.hstack([units @ turn >= 0 for turn in rotations(length, turns, seed)])
    signs = signs[:, : bits * bands].reshape(len(units), bands, bits)
    return signs @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def band_type(bits: int) -> type:
    """The narrowest type that holds a band's bits."""
    return np.uint32 if bits <= 32 else np.int64


def _forest(first: np.ndarray, second: np.ndarray, size: int) -> np.ndarray:
    """For ``size`` nodes and the given edges, the smallest node of each one's component."""
    root = np.arange(size)
    while True:
        before = root.copy()
        low = np.minimum(root[first], root[second])
        np.minimum.at(root, first, low)
        np.minimum.at(root, second, low)
        root = root[root]
        if (root == before).all():
            return root


class Tiles:
    """Rows of whole tiles, sorted by tile, all of one length, and the pairs of them that may link."""

    def __init__(self, rows: pd.DataFrame, least: float, bits: int):
        self.rows, self.least = rows, least
        self.length = int(rows["length"].iloc[0])
        self.code = self._words("code")
        self.planes = self._words("planes").reshape(len(rows), PLANES, -1)
        weights = 1 << np.arange(PLANES)
        low, step, factor = (rows[c].to_numpy() for c in ("low", "step", "factor"))
        # the inner product of code and query is a scaled count of level bits under the code's bits, plus parts of each side
        self.ones = np.bitwise_count(self.code).sum(axis=1, dtype=np.int64)
        self.total = self.length * low + step * (np.bitwise_count(self.planes).sum(axis=2, dtype=np.int64) @ weights)
        self.weights, self.low, self.step, self.factor = weights, low, step, factor
        if self.length > 1:
            spread = math.sqrt(1 - max(least, 0.0) ** 2) / math.sqrt(self.length - 1)
            self.error = DEVIATIONS * spread * np.sqrt(np.maximum(1 - factor**2, 0)) / factor
        else:
            self.error = np.full(len(rows), np.inf)
        self.marks = np.stack([np.frombuffer(m, dtype=band_type(bits)) for m in rows["marks"]])

    def _words(self, column: str) -> np.ndarray:
        return np.frombuffer(b"".join(self.rows[column]), dtype=np.uint64).reshape(len(self.rows), -1)

    def highest(self, query: np.ndarray, coded: np.ndarray) -> np.ndarray:
        """The most that the cosines of the rows ``query`` and ``coded`` may be, by planes of the one and code of the other."""
        under = np.bitwise_count(self.planes[query] & self.code[coded][:, None, :]).sum(axis=2, dtype=np.int64) @ self.weights
        inner = 2 * (self.low[query] * self.ones[coded] + self.step[query] * under) - self.total[query]
        rounded = self.step[query] * math.sqrt(self.length) / 2
        return (inner / math.sqrt(self.length) + rounded) / self.factor[coded] + self.error[coded]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of the pairs that may link, each pair in the first band that it meets in."""
        tile, band, half = (self.rows[c].to_numpy() for c in ("tile", "band", "half"))
        for apart in range(1, len(tile)):
            first = np.flatnonzero(tile[:-apart] == tile[apart:])
            if not len(first):
                return
            second = first + apart
            # a tile of two blocks compares across them only; a tile of one (half 0) all its rows
            keep = (half[first] != half[second]) | (half[first] == 0)
            first, second = first[keep], second[keep]
            near = self.highest(first, second) >= self.least
            first, second = first[near], second[near]
            fresh = (self.marks[first] == self.marks[second]).argmax(axis=1) == band[first]
            yield first[fresh], second[fresh]

    def hopeful(self) -> pd.DataFrame:
        """The rows of which some pair may link."""
        some = np.zeros(len(self.rows), dtype=bool)
        for first, second in self.pairs():
            some[first] = some[second] = True
        return self.rows.loc[some, ["tile", "band", "half", "node"]]

    def links(self) -> pd.DataFrame:
        """``node, links, root``: of the rows that link, how many vectors with, and the first row of their part of the forest."""
        units = unit_rows(np.stack(self.rows["vector"].to_list()).astype(float))
        node, n = self.rows["node"].to_numpy(), self.rows["n"].to_numpy()
        firsts, seconds = [np.empty(0, dtype=int)], [np.empty(0, dtype=int)]
        for first, second in self.pairs():
            linked = np.einsum("ij,ij->i", units[first], units[second]) >= self.least
            firsts.append(first[linked])
            seconds.append(second[linked])
        first, second = np.concatenate(firsts), np.concatenate(seconds)
        links = np.bincount(first, weights=n[second], minlength=len(node))
        links += np.bincount(second, weights=n[first], minlength=len(node))
        found = pd.DataFrame({"node": node, "links": links.astype(np.int64), "root": node[_forest(first, second, len(node))]})
        return found[found["links"] > 0]


def _by_tile(rows: DataFrame, least: float, bits: int, judged: Callable[[Tiles], pd.DataFrame], schema: str) -> DataFrame:
    """What ``judged`` says of the rows of every tile, in pieces of whole tiles."""

    def in_tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            held = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            open_tile = held["tile"].to_numpy() == held["tile"].iloc[-1]
            rest = held[open_tile]
            for _, some in held[~open_tile].groupby("length", sort=False):
                yield judged(Tiles(some, least, bits))
        if rest is not None and len(rest):
            yield judged(Tiles(rest, least, bits))

    return rows.repartition("tile").sortWithinPartitions("tile", "band", "node").mapInPandas(in_tiles, schema)


def link_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    least: float = 0.98,
    miss: float = 1e-6,
    seed: int = 11,
) -> DataFrame:
    """``<id_col>, n_links, component_id, kept``: a row per vector with the number of others at a cosine of ``least``."""
    vector = F.col("vector")
    usable = (
        F.col("label").isNotNull()
        & (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(vector, lambda x: x != 0)
    )
    keyed = (
        vectors.select(
            F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label")
        )
        .withColumn("usable", F.coalesce(usable, F.lit(False)))
        .withColumn("key_a", F.when(F.col("usable"), F.xxhash64(F.lit(0), "label", "vector")))
        .withColumn("key_b", F.when(F.col("usable"), F.xxhash64(F.lit(1), "label", "vector")))
    )
    with Scratch(vectors.sparkSession) as scratch:
        classes = scratch.keep(_classes(keyed))
        count, longest = classes.agg(F.count("*"), F.max(F.size("vector"))).first()
        rows = min(MOST_BATCH_ROWS, BATCH_COMPONENTS // (longest or 1) + 1)
        with Scratch(vectors.sparkSession, rows) as batched:
            found = cut(_linked(classes, count, least, miss, seed, batched))
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("id"))
    return keyed.join(found, ["key_a", "key_b"], "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def _classes(keyed: DataFrame) -> DataFrame:
    """``key_a, key_b, n, least_id, vector, kind, node``: a row per distinct usable vector."""
    return (
        keyed.where("usable")
        .groupBy("key_a", "key_b")
        .agg(
            F.count("*").alias("n"),
            F.min("id").alias("least_id"),
            F.first("vector").alias("vector"),
            F.first(F.xxhash64("label", F.size("vector"))).alias("kind"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )


def _linked(classes: DataFrame, count: int, least: float, miss: float, seed: int, scratch: Scratch) -> DataFrame:
    """``key_a, key_b, n_links, component_id`` of each of ``count`` classes."""
    bits, bands = band_plan(count, least, miss)

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for length, rows in batch.groupby(batch["vector"].str.len()):
                units = unit_rows(np.stack(rows["vector"].to_list()).astype(float))
                code, factor = codes_of(units, seed)
                words = words_of(np.unpackbits(code, axis=1)[:, :length])
                planes, low, step = planes_of(units, seed)
                values = bands_of(units, bits, bands, seed)
                yield pd.DataFrame(
                    {
                        "node": rows["node"].to_numpy(),
                        "kind": rows["kind"].to_numpy(),
                        "length": length,
                        "code": [c.tobytes() for c in words],
                        "factor": factor,
                        "planes": [p.tobytes() for p in planes],
                        "low": low,
                        "step": step,
                        "marks": [v.tobytes() for v in values.astype(band_type(bits))],
                        "bands": list(values),
                    }
                )

    schema = (
        "node long, kind long, length int, code binary, factor double, planes binary, low double, step double, "
        "marks binary, bands array<long>"
    )
    codes = scratch.keep(classes.select("node", "kind", "vector").mapInPandas(coded, schema))

    met = codes.select("node", "kind", F.posexplode("bands").alias("band", "value")).select(
        "node", "band", F.xxhash64("kind", "band", "value").alias("bucket")
    )
    buckets = scratch.keep(met.groupBy("bucket").agg(F.count("*").alias("held")).where("held > 1"))
    blocks = F.ceil(F.col("held") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node", "bucket"), F.col("blocks")).cast("int")
    dealt = (
        met.join(buckets, "bucket")
        .withColumn("blocks", blocks)
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "node",
            "band",
            F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")).alias("tile"),
            F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("half"),
        )
    )
    codes = codes.drop("kind", "bands")
    hopeful = scratch.keep(
        _by_tile(dealt.join(codes, "node"), least, bits, Tiles.hopeful, "tile long, band int, half int, node long")
    )
    whole = hopeful.join(codes, "node").join(classes.select("node", "n", "vector"), "node")
    links = scratch.keep(_by_tile(whole, least, bits, Tiles.links, "node long, links long, root long"))

    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    of = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    graph = classes.select("node", "key_a", "key_b", "n", "least_id").join(of, "node", "left")
    graph = scratch.keep(graph.withColumn("component", F.coalesce("component", "node")).join(counts, "node", "left"))
    names = graph.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return graph.join(names, "component").select(
        "key_a", "key_b", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
