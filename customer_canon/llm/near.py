"""Near-duplicate documents by Order MinHash and banded alignment.

A text is the sequence of its five-word shingles, each labelled with how often it came before. One sketch takes the few
shingles that a seeded hash orders first and keeps them in the order of the text; two texts share it if they have
those shingles in common and in the same order, so it follows edits, not just common words. Texts that share one
of many sketches form a bucket.

In a bucket, every text is first compared with the few texts that share most sketches with others: the ones that the
rest were copied from, if any. Small buckets are thereby compared completely. Where the other members of a larger bucket
still belong to several components, all of them are compared across components, in tiles: those apart from the
largest component are dealt to blocks, and so are those of it, and every block of the former meets every block of the bucket
in one tile. So every pair that shares a sketch is judged, unless it is linked already, and a large bucket is spread over
many tasks. Before that, texts leave a bucket that cannot be linked with any other member of it: shingles that no other text of the
undecided buckets holds are counted out, and what is left is too few for a near copy even of the smallest member. A text
with some edits of its own among thousands of copies goes in this way, without a comparison.
Tiles are formed twice. First each text comes with a profile, the numbers of its shingles by their last bits, some
thirty times smaller than the sequence: bin by bin, the smaller numbers of two texts add up to no less than the shingles
that they have in common, so sizes and profiles rule pairs out without loss. The rows that some pair is left of come again with
their sequences. There the numbers of common shingles rule out more, a pair is judged in the first bucket that it shares,
and only links that join components are sent on.

A comparison aligns the two sequences within a band of diagonals: the longest common subsequence of labelled shingles.
Texts are near copies if it holds ``least`` of all shingles of both. The band is as wide as that allows, so it
loses nothing. Equal texts become one class before all this; links of classes make components.

Nulls: a null or empty text, or one of white space, has no shingles and is a component of its own. Texts of fewer than
five words are one shingle. Null ids are ids; a component is named after its smallest id, null if it has none.
Rows with equal ids and texts share their component, and one of them is kept. An empty table gives an empty result.
Other columns are ignored, or kept by ``deduplicated``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from customer_canon.llm.common import Scratch, as_rows, broadcast_if_small, columns_of, cut, releasing, repeated
from customer_canon.llm.components import components

#: Shingles of a sketch and number of sketches. Texts of few shingles get smaller sketches, so that one edit leaves
#: enough of them; texts between the two bounds get both kinds, since they may meet shorter and longer ones.
LONG = (5, 24)
SHORT = (2, 12)
LONG_FROM, SHORT_TO = 32, 40
#: Members of a bucket that all others are compared with first.
HUBS = 3
#: Texts and shingles of a block, on average; a tile holds two blocks. Every text is sent once for each block that it meets.
BLOCK = 1024
BLOCK_SHINGLES = 1 << 19
#: Texts of either side of a tile that are compared at once.
COMPARED = 128
#: Shingles that a task hands on at once.
LISTED = 1 << 18
#: Distinct values that are counted at once.
COUNTED = 4096
#: Rows that leave, of a few bytes each, that are sent to every executor; beyond, texts are shuffled once.
MOST_GONE = 200_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) < 100_000:
            self[word] = value
        return value


def labelled_shingles(text: str | None, words: int, hashes: dict) -> np.ndarray:
    """A 64-bit hash of each shingle and the number of equal ones before it, in text order."""
    parts = (text or "").split()
    if not parts:
        return np.empty(0, dtype=np.uint64)
    each = np.array([hashes[p] for p in parts], dtype=np.uint64)
    span = min(words, len(each))
    shingles = np.zeros(len(each) - span + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for place in range(span):
            shingles = _mixed(shingles * _MIX + each[place : place + len(shingles)])
        order = np.argsort(shingles, kind="stable")
        ranked = shingles[order]
        fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        starts = np.flatnonzero(fresh)
        before = np.arange(len(ranked)) - np.repeat(starts, np.diff(np.append(starts, len(ranked))))
        label = np.empty(len(ranked), dtype=np.uint64)
        label[order] = before.astype(np.uint64)
        return _mixed(shingles + label * _MIX)


def _keys(size: int, count: int) -> np.ndarray:
    return np.random.default_rng([size, count]).integers(1, 1 << 63, size=count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _sketches(shingles: np.ndarray, size: int, keys: np.ndarray) -> np.ndarray:
    """One hash per key: of the ``size`` shingles that the key orders first, in text order."""
    size = min(size, len(shingles))
    with np.errstate(over="ignore"):
        order = (shingles[None, :] ^ (shingles[None, :] >> np.uint64(29))) * keys[:, None]
        if size < len(shingles):
            first = np.sort(np.argpartition(order, size - 1, axis=1)[:, :size], axis=1)
        else:
            first = np.broadcast_to(np.arange(size), (len(keys), size))
        taken = shingles[first]
        sketch = keys.copy()
        for place in range(size):
            sketch = _mixed(sketch * _MIX + taken[:, place])
    return sketch


def order_sketches(shingles: np.ndarray, long_keys: np.ndarray, short_keys: np.ndarray) -> np.ndarray:
    """All sketches of a text, the kinds it gets by its length one after the other."""
    found = [np.empty(0, dtype=np.uint64)]
    if 0 < len(shingles) <= SHORT_TO:
        found.append(_sketches(shingles, SHORT[0], short_keys))
    if len(shingles) >= LONG_FROM:
        found.append(_sketches(shingles, LONG[0], long_keys))
    return np.concatenate(found).view(np.int64)


def profile(shingles: np.ndarray) -> np.ndarray:
    """How many shingles end in each pattern of some last bits, two to four a pattern on average; empty if a byte cannot tell."""
    bins = 1 << max(4, (len(shingles) // 2).bit_length() - 1)
    counts = np.bincount((shingles & np.uint64(bins - 1)).astype(np.int64), minlength=bins)
    return counts.astype(np.uint8) if counts.max() < 256 else np.empty(0, dtype=np.uint8)


def _folded(counts: np.ndarray, bins: int) -> np.ndarray:
    """Rows of counts by fewer of the last bits."""
    return counts if counts.shape[1] == bins else counts.reshape(len(counts), -1, bins).sum(axis=1, dtype=np.uint32)


def most_common(first: list[np.ndarray], second: list[np.ndarray], may: np.ndarray) -> np.ndarray:
    """No less than the shingles that the texts of two profiles have in common, for the pairs that ``may`` marks."""
    most = np.full(may.shape, np.inf)
    bins = [np.array([len(x) for x in side], dtype=int) for side in (first, second)]
    for one in np.unique(bins[0][bins[0] > 0]).tolist():
        rows = np.flatnonzero(bins[0] == one)
        for other in np.unique(bins[1][bins[1] > 0]).tolist():
            columns = np.flatnonzero(bins[1] == other)
            open_pairs = may[np.ix_(rows, columns)]
            if open_pairs.any():
                x = _folded(np.stack([first[i] for i in rows]), min(one, other))
                y = _folded(np.stack([second[j] for j in columns]), min(one, other))
                for row, counts, partners in zip(rows.tolist(), x, open_pairs):
                    most[row, columns[partners]] = np.minimum(counts, y[partners]).sum(axis=1, dtype=np.int64)
    return most


def alignment(first: np.ndarray, second: np.ndarray, least: float) -> float:
    """Share of all labelled shingles of both that one alignment within the band holds; 0 if surely below ``least``."""
    if not len(first) or not len(second):
        return 0.0
    shorter, longer = sorted((len(first), len(second)))
    if shorter < least * longer:
        return 0.0
    order = np.argsort(second)
    place = np.searchsorted(second, first, sorter=order)
    place = order[np.minimum(place, len(second) - 1)]
    both = np.flatnonzero(second[place] == first)
    place = place[both]
    # texts that share ``least`` of all leave at most this many shingles out, so no match is further off
    band = int(shorter * (1 / least - 1)) + 1
    inside = np.abs(both - place) <= band
    place = place[inside]
    total = len(first) + len(second)
    if len(place) < least * (total - len(place)):
        return 0.0
    if len(place) > 1 and not (np.diff(place) > 0).all():
        tails: list[int] = []
        for value in place.tolist():
            spot = bisect_left(tails, value)
            if spot == len(tails):
                tails.append(value)
            else:
                tails[spot] = value
        return len(tails) / (total - len(tails))
    return len(place) / (total - len(place))


def _sketched(classes: DataFrame, words: int) -> DataFrame:
    """``key_a, key_b, id, text`` rows as ``key_a, key_b, id, size, sketches``."""

    def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, long_keys, short_keys = _WordHashes(), _keys(*LONG), _keys(*SHORT)
        for batch in batches:
            shingles = [labelled_shingles(t, words, hashes) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "key_a": batch["key_a"],
                    "key_b": batch["key_b"],
                    "size": [len(s) for s in shingles],
                    "sketches": [order_sketches(s, long_keys, short_keys) for s in shingles],
                }
            )

    return classes.mapInPandas(releasing(sketched), "key_a long, key_b long, size int, sketches array<long>")


def _compared(pairs: DataFrame, sequences: DataFrame, least: float) -> DataFrame:
    """Of the pairs ``a, b`` those that align well enough."""

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            near = [
                alignment(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64), least) >= least
                for x, y in zip(batch["first"], batch["second"])
            ]
            yield batch.loc[near, ["a", "b"]]

    first = sequences.select(F.col("node").alias("a"), F.col("sequence").alias("first"))
    second = sequences.select(F.col("node").alias("b"), F.col("sequence").alias("second"))
    return pairs.join(first, "a").join(second, "b").mapInPandas(releasing(linked), "a long, b long")


def _hubs(members: DataFrame) -> DataFrame:
    """The weightiest members ``bucket, hub, hub_size, held`` of each bucket's ``bucket, held, node, size, weight``."""
    central = Window.partitionBy("bucket").orderBy(F.col("weight").desc(), "node")
    ranked = members.withColumn("rank", F.row_number().over(central)).where(F.col("rank") <= HUBS)
    return ranked.select("bucket", F.col("node").alias("hub"), F.col("size").alias("hub_size"), "held")


def _pairs(members: DataFrame, hubs: DataFrame, least: float) -> DataFrame:
    """Distinct pairs of each bucket's members with its hubs, but for texts whose sizes alone rule a link out."""
    return (
        members.drop("held")
        .join(hubs, "bucket")
        .where("node <> hub")
        .where(F.least("size", "hub_size") >= F.lit(least) * F.greatest("size", "hub_size"))
        .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
        .distinct()
    )


def common_counts(first: list[np.ndarray], second: list[np.ndarray]) -> np.ndarray:
    """How many values each array of ``first`` shares with each one of ``second``; values are distinct in an array."""
    counts = np.zeros((len(first), len(second)))
    if not len(first) or not len(second):
        return counts
    sides = [(np.concatenate(s), np.repeat(np.arange(len(s)), [len(x) for x in s])) for s in (first, second)]
    shared = np.intersect1d(sides[0][0], sides[1][0])
    for at in range(0, len(shared), COUNTED):
        some = shared[at : at + COUNTED]
        holds = []
        for (values, owner), side in zip(sides, (first, second)):
            place = np.minimum(np.searchsorted(some, values), len(some) - 1)
            same = some[place] == values
            held = np.zeros((len(side), len(some)), dtype=np.float32)
            held[owner[same], place[same]] = 1
            holds.append(held)
        counts += holds[0] @ holds[1].T
    return counts


def _sides(half: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and columns of a tile's comparisons, ``COMPARED`` of each at once."""
    first, second = np.flatnonzero(half != 2), np.flatnonzero(half != 1)
    for at in range(0, len(first), COMPARED):
        # in a tile of half 0 both sides are all rows, and a pair stands where its smaller place is the row
        for other in range(at if (half == 0).any() else 0, len(second), COMPARED):
            yield first[at : at + COMPARED], second[other : other + COMPARED]


def _open_pairs(
    bucket: int,
    half: np.ndarray,
    component: np.ndarray,
    size: np.ndarray,
    sketches: list,
    least: float,
    sides: tuple[np.ndarray, np.ndarray],
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and columns of the comparisons of two sides, and which of them size, component and earlier buckets leave open."""
    first, second = sides
    x, y = size[first][:, None], size[second][None, :]
    may = (component[first][:, None] != component[second][None, :]) & (np.minimum(x, y) >= least * np.maximum(x, y))
    if (half == 0).any():
        may &= first[:, None] < second[None, :]
    first, second, may = _narrowed(first, second, may)
    below = [[s[s < bucket] for s in (sketches[i] for i in side)] for side in (first, second)]
    may &= common_counts(*below) == 0
    return _narrowed(first, second, may)


def _narrowed(first: np.ndarray, second: np.ndarray, may: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows, columns = may.any(axis=1), may.any(axis=0)
    return first[rows], second[columns], may[np.ix_(rows, columns)]


def tile_rows(
    bucket: int, half: np.ndarray, component: np.ndarray, size: np.ndarray, sketches: list, profiles: list, least: float
) -> np.ndarray:
    """Which rows of a tile may have a link to another component, by sizes and profiles."""
    rows = np.zeros(len(half), dtype=bool)
    for sides in _sides(half):
        first, second, may = _open_pairs(bucket, half, component, size, sketches, least, sides)
        most = most_common([profiles[i] for i in first], [profiles[i] for i in second], may)
        both = size[first][:, None] + size[second][None, :]
        may &= most * (1 + least) >= least * both
        first, second, _ = _narrowed(first, second, may)
        rows[first] = rows[second] = True
    return rows


def tile_links(
    bucket: int, half: np.ndarray, component: np.ndarray, sequences: list, sketches: list, least: float
) -> list[tuple[int, int]]:
    """Places of the pairs of a tile that link components, as a forest.

    Rows of halves 1 and 2 are compared with each other, in a tile of half 0 all rows. Pairs that share a sketch below
    ``bucket`` are left to that one.
    """
    size = np.array([len(s) for s in sequences], dtype=float)
    root = {c: c for c in component.tolist()}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    links = []
    for sides in _sides(half):
        first, second, may = _open_pairs(bucket, half, component, size, sketches, least, sides)
        common = common_counts([sequences[i] for i in first], [sequences[i] for i in second])
        may &= common >= least * (size[first][:, None] + size[second][None, :] - common)
        for i, j in zip(*(side[places].tolist() for side, places in zip((first, second), np.nonzero(may)))):
            one, other = find(component[i]), find(component[j])
            if one != other and alignment(sequences[i], sequences[j], least) >= least:
                root[one] = other
                links.append((i, j))
    return links


def _alone(sequences: DataFrame) -> DataFrame:
    """``node, alone``: how many shingles of each ``node, sequence`` stand in no other one; nodes without such are left out."""

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length = batch["sequence"].str.len() // 8
            for _, some in batch.groupby(length.cumsum() // LISTED):
                shingles = [np.frombuffer(s, dtype=np.int64) for s in some["sequence"]]
                nodes = np.repeat(some["node"].to_numpy(), [len(s) for s in shingles])
                yield pd.DataFrame({"node": nodes, "shingle": np.concatenate(shingles)})

    # a text's shingles differ from each other, so rows are texts
    shingles = sequences.mapInPandas(releasing(listed), "node long, shingle long")
    once = shingles.groupBy("shingle").agg(F.min("node").alias("node"), F.count("*").alias("texts")).where("texts = 1")
    return once.groupBy("node").agg(F.count("*").alias("alone"))


def _linkable(rest: DataFrame, sequences: DataFrame, least: float, scratch: Scratch) -> DataFrame:
    """Of ``bucket, node, size, component`` the members that may be linked to another component of their bucket.

    A member is left out if it has too few shingles in common with all other texts together to be a near copy of one
    that has the size of the bucket's smallest member, or the smallest size that a near copy of it may have.
    """
    several = rest.groupBy("bucket").agg(
        F.min("component").alias("lowest"), F.max("component").alias("highest"), F.min("size").alias("smallest")
    )
    undecided = scratch.keep(rest.join(several.where("lowest < highest").select("bucket", "smallest"), "bucket"))
    alone = _alone(sequences.select("node", "sequence").join(undecided.select("node").distinct(), "node", "left_semi"))
    held = F.col("size") - F.coalesce("alone", F.lit(0))
    other = F.greatest(F.col("smallest"), F.lit(least) * F.col("size"))
    # half a shingle less, so that no rounding rules out a pair
    fewest = F.lit(least / (1 + least)) * (F.col("size") + other) - 0.5
    return scratch.keep(undecided.join(alone, "node", "left").where(held >= fewest).select(rest.columns))


def _tiles(members: DataFrame, hubs: DataFrame, of: DataFrame, sequences: DataFrame, least: float, scratch: Scratch) -> DataFrame:
    """``bucket, low, high, half, node, component`` of the tiles of all buckets that the hubs left undecided.

    Those are the ones of which members other than hubs belong to several components that may be linked. A bucket's tiles are named by the
    numbers of their blocks; the blocks of its largest component come last, and no two of them meet.
    """
    rest = (
        members.where(F.col("held") > HUBS + 1)
        .join(hubs.where(F.col("held") > HUBS + 1).select("bucket", F.col("hub").alias("node")), ["bucket", "node"], "left_anti")
        .join(of, "node", "left")
        .select("bucket", "node", "size", F.coalesce("component", "node").alias("component"))
    )
    rest = _linkable(scratch.keep(rest), sequences, least, scratch)
    parts = rest.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("size").alias("shingles"))
    most = F.max(F.struct("n", "shingles", "component"))
    mixed = parts.groupBy("bucket").agg(
        most.alias("main"), F.sum("n").alias("n"), F.sum("shingles").alias("shingles"), F.count("*").alias("components")
    )

    def blocks(n: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(n / BLOCK), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")

    main = F.col("main")
    mixed = scratch.keep(
        mixed.where("components > 1").select(
            "bucket",
            main["component"].alias("main"),
            blocks(F.col("n") - main["n"], F.col("shingles") - main["shingles"]).alias("apart_blocks"),
            blocks(main["n"], main["shingles"]).alias("main_blocks"),
        )
    )
    salt = F.xxhash64("node", "bucket")
    apart = F.col("component") != F.col("main")
    block = F.when(apart, F.pmod(salt, "apart_blocks")).otherwise(F.col("apart_blocks") + F.pmod(salt, "main_blocks"))
    last = F.col("apart_blocks") - 1 + F.when(apart, F.col("main_blocks")).otherwise(0)
    return (
        rest.join(mixed, "bucket")
        .withColumn("block", block.cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), last)))
        .select(
            "bucket",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("half"),
            "node",
            "component",
        )
    )


TILE = ["bucket", "low", "high"]


def _by_tile(rows: DataFrame, judged: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """What ``judged`` says of the rows of each tile."""

    def in_tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            held = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            open_tile = (held[TILE] == held[TILE].iloc[-1]).all(axis=1).to_numpy()
            rest = held[open_tile]
            if not open_tile.all():
                yield pd.concat([judged(tile) for _, tile in held[~open_tile].groupby(TILE, sort=False)])
        if rest is not None:
            yield judged(rest)

    return rows.repartition(*TILE).sortWithinPartitions(*TILE).mapInPandas(releasing(in_tiles), schema)


def _tiled(tiles: DataFrame, classes: DataFrame, sequences: DataFrame, least: float, scratch: Scratch) -> DataFrame:
    """The links ``a, b`` between components that the tiles hold."""

    columns = tiles.columns

    def hopeful(tile: pd.DataFrame) -> pd.DataFrame:
        profiles = [np.frombuffer(p, dtype=np.uint8) for p in tile["profile"]]
        half, component, size = (tile[c].to_numpy() for c in ("half", "component", "size"))
        rows = tile_rows(tile["bucket"].iloc[0], half, component, size.astype(float), tile["sketches"].to_list(), profiles, least)
        return tile.loc[rows, columns]

    def linked(tile: pd.DataFrame) -> pd.DataFrame:
        node = tile["node"].to_numpy()
        whole = [np.frombuffer(s, dtype=np.uint64) for s in tile["sequence"]]
        half, component = tile["half"].to_numpy(), tile["component"].to_numpy()
        links = tile_links(tile["bucket"].iloc[0], half, component, whole, tile["sketches"].to_list(), least)
        return pd.DataFrame([(node[i], node[j]) for i, j in links], columns=["a", "b"], dtype="int64")

    def described(rows: DataFrame, *columns: str) -> DataFrame:
        """The texts of some tiles, each joined together once and not for every tile."""
        texts = classes.join(rows.select("node").distinct(), "node", "left_semi").join(sequences, "node")
        return rows.join(texts.select("node", *columns), "node")

    left = scratch.keep(_by_tile(described(tiles, "size", "sketches", "profile"), hopeful, tiles.schema))
    return _by_tile(described(left, "sketches", "sequence"), linked, "a long, b long")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``key_a, key_b, id, text``, with 128 bits that stand for the text."""
    return docs.select(
        F.xxhash64(F.lit(0), F.col(text_col)).alias("key_a"),
        F.xxhash64(F.lit(1), F.col(text_col)).alias("key_b"),
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, least: float = 0.8
) -> DataFrame:
    """``key_a, key_b, least_id, component_id, stays``: each distinct text that has shingles, by hashes of it.

    ``least_id`` is the smallest id with that text, ``component_id`` the smallest one of all texts linked to it,
    directly or not. Of these, one ``stays``: that with the smallest id; texts without ids come last.
    """
    with Scratch(docs.sparkSession) as scratch:
        return cut(_near_duplicates(_keyed(docs.select(id_col, text_col), id_col, text_col), words, least, scratch))


def _near_duplicates(keyed: DataFrame, words: int, least: float, scratch: Scratch) -> DataFrame:
    sketched = _sketched(keyed.select("key_a", "key_b", "text"), words)
    # one row per distinct text: sketches are equal, ids come from the narrow rows
    classes = scratch.keep(
        sketched.where("size > 0")
        .groupBy("key_a", "key_b")
        .agg(F.first("size").alias("size"), F.first("sketches").alias("sketches"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    ids = scratch.keep(keyed.groupBy("key_a", "key_b").agg(F.min("id").alias("least_id")))
    in_buckets = classes.select("node", "size", F.explode("sketches").alias("bucket"))
    shared = scratch.keep(in_buckets.groupBy("bucket").agg(F.count("*").alias("held")).where("held > 1"))
    members = in_buckets.join(shared, "bucket")
    weights = scratch.keep(members.groupBy("node").agg(F.sum("held").alias("weight")))
    members = scratch.keep(members.join(weights, "node").select("bucket", "held", "node", "size", "weight"))

    # sequences of the texts that share a sketch with any other, one row for each
    wanted = classes.join(weights, "node", "left_semi").select("node", "key_a", "key_b")
    wanted = broadcast_if_small(wanted.join(ids, ["key_a", "key_b"]))
    texts = keyed.join(
        wanted,
        (keyed["key_a"] == wanted["key_a"])
        & (keyed["key_b"] == wanted["key_b"])
        & keyed["id"].eqNullSafe(wanted["least_id"]),
    ).select("node", "text")

    def sequenced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _WordHashes()
        for batch in batches:
            whole = [labelled_shingles(t, words, hashes) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "node": batch["node"],
                    "sequence": [s.tobytes() for s in whole],
                    "profile": [profile(s).tobytes() for s in whole],
                }
            )

    schema = "node long, sequence binary, profile binary"
    sequences = scratch.keep(texts.mapInPandas(releasing(sequenced), schema).dropDuplicates(["node"]))

    hubs = scratch.keep(_hubs(members))
    links = scratch.keep(_compared(scratch.keep(_pairs(members, hubs, least)), sequences, least))
    of = components(links)
    found = scratch.keep(_tiled(scratch.keep(_tiles(members, hubs, of, sequences, least, scratch)), classes, sequences, least, scratch))
    if not found.isEmpty():
        of = components(links.unionByName(found))
    graph = classes.select("key_a", "key_b", "node").join(of, "node", "left")
    graph = graph.withColumn("component", F.coalesce("component", "node")).join(ids, ["key_a", "key_b"])
    winner = F.min(F.struct(F.col("least_id").isNull().alias("unnamed"), "least_id", "key_a", "key_b"))
    names = scratch.keep(graph.groupBy("component").agg(winner.alias("first")))
    return graph.join(names, "component").select(
        "key_a",
        "key_b",
        "least_id",
        F.col("first.least_id").alias("component_id"),
        ((F.col("first.key_a") == F.col("key_a")) & (F.col("first.key_b") == F.col("key_b"))).alias("stays"),
    )


def duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``<id_col>, component_id, kept`` for every document; ``kept`` are those that ``deduplicated`` keeps."""
    found = near_duplicates(docs, id_col, text_col, **how).withColumn("found", F.lit(True))
    component = F.when(F.col("found").isNotNull(), F.col("component_id")).otherwise(F.col("id"))
    rows = cut(
        _keyed(docs.select(id_col, text_col), id_col, text_col)
        .drop("text")
        .join(found, ["key_a", "key_b"], "left")
        .select(
            "key_a",
            "key_b",
            "id",
            component.alias("component_id"),
            F.col("found").isNotNull().alias("found"),
            (F.col("found").isNull() | (F.col("stays") & F.col("id").eqNullSafe(F.col("least_id")))).alias("kept"),
        )
    )
    out = [F.col("id").alias(id_col), "component_id", "kept"]
    # rows that stay but stand there several times: all but one of each go
    again = rows.where(F.col("found") & F.col("kept")).groupBy("key_a", "key_b", "id", "component_id").agg(F.count("*").alias("copies"))
    again = broadcast_if_small(again.where("copies > 1"), MOST_GONE)
    if again.isEmpty():
        return rows.select(*out)
    same = [rows[c].eqNullSafe(again[c]) for c in ("key_a", "key_b", "id")]
    once = rows.join(again, same[0] & same[1] & same[2], "left_anti").select(*out)
    return once.unionByName(repeated(again, "copies").withColumn("kept", F.col("copy") == 0).select(*out))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents that stay: one of each group, and all without shingles. Columns stay as they are.

    Of a group it is the one with the smallest id; if that id stands on several equal rows, one of them.
    """
    found = near_duplicates(docs, id_col, text_col, **how)
    rows = (
        _keyed(docs.select(id_col, text_col), id_col, text_col)
        .groupBy("key_a", "key_b", "id")
        .agg(F.count("*").alias("copies"))
        .join(found, ["key_a", "key_b"])
        .withColumn("stays", F.col("stays") & F.col("id").eqNullSafe(F.col("least_id")))
    )
    row = ["near_a", "near_b", "near_id"]
    gone = broadcast_if_small(rows.where(~F.col("stays")).select("key_a", "key_b", "id").toDF(*row), MOST_GONE)
    again = cut(rows.where(F.col("stays") & (F.col("copies") > 1)).select("key_a", "key_b", "id").toDF(*row))

    whole = as_rows(docs)
    text, doc_id = F.col("row").getField(text_col), F.col("row").getField(id_col)
    keys = [F.xxhash64(F.lit(0), text), F.xxhash64(F.lit(1), text), doc_id]
    same = [F.col(name).eqNullSafe(key) for name, key in zip(row, keys)]
    listed = same[0] & same[1] & same[2]
    kept = whole.join(gone, listed, "left_anti")
    if not again.isEmpty():
        repeated = whole.join(again, listed, "left_semi").withColumns({"id": doc_id, "text": text})
        repeated = repeated.dropDuplicates(["id", "text"]).select("row")
        kept = kept.join(again, listed, "left_anti").unionByName(repeated)
    return kept.select(*columns_of(docs.columns))
