"""Collocations by Toivonen's mining: a sample proposes phrases, full passes count them and their negative border.

The sample gives the words and pairs that reach a lowered support there. With them, the phrases proposed and their negative
border are: every word, every pair of two proposed words, and every triple of two proposed pairs. The first full pass counts
all of these by a hash of 64 bits. Such a count is exact unless two phrases share a hash, and never too low, so a phrase below
the support is not frequent. The second one counts what reached it exactly, by its words. Where words or pairs
of the border are among that, the sample has failed: the pass then also counts every pair of frequent words that the first left out,
and every triple with such a pair or with one that was not proposed. A part of a frequent phrase is frequent, so
no phrase can be missing then, and no further pass can find one. The sample decides how much is counted, never the result.

Tasks hold the proposed phrases, and later the hashes that reached the support, as a bit map of 16 MB, whatever the corpus. Two
phrases on one bit let a few more be counted, which changes nothing. Within a task, words become numbers, so that a block of
words is counted by sorting; a phrase leaves a block once, however often it occurs. Hashes travel and are summed as
arrays. The scores come from joins of the frequent phrases with their parts.

Nulls: a null text is empty, a null language is ``und``. Texts without words add nothing. Whole texts are read, of any length;
one longer than a block is a block alone. Repeated rows count each time. Ties of all sort columns cannot be, since a
phrase stands once in a language. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from customer_canon.llm.common import Scratch, cut, shuffle_partitions

#: What ends a piece, A-Z and the tab: lowered, a full stop for all ends, a blank.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_BYTES = bytes(46 if b in _ENDS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Words that are counted at once; and the bits of a word's number in a block, of which it has fewer distinct ones.
BLOCK_WORDS, NUMBER_BITS = 1 << 21, 21
#: Bits of the map of proposed phrases, as a power of 2, and those that are collected as one row.
MAP_BITS, ROW_BITS = 27, 18
#: Rows of a batch that leaves a block.
OUT_ROWS = 200_000
#: Hashes that a task holds before it sums equal ones.
HELD = 1 << 22

_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Numbers(dict):
    """Numbers of one language's words in a block; 0 is the end of a piece."""

    def __init__(self, seed: int, words: list[bytes], hashes: list[int], langs: list, lang):
        super().__init__({b".": 0})
        self.seed, self.words, self.hashes, self.langs, self.lang = seed, words, hashes, langs, lang

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        self.hashes.append(xxhash.xxh3_64_intdigest(word, self.seed))
        self.langs.append(self.lang)
        return number


def _seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode())


def _paired(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The hash of each pair of words, from theirs."""
    x = first * _MIX + second
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have their bit set."""
    at = hashes >> np.uint64(64 - MAP_BITS)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)


def _tripled(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    return _paired(_paired(first, second), third)


def _both(flags: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Where a word and the next one have their flag."""
    flags = flags[of]
    return flags[:-1] & flags[1:]


class _Block:
    """Words of some texts, as numbers."""

    def __init__(self):
        self.words, self.hashes, self.langs = [b"."], [0], [None]
        self.numbers: dict[str, _Numbers] = {}
        self.texts: list[np.ndarray] = []
        self.totals: dict[str, int] = {}
        self.length = 0

    def add(self, lang: str, text: bytes) -> None:
        words = text.translate(_BYTES).replace(b".", b" . ").split()
        words.append(b".")
        if lang not in self.numbers:
            self.numbers[lang] = _Numbers(_seed(lang), self.words, self.hashes, self.langs, lang)
        self.texts.append(np.fromiter(map(self.numbers[lang].__getitem__, words), dtype=np.int32, count=len(words)))
        self.totals[lang] = self.totals.get(lang, 0) + len(words) - words.count(b".")
        self.length += len(words)

    def full(self) -> bool:
        return self.length >= BLOCK_WORDS or len(self.words) >= 1 << (NUMBER_BITS - 1)

    def hashed(self, proposed: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Hashes and counts of all words, of the pairs of proposed words, and of the triples of proposed pairs.

        Where nothing is proposed yet: of all words and pairs.
        """
        of, hashes = np.concatenate(self.texts), np.array(self.hashes, dtype=np.uint64)
        words = np.bincount(of, minlength=len(hashes))
        yield hashes[1:], words[1:]
        pairs = (of[:-1] > 0) & (of[1:] > 0)
        if proposed is not None:
            pairs &= _both(_held(proposed, hashes), of)
        phrases, counts = self._distinct([of[:-1][pairs], of[1:][pairs]])
        yield _paired(*hashes[phrases].T), counts
        if proposed is not None:
            pairs = self._proposed_pairs(of, hashes, proposed)
            triples = pairs[:-1] & pairs[1:]
            phrases, counts = self._distinct([of[k : len(of) - 2 + k][triples] for k in range(3)])
            yield _tripled(*hashes[phrases].T), counts

    @staticmethod
    def _proposed_pairs(of: np.ndarray, hashes: np.ndarray, proposed: np.ndarray) -> np.ndarray:
        """Where a pair of two proposed words is proposed itself."""
        pairs = (of[:-1] > 0) & (of[1:] > 0) & _both(_held(proposed, hashes), of)
        pairs[pairs] = _held(proposed, _paired(hashes[of[:-1][pairs]], hashes[of[1:][pairs]]))
        return pairs

    def counted(self, proposed: np.ndarray, reached: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of the words of phrases, a row for each, and their counts.

        These are the phrases whose hash ``reached`` the support, and those of which it was not counted though their
        parts may be frequent.
        """
        of, hashes = np.concatenate(self.texts), np.array(self.hashes, dtype=np.uint64)
        frequent = _held(reached, hashes)
        words = np.bincount(of, minlength=len(hashes))
        words[0] = 0
        some = np.flatnonzero((words > 0) & frequent)
        yield some[:, None], words[some]
        pairs = (of[:-1] > 0) & (of[1:] > 0) & _both(frequent, of)
        known = _both(_held(proposed, hashes), of) & pairs
        pairs[known] = _held(reached, _paired(hashes[of[:-1][known]], hashes[of[1:][known]]))
        yield self._distinct([of[:-1][pairs], of[1:][pairs]])
        triples = pairs[:-1] & pairs[1:]
        known = self._proposed_pairs(of, hashes, proposed)
        known = known[:-1] & known[1:] & triples
        triples[known] = _held(reached, _tripled(*(hashes[of[k : len(of) - 2 + k][known]] for k in range(3))))
        yield self._distinct([of[k : len(of) - 2 + k][triples] for k in range(3)])

    @staticmethod
    def _distinct(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        keys = np.zeros(len(parts[0]), dtype=np.int64)
        for part in parts:
            keys <<= NUMBER_BITS
            keys |= part
        keys, counts = np.unique(keys, return_counts=True)
        shifts = [NUMBER_BITS * k for k in range(len(parts))][::-1]
        return np.stack([keys >> shift & (1 << NUMBER_BITS) - 1 for shift in shifts], axis=1), counts


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    block = _Block()
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            block.add(lang, text.as_py())
            if block.full():
                yield block
                block = _Block()
    if block.texts:
        yield block


def _summed_arrays(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate([np.empty(0, dtype=np.uint64), *hashes]), np.concatenate([np.empty(0, dtype=np.int64), *counts])
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _reaching(docs: DataFrame, proposed, least: int) -> DataFrame:
    """``hash`` of the phrases that occur ``least`` times, if they have no or only proposed parts."""
    parts = shuffle_partitions(docs)
    buckets = 8 * parts

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            hashes, counts = zip(*block.hashed(proposed.value if proposed else None))
            hashes, counts = np.concatenate(hashes), np.concatenate(counts).astype(np.uint32)
            bucket = (hashes >> np.uint64(32)) % np.uint64(buckets)
            order = np.argsort(bucket)
            hashes, counts, bucket = hashes[order], counts[order], bucket[order]
            held = np.unique(bucket)
            ends = np.searchsorted(bucket, held, side="right")
            starts = np.concatenate([[0], ends[:-1]])
            blobs = [[values[s:e].tobytes() for s, e in zip(starts, ends)] for values in (hashes, counts)]
            names = ["bucket", "hashes", "counts"]
            yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), *map(pa.array, blobs)], names=names)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts, size = [], [], 0
        for batch in batches:
            hashes += [np.frombuffer(b, dtype=np.uint64) for b in batch.column("hashes").to_pylist()]
            counts += [np.frombuffer(b, dtype=np.uint32).astype(np.int64) for b in batch.column("counts").to_pylist()]
            size += sum(map(len, hashes[-batch.num_rows :]))
            if size > HELD:
                hashes, counts = ([x] for x in _summed_arrays(hashes, counts))
                size = 0
        found, total = _summed_arrays(hashes, counts)
        yield pa.RecordBatch.from_arrays([pa.array(found[total >= least].view(np.int64))], names=["hash"])

    dealt = docs.mapInArrow(hashed, "bucket int, hashes binary, counts binary").repartition(parts, "bucket")
    return dealt.mapInArrow(summed, "hash long")


def _counted(docs: DataFrame, proposed, reached) -> DataFrame:
    """``lang, phrase, count`` of what the second pass has to count, a row for each block; a null phrase for all words."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "phrase", "count"]
        for block in _blocks(batches):
            words = pa.array(block.words, type=pa.binary()).cast(pa.string())
            langs = pa.array(block.langs, type=pa.string())
            for phrases, counts in block.counted(proposed.value, reached.value):
                for at in range(0, len(counts), OUT_ROWS):
                    some = phrases[at : at + OUT_ROWS]
                    parts = [words.take(pa.array(column)) for column in some.T]
                    phrase = pc.binary_join_element_wise(*parts, " ") if len(parts) > 1 else parts[0]
                    columns = [langs.take(pa.array(some[:, 0])), phrase, pa.array(counts[at : at + OUT_ROWS])]
                    yield pa.RecordBatch.from_arrays(columns, names=names)
            found = [pa.array(list(block.totals), pa.string()), pa.nulls(len(block.totals), pa.string())]
            yield pa.RecordBatch.from_arrays([*found, pa.array(block.totals.values(), pa.int64())], names=names)

    return docs.mapInArrow(counted, "lang string, phrase string, count long")


def _map_of(hashes: DataFrame) -> np.ndarray:
    """The bit map of the hashes: 512 rows of 32 KB to the driver, however many hashes there are."""
    place = F.shiftrightunsigned("hash", 64 - MAP_BITS)
    rows = hashes.select(F.shiftright(place, ROW_BITS).alias("row"), place.bitwiseAND((1 << ROW_BITS) - 1).alias("bit")).distinct()

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << ROW_BITS, dtype=np.uint8)
        bits[group["bit"].to_numpy()] = 1
        return pd.DataFrame({"row": [group["row"].iloc[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    whole = np.zeros(1 << (MAP_BITS - 3), dtype=np.uint8)
    size = 1 << (ROW_BITS - 3)
    for row, bits in rows.groupBy("row").applyInPandas(packed, "row long, bits binary").toLocalIterator():
        whole[row * size : (row + 1) * size] = np.frombuffer(bits, dtype=np.uint8)
    return whole


def frequent_phrases(docs: DataFrame, support: int, share: float, lang_col: str, text_col: str, scratch: Scratch) -> DataFrame:
    """``lang, phrase, count`` of all words, pairs and triples with ``support``; a null phrase counts all words."""
    broadcast = docs.sparkSession.sparkContext.broadcast
    lang = F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang")
    texts = docs.select(lang, F.coalesce(docs[text_col], F.lit("")).cast("binary").alias("text"))
    expected = share * support
    sample = _reaching(texts.sample(fraction=share, seed=1), None, max(2, int(expected - expected**0.5)))
    proposed = broadcast(_map_of(scratch.keep(sample)))
    reached = broadcast(_map_of(scratch.keep(_reaching(texts, proposed, support))))
    # blocks have combined equal phrases: they are dealt once and summed where they arrive
    dealt = _counted(texts, proposed, reached).repartition(shuffle_partitions(texts), "lang", "phrase")
    counts = dealt.groupBy("lang", "phrase").agg(F.sum("count").alias("count"))
    return scratch.keep(counts.where((F.col("count") >= support) | F.col("phrase").isNull()))


def collocations(
    docs: DataFrame,
    support: int = 10,
    most: int = 2000,
    inside: int = 50,
    share: float = 0.25,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``most`` best phrases of two or three words.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its worst cut, whose score, 1000000 a a / (l r), is the phrase's.
    A pair that stands in a frequent triple with at least ``inside`` percent of its own count is left out. ``share`` of the
    documents are the sample; it has no influence on the result.
    """
    with Scratch(docs.sparkSession) as scratch:
        counts = frequent_phrases(docs, support, share, lang_col, text_col, scratch)
        lengths = counts.where("phrase IS NULL AND count > 0").select("lang", F.col("count").alias("n"))
        words = F.split("phrase", " ")
        sized = counts.where("phrase IS NOT NULL").select("lang", "phrase", F.col("count").alias("a"), words.alias("words"), F.size(words).alias("size"))
        sized = scratch.keep(sized)

        def joined(start: int, length: int):
            return F.array_join(F.slice("words", start, length), " ")

        triples = sized.where("size = 3")
        covered = triples.select("lang", F.explode(F.array(joined(1, 2), joined(2, 2))).alias("phrase"), "a")
        covered = covered.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
        pairs = sized.where("size = 2").join(covered, ["lang", "phrase"], "left")
        pairs = pairs.where(F.lit(100) * F.coalesce("longer", F.lit(0)) < F.lit(inside) * F.col("a")).drop("longer")

        def cut_after(k: int, rows: DataFrame, size: int) -> DataFrame:
            sides = (joined(1, k).alias("first"), joined(k + 1, size - k).alias("rest"))
            return rows.select("lang", "phrase", "a", F.lit(k).alias("k"), *sides)

        cuts = cut_after(1, pairs, 2).unionByName(cut_after(1, triples, 3)).unionByName(cut_after(2, triples, 3))
        parts = sized.where("size < 3").select("lang", "phrase", "a")
        cuts = cuts.join(parts.toDF("lang", "first", "l"), ["lang", "first"]).join(parts.toDF("lang", "rest", "r"), ["lang", "rest"])
        a, left, right = (F.col(c).cast("decimal(19,0)") for c in "alr")
        cuts = cuts.withColumns({"top": F.lit(1_000_000).cast("decimal(7,0)") * a * a, "below": left * right})
        worst = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(F.expr("top div below").alias("score"), "k", "l", "r")).alias("worst"))
        scored = worst.select("lang", "phrase", "a", "worst.l", "worst.r", "worst.score")
        order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
        ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= most)
        return cut(ranked.join(lengths, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


PHRASES_SQL = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
f AS (
  SELECT lang, size, phrase, count(*) AS a FROM (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase FROM (
      SELECT lang, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM pieces, (VALUES (1), (2), (3)) AS sizes (size)))
  GROUP BY ALL),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND a >= 10),
inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, array_to_string(w[k:k + 1], ' ') AS phrase, a FROM c, (VALUES (1), (2)) AS places (k) WHERE size = 3)
  GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r,
         CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
  FROM c JOIN (VALUES (1), (2)) AS places (k) ON k < c.size
  JOIN f AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
  LEFT JOIN inside ON inside.lang = c.lang AND inside.phrase = c.phrase
  WHERE c.size = 3 OR 100 * coalesce(longer, 0) < 50 * c.a
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM cuts JOIN n USING (lang)
QUALIFY rank <= 2000
"""
