"""Mixing of sources to target weights: hash-random order, distributed prefix sums, exact cuts.

Every document gets a random but repeatable key. Within a source, documents are taken in key order, whole
epochs first, until the source's budget of words is met. Keys are uniform, so their first hex digits are
equal ranges, and the sort needs no sampling: one aggregate gives the words of each (source, range), a
running sum over those few rows finds the range in which the budget ends, and only that range is sorted row
by row. The result is one cut per source; applying it to documents needs no shuffle of theirs.

Nulls: a null text has no words; a null source is a source of its own, last in order; null ids are ids.
Repeated rows (same id and text) share a key; if the cut falls on them they share what is left evenly, and
the remainder of that division is not taken. An empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from customer_canon.llm.common import WORD, as_rows, broadcast_if_small, columns_of, cut

#: Hex digits of the key that number the ranges of a source: 16 ** 3 ranges.
RANGE_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix_key(doc_id: Column, text: Column, seed: str) -> Column:
    parts = [F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(F.md5(text), F.lit(""))]
    return F.md5(F.concat_ws(":", *parts))


def source_targets(
    sizes: DataFrame, weights: Sequence[int], share: float, max_epochs: int
) -> DataFrame:
    """One row per source (``source, source_size``) gets its ``target``.

    Targets are proportional to the weights and stop at ``max_epochs`` times the source; the excess goes to
    the others by weight. With sources ordered by what they can give per weight, those that stop come first,
    so two running sums settle all of them at once.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    whole = Window.partitionBy(F.lit(0))
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")
    )
    by_room = Window.orderBy(F.col("most") / F.col("weight"), "place")
    ranked = (
        sizes.withColumn("place", F.row_number().over(in_order) - 1)
        .withColumn("weight", weight)
        .withColumn("most", max_epochs * F.col("source_size"))
        .withColumn("wanted", F.lit(share) * F.sum("source_size").over(whole))
        .withColumn("given", F.coalesce(F.sum("most").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(by_room.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("stops", F.col("most") * F.col("weights") <= (F.col("wanted") - F.col("given")) * F.col("weight"))
        .withColumn("given", F.sum(F.when(F.col("stops"), F.col("most")).otherwise(0)).over(whole))
        .withColumn("weights", F.sum(F.when(~F.col("stops"), F.col("weight")).otherwise(0)).over(whole))
    )
    level = (F.col("wanted") - F.col("given")) * F.col("weight") / F.col("weights")
    target = F.when(F.col("stops"), F.col("most").cast("double")).otherwise(level)
    return ranked.select("source", "source_size", target.alias("target"))


def source_cuts(
    keyed: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    max_epochs: int = 2,
) -> DataFrame:
    """From ``source, key, size`` rows: ``mix_of, source_size, target, epochs, cut_key, cut_words``, by source.

    Documents with a smaller key than ``cut_key`` are taken once more than ``epochs`` times, those with that
    key give ``cut_words`` words more, later ones nothing more.
    """
    ranged = keyed.withColumn("span", F.substring("key", 1, RANGE_DIGITS))
    spans = cut(ranged.groupBy("source", "span").agg(F.sum("size").alias("words")))
    sources = source_targets(
        spans.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, max_epochs
    )
    budget = F.floor("target")
    sources = cut(
        sources.withColumn(
            "epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
        ).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    )
    before = Window.partitionBy("source").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("earlier", F.coalesce(F.sum("words").over(before), F.lit(0)))
    rest = broadcast_if_small(sources.select(F.col("source").alias("of"), "rest"))
    last_span = broadcast_if_small(
        spans.join(rest, F.col("source").eqNullSafe(F.col("of")))
        .where((F.col("earlier") <= F.col("rest")) & (F.col("rest") < F.col("earlier") + F.col("words")))
        .select(F.col("source").alias("of"), F.col("span").alias("in_span"), F.col("rest") - F.col("earlier"))
        .toDF("of", "in_span", "left")
    )
    inside = (
        ranged.join(last_span, F.col("source").eqNullSafe(F.col("of")) & (F.col("span") == F.col("in_span")))
        .groupBy("source", "key", "left")
        .agg(F.sum("size").alias("words"), F.count("*").alias("copies"))
    )
    earlier = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        inside.withColumn("left", F.col("left") - F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        .where((F.col("left") >= 0) & (F.col("left") < F.col("words")))
        .select(
            F.col("source").alias("of"),
            F.col("key").alias("cut_key"),
            F.floor(F.col("left") / F.col("copies")).alias("cut_words"),
        )
    )
    sources = sources.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left").drop("of", "rest")
    return broadcast_if_small(sources.withColumnRenamed("source", "mix_of"))


def words_taken(size: Column, key: Column) -> Column:
    """Words the mix takes of a document, from the columns of its source's cut."""
    more = (
        F.when(key < F.col("cut_key"), size).when(key == F.col("cut_key"), F.col("cut_words")).otherwise(0)
    )
    return (F.col("epochs") * size + more).cast("long")


def keyed_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """``doc_id, source, size, key`` of documents."""
    return docs.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        mix_key(F.col("doc_id"), F.col("text"), seed).alias("key"),
    )


def mix_plan(docs: DataFrame, seed: str = "mix", **rules) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every document (see ``source_cuts`` for the rules)."""
    keyed = cut(keyed_documents(docs, seed))
    cuts = source_cuts(keyed, **rules)
    return keyed.join(cuts, F.col("source").eqNullSafe(F.col("mix_of"))).select(
        "doc_id", "size", "source_size", "target", words_taken(F.col("size"), F.col("key")).alias("taken")
    )


def mixture(docs: DataFrame, seed: str = "mix", **rules) -> DataFrame:
    """The mixed documents themselves: whole repeats, and the first words of those that are cut.

    Keeps the columns of ``docs``; ``n_chars``, if there, is that of the text kept. Documents of which no
    word is taken, among them those without words, are left out.
    """
    cuts = source_cuts(cut(keyed_documents(docs, seed)), **rules)
    rows = as_rows(docs).select("row", "row.doc_id", "row.text", "row.source")
    rows = rows.withColumn("size", word_count(F.col("text"))).withColumn("key", mix_key(F.col("doc_id"), F.col("text"), seed))
    taken = rows.join(cuts, F.col("source").eqNullSafe(F.col("mix_of"))).select(
        "row", "text", "size", words_taken(F.col("size"), F.col("key")).alias("taken")
    )
    whole, rest = F.floor(F.col("taken") / F.col("size")).cast("int"), F.col("taken") % F.col("size")
    each = F.concat(F.array_repeat("size", whole), F.when(rest > 0, F.array(rest)).otherwise(F.array()))
    parts = taken.where("taken > 0").select("row", "text", "size", F.explode(each).alias("words"))
    each_word = F.regexp_extract_all(F.col("text"), F.lit("[\\x20\\x09-\\x0D]*" + WORD), F.lit(0))
    first = F.array_join(F.slice(each_word, F.lit(1), F.col("words").cast("int")), "")
    parts = parts.withColumn("text", F.when(F.col("words") == F.col("size"), F.col("text")).otherwise(first))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return parts.select(*columns_of(docs.columns, **changed))


#: DuckDB's version of ``mix_plan`` with the default rules.
MIX_SQL = r"""
WITH keyed AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(md5(text), '')) AS key
  FROM documents),
sized AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM keyed GROUP BY source),
placed AS (
  SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS place,
         1.5::DOUBLE * sum(source_size) OVER () AS wanted, 2 * source_size AS most FROM sized),
weighed AS (SELECT *, [3, 1, 2][place % 3 + 1] AS weight FROM placed),
-- excess above the limit is reshared until none is above: level by level, at most one round per source
round AS (
  SELECT source, source_size, wanted, most, weight,
         most * sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
           <= (wanted - coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS stops
  FROM weighed),
targets AS (
  SELECT source, source_size,
         CASE WHEN stops THEN CAST(most AS DOUBLE)
              ELSE (wanted - CAST(sum(CASE WHEN stops THEN most ELSE 0 END) OVER () AS DOUBLE)) * weight
                   / CAST(sum(CASE WHEN stops THEN 0 ELSE weight END) OVER () AS DOUBLE) END AS target
  FROM round),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM targets),
groups AS (
  SELECT source, key, CAST(sum(size) AS BIGINT) AS words, count(*) AS copies FROM keyed GROUP BY source, key),
running AS (
  SELECT *, coalesce(CAST(sum(words) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS earlier
  FROM groups)
SELECT k.doc_id, k.size, b.source_size, b.target,
       CAST(b.epochs * k.size + CASE
         WHEN r.earlier + r.words <= CAST(floor(b.target) AS BIGINT) - b.epochs * b.source_size THEN k.size
         WHEN r.earlier <= CAST(floor(b.target) AS BIGINT) - b.epochs * b.source_size
           THEN (CAST(floor(b.target) AS BIGINT) - b.epochs * b.source_size - r.earlier) // r.copies
         ELSE 0 END AS BIGINT) AS taken
FROM keyed k
JOIN running r ON k.source IS NOT DISTINCT FROM r.source AND k.key = r.key
JOIN budgets b ON k.source IS NOT DISTINCT FROM b.source
"""
