"""License scan by diagonal voting.

Every pair of neighbouring words of every text is hashed and joined to the word pairs of the license templates.
A hit votes for the diagonal *place in the text minus place in the template*. A phrase stands in a text where one
diagonal has all its votes. Of long templates, diagonals with enough votes are merged with their neighbours, since
a word more or less shifts the rest of a passage by one; a merged span counts if it is about as long as the template
and holds enough of its word pairs. Votes are counted only where the words themselves agree, not just their hashes.

Each row also sends one pair that no text has and one template answers. So rows without any hit come out of
the same join and aggregate, and repeated rows are counted there; texts are read once and never shuffled. Rows
are told apart by id, length and two hashes of the text.

Nulls: a null text is empty: no words, no labels, score 0. A null id is an id. Rows that repeat come out as often
as they came in. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from customer_canon.llm.common import ascii_lower, broadcast_if_small, cut, repeated

Templates = Sequence[tuple[str, str]] | DataFrame

#: Characters that end a word once A-Z are lowered.
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

#: Phrases and labels of the base result: fixed values.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

#: Passages of public licenses, by which the method adds labels: fixed values.
PASSAGES = (
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    (
        "gpl",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by"
        " the free software foundation",
    ),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    (
        "apache-2.0",
        "unless required by applicable law or agreed to in writing software distributed under the license is"
        " distributed on an as is basis without warranties or conditions of any kind either express or implied",
    ),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction",
    ),
    ("mit", "released under the mit license"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met",
    ),
)

#: Words of one hashed pair; no phrase is shorter.
PAIR = 2


def words_of(text: Column) -> Column:
    """The words of a text as an array; of a null text none."""
    lowered = ascii_lower(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(lowered, NOT_WORD), "")


def _templates(spark: SparkSession, phrases: Templates, passages: Templates) -> DataFrame:
    """``tag, template, t_place, t_first, t_second, exact, label, pairs``: the pairs of all templates, and the answer to the row's own."""
    given = None
    for exact, templates in ((True, phrases), (False, passages)):
        if not isinstance(templates, DataFrame):
            templates = spark.createDataFrame([tuple(t) for t in templates], "label string, text string")
        rows = templates.select(F.lit(exact).alias("exact"), "label", "text")
        given = rows if given is None else given.unionByName(rows)
    words = words_of(F.col("text"))
    # a written table: the number of a template is the same wherever it is read again
    numbered = cut(given.select("exact", "label", words.alias("words")).withColumn("template", F.monotonically_increasing_id()))
    if short := numbered.where(F.size("words") < PAIR).limit(1).collect():
        raise ValueError(f"A template needs {PAIR} words: {short[0].label!r}, {' '.join(short[0].words)!r}")
    following = F.slice("words", 2, 2147483647)
    pairs = numbered.select(
        "template", "exact", "label", (F.size("words") - 1).cast("long").alias("pairs"),
        F.posexplode(F.arrays_zip(F.col("words").alias("first"), following.alias("second"))).alias("t_place", "pair"),
    ).where(F.col("t_place") < F.col("pairs"))
    own = spark.range(1).select(
        F.lit(-1).cast("long").alias("template"), F.lit(True).alias("exact"), F.lit(None).cast("string").alias("label"),
        F.lit(1).cast("long").alias("pairs"), F.lit(-1).alias("t_place"),
        F.struct(F.lit("").alias("first"), F.lit("").alias("second")).alias("pair"),
    )
    return pairs.unionByName(own).select(
        F.xxhash64("pair.first", "pair.second").alias("tag"), "template", "t_place",
        F.col("pair.first").alias("t_first"), F.col("pair.second").alias("t_second"), "exact", "label", "pairs",
    )


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: Templates = PHRASES,
    passages: Templates = PASSAGES,
    neighbours: int = 3,
    share: float = 0.7,
) -> DataFrame:
    """One row per document: what phrases and passages its whole text holds, and where.

    ``<id_col>, n_words, n_base, first_word, last_word, base_labels, labels, score, spans``. ``spans`` are
    ``label, start, words`` of every phrase and passage found. A passage counts with ``share`` of its word pairs;
    diagonals up to ``neighbours`` apart belong together if each alone has a third of the passage or three votes.

    Phrases and passages are ``(label, text)``, as a list or as a DataFrame of these columns, e.g. of whole license texts.
    Their word pairs are sent to every task up to ``MOST_BROADCAST`` of them; beyond, documents' pairs are shuffled to
    them. A template of fewer than two words is a ValueError.
    """
    templates = broadcast_if_small(_templates(docs.sparkSession, phrases, passages))
    text = F.col(text_col)
    row = ["id", "hash_a", "hash_b", "n_words"]
    pairs = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text).alias("hash_a"),
        F.xxhash64(F.lit(1), text).alias("hash_b"),
        words_of(text).alias("words"),
    ).select(
        "id",
        "hash_a",
        "hash_b",
        F.size("words").cast("long").alias("n_words"),
        F.posexplode(
            F.concat(
                F.array(F.struct(F.lit("").alias("first"), F.lit("").alias("second"))),
                F.arrays_zip(F.col("words").alias("first"), F.slice("words", 2, 2147483647).alias("second")),
            )
        ).alias("place", "pair"),
    )
    hits = pairs.withColumn("tag", F.xxhash64("pair.first", "pair.second")).join(templates, "tag")
    agrees = (F.col("pair.first") == F.col("t_first")) & (F.col("pair.second") == F.col("t_second"))

    # one row per document, template and diagonal; the row's own pair has place 0, so words start at 1
    diagonals = (
        hits.groupBy(
            *row, "template", "exact", "label", "pairs", (F.col("place") - 1 - F.col("t_place")).alias("diagonal")
        )
        .agg(
            F.sum(F.when(agrees, 1).otherwise(0)).alias("votes"),
            F.min("place").alias("from"),
            F.max("place").alias("to"),
        )
        .withColumn("votes", F.col("votes").cast("long"))
    )
    same_row = Window.partitionBy(*row)
    diagonals = diagonals.withColumn(
        "copies", F.max(F.when(F.col("template") == -1, F.col("votes"))).over(same_row)
    ).withColumn("votes", (F.col("votes") / F.col("copies")).cast("long"))
    strong = (F.col("template") == -1) | F.when(F.col("exact"), F.col("votes") == F.col("pairs")).otherwise(
        F.col("votes") >= F.least(F.lit(3), F.ceil(F.col("pairs") / 3))
    )
    along = Window.partitionBy(*row, "template").orderBy("diagonal")
    starts = F.col("exact") | F.coalesce(
        F.col("diagonal") - F.lag("diagonal").over(along) > neighbours, F.lit(True)
    )
    spans = (
        diagonals.where(strong)
        .withColumn("starts", starts.cast("int"))
        .withColumn("span", F.sum("starts").over(along))
        .groupBy(*row, "copies", "template", "exact", "label", "pairs", "span")
        .agg(F.sum("votes").alias("votes"), (F.min("from") - 1).alias("start"), F.max("to").alias("end"))
        .withColumn("held", F.least(F.lit(1.0), F.col("votes") / F.col("pairs")))
    )
    fits = (F.col("held") >= share) & (F.col("end") - F.col("start") <= 1.5 * F.col("pairs") + neighbours)
    found = (F.col("template") >= 0) & (F.col("exact") | fits)
    base = found & F.col("exact")
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    scanned = (
        spans.groupBy(*row, "copies")
        .agg(
            F.count(F.when(base, 1)).alias("n_base"),
            F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
            F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
            joined(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
            joined(F.collect_set(F.when(found, F.col("label")))).alias("labels"),
            F.coalesce(F.max(F.when(found, F.col("held"))), F.lit(0.0)).alias("score"),
            F.sort_array(
                F.collect_list(
                    F.when(
                        found,
                        F.struct(
                            F.col("start"), (F.col("end") - F.col("start") + 1).alias("words"), F.col("label")
                        ),
                    )
                )
            ).alias("spans"),
        )
    )
    return repeated(scanned, "copies").select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"
    )
