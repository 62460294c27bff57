"""Personal data: fixed patterns, and identifiers found from their context by bootstrapping.

The fixed patterns give the seeds. The last two words before a seed are a lexical pattern; every other token with
enough digits is a candidate, and the words before it tie it to patterns too. This graph of patterns and instances
(distinct strings) is scored in rounds: a pattern is trusted as far as its instances are known to be of one kind, an
instance as far as the trusted patterns that it occurs with say so. Candidates in a trusted context that score high
enough are spans of that kind as well. Every step is an aggregate or a join of the graph's distinct edges, so a
frequent pattern or a frequent string is one row wherever it is joined to.

Positions come from splitting a text by a pattern: the lengths of the pieces and of the matches between them add
up to where each match starts, in code points. That and the search for overlaps go by blocks of matches, so that a text of n
matches costs about n times their square root. The words of a context are looked for in the 60 characters before it. The
regular expressions are written so that no text makes
them slow: a run of characters is entered at its start only (or where the last match ended) and never given back.

Nulls: a null text is empty and has no spans; a null id is an id. Repeated rows each get their spans, and count as
one instance for a pattern. An empty table gives an empty result. Other columns are ignored, or kept by ``redacted``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from customer_canon.llm.common import Scratch, as_rows, broadcast_if_small, columns_of, cut

#: Kinds in the order of the result, and what they look like: fixed values, in the form that cannot run long.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for a kind to occur.
_MARKS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
KINDS = tuple(PATTERNS)
#: Columns that tell rows apart.
KEY = ("pii_key_a", "pii_key_b")

#: Tokens with a digit, and further ones right after that begin with a digit.
CANDIDATE = r"(?<!\S)[^\s0-9]*+[0-9]\S*+(?: [(]?[0-9]\S*+)*+"
CANDIDATE_DIGITS = 4
#: Characters before a match that the words of its context are looked for in.
CONTEXT_CHARS = 60


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _is_valid(kind: str, value: Column) -> Column:
    if kind == "ip":

        def small(part: Column) -> Column:
            number = F.ltrim(part, F.lit("0"))
            return (F.length(number) < 3) | ((F.length(number) == 3) & (number <= "255"))

        return F.forall(F.split(value, "\\."), small)
    if kind == "card":
        return F.length(_digits(value)).between(12, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _blocks(items: Column) -> Column:
    """The array cut into arrays, about four times as many as each has elements: growing an array copies it."""

    def cut_up(items: Column) -> Column:
        size = F.greatest(F.lit(32), (F.sqrt(F.size(items)) / 4).cast("int"))
        last = F.floor((F.size(items) - 1) / size).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * size + 1, size))
        return F.when(F.size(items) > 0, blocks).otherwise(F.array())

    return _once(items, cut_up)


def _matches(text: Column, pattern: str) -> Column:
    """Array of ``start, end, value, before`` of all matches; ``before`` is the end of the text before it.

    Places are counted within blocks of matches first, then the blocks are put one after the other.
    """
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("piece"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value")
    )
    none = F.expr("cast(array() as array<struct<start: int, end: int, value: string, before: string>>)")
    begun = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), none.alias("found"))
    ahead = F.expr("cast(array() as array<struct<at: int, tail: string>>)")

    def placed(so_far: Column, part: Column) -> Column:
        start = so_far["at"] + F.length(part["piece"])
        value = F.coalesce(part["value"], F.lit(""))
        end = start + F.length(value)
        before = _tail(F.concat(so_far["tail"], part["piece"]))
        match = F.struct(
            start.alias("start"),
            end.alias("end"),
            part["value"].alias("value"),
            before.alias("before"),
        )
        found = F.when(part["value"].isNull(), so_far["found"]).otherwise(F.concat(so_far["found"], F.array(match)))
        tail = _tail(F.concat(before, value))
        return F.struct(end.alias("at"), tail.alias("tail"), found.alias("found"))

    def begins(so_far: Column, block: Column) -> Column:
        here = F.struct(so_far["at"].alias("at"), so_far["tail"].alias("tail"))
        at, tail = so_far["at"] + block["at"], _tail(F.concat(so_far["tail"], block["tail"]))
        return F.struct(at.alias("at"), tail.alias("tail"), F.concat(so_far["each"], F.array(here)).alias("each"))

    def shifted(block: Column, here: Column) -> Column:
        return F.transform(
            block["found"],
            lambda m: F.struct(
                (m["start"] + here["at"]).alias("start"),
                (m["end"] + here["at"]).alias("end"),
                m["value"].alias("value"),
                _tail(F.concat(here["tail"], m["before"])).alias("before"),
            ),
        )

    def joined(blocks: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), ahead.alias("each"))
        return F.flatten(F.zip_with(blocks, F.aggregate(blocks, start, begins, lambda a: a["each"]), shifted))

    blocks = F.transform(_blocks(pieces), lambda block: F.aggregate(block, begun, placed))
    return _once(blocks, joined)


def _once(value: Column, use) -> Column:
    """``use(value)``, with the value computed once however often it is mentioned."""
    return F.transform(F.array(value), use)[0]


def _tail(text: Column) -> Column:
    return F.substring(text, -CONTEXT_CHARS, CONTEXT_CHARS)


def _context(before: Column) -> Column:
    """The last two words before a match, lowered; null where there are fewer or one may be cut off."""
    words = F.split(F.lower(before), "\\s+")
    # of a full ``before`` the first word may have begun earlier; it is empty if a blank comes first
    words = F.when(F.length(before) >= CONTEXT_CHARS, F.slice(words, 2, CONTEXT_CHARS)).otherwise(words)
    words = F.filter(words, lambda w: w != "")
    return F.when(F.size(words) >= 2, F.concat_ws(" ", F.slice(words, -2, 2)))


def _spans(text: Column, kind: str) -> Column:
    pattern, mark = PATTERNS[kind], _MARKS[kind]
    some = F.regexp_count(text, F.lit(pattern)) > 0
    if mark:
        some = text.contains(mark) & some
    found = F.filter(_matches(text, pattern), lambda m: _is_valid(kind, m["value"]))
    return F.when(some, found).otherwise(F.array())


def _trimmed(match: Column) -> Column:
    value = F.rtrim(match["value"], F.lit(".,;:!?)\"']}"))
    return F.struct(
        match["start"].alias("start"),
        (match["start"] + F.length(value)).alias("end"),
        value.alias("value"),
        match["before"].alias("before"),
    )


def base_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with an array column of matches per kind, and one of ``candidates`` that overlap none of them."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select("*", *[_spans(text, kind).alias(f"pii_{kind}") for kind in KINDS])
    taken = F.concat(*[F.transform(f"pii_{kind}", lambda m: F.struct(m["start"], m["end"])) for kind in KINDS])

    def extent(block: Column) -> Column:
        return F.struct(
            F.array_min(F.transform(block, lambda s: s["start"])).alias("start"),
            F.array_max(F.transform(block, lambda s: s["end"])).alias("end"),
            block.alias("spans"),
        )

    def apart(c: Column, blocks: Column) -> Column:
        def meets(s: Column) -> Column:
            return (s["start"] < c["end"]) & (c["start"] < s["end"])

        return ~F.exists(blocks, lambda block: meets(block) & F.exists(block["spans"], meets))

    def free(blocks: Column) -> Column:
        return F.filter(
            F.transform(_matches(text, CANDIDATE), _trimmed),
            lambda c: (F.length(_digits(c["value"])) >= CANDIDATE_DIGITS) & apart(c, blocks),
        )

    # implied by any candidate: it holds that many digits itself
    has = F.regexp_count(text, F.lit("[0-9]")) >= CANDIDATE_DIGITS
    blocks = _once(F.array_sort(taken), lambda spans: F.transform(_blocks(spans), extent))
    return found.withColumn("pii_candidates", F.when(has, _once(blocks, free)).otherwise(F.array()))


def _mentions(found: DataFrame) -> DataFrame:
    """A row per match or candidate: ``pii_key_a, pii_key_b, kind`` (null for candidates), ``start, end, value, context``."""

    def each(name: str, kind: str | None) -> Column:
        return F.transform(
            f"pii_{name}",
            lambda m: F.struct(
                F.lit(kind).cast("string").alias("kind"),
                m["start"].alias("start"),
                m["end"].alias("end"),
                F.lower(m["value"]).alias("value"),
                _context(m["before"]).alias("context"),
            ),
        )

    matches = F.concat(*[each(kind, kind) for kind in KINDS], each("candidates", None))
    return found.select(*KEY, F.inline(matches))


def discovered(
    mentions: DataFrame, rounds: int = 3, least_seeds: int = 3, pattern_trust: float = 0.6, instance_trust: float = 0.75
) -> DataFrame:
    """``pii_key_a, pii_key_b, kind, start, end`` of the candidates that trusted contexts give away.

    A pattern is trusted if at least ``least_seeds`` distinct instances of one kind occur in it and make up
    ``pattern_trust`` of all; a candidate needs a score of ``instance_trust``.
    """
    with Scratch(mentions.sparkSession) as scratch:
        return cut(_discovered(mentions, rounds, least_seeds, pattern_trust, instance_trust, scratch))


def _discovered(
    mentions: DataFrame, rounds: int, least_seeds: int, pattern_trust: float, instance_trust: float, scratch: Scratch
) -> DataFrame:
    edges = scratch.keep(mentions.where("context IS NOT NULL").groupBy("context", "value").agg(F.max("kind").alias("seed")))
    known = edges.where("seed IS NOT NULL").select("value", F.col("seed").alias("kind")).distinct()
    known = known.withColumn("score", F.lit(1.0))
    totals = edges.groupBy("context").agg(F.count("*").alias("instances"))
    for _ in range(rounds):
        trusted = (
            edges.select("context", "value")
            .join(known, "value")
            .groupBy("context", "kind")
            .agg(F.sum("score").alias("sure"), F.count(F.when(F.col("score") >= instance_trust, 1)).alias("seeds"))
            .where(F.col("seeds") >= least_seeds)
            .join(totals, "context")
            .withColumn("trust", F.col("sure") / F.col("instances"))
            .where(F.col("trust") >= pattern_trust)
            .select("context", "kind", "trust")
        )
        doubt = F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("trust"))))
        scored = (
            edges.where("seed IS NULL")
            .join(trusted, "context")
            .groupBy("value", "kind")
            .agg((1 - F.exp(doubt)).alias("score"))
        )
        seeds = known.where("score = 1.0")
        known = scratch.keep(seeds.unionByName(scored.withColumn("score", F.least("score", F.lit(0.999)))))
    sure = known.where((F.col("score") < 1.0) & (F.col("score") >= instance_trust))
    return (
        mentions.where("kind IS NULL")
        .drop("kind")
        .join(trusted.select("context", "kind"), "context")
        .join(sure.select("value", "kind"), ["value", "kind"])
        .groupBy(*KEY, "start", "end")
        .agg(F.min("kind").alias("kind"))
    )


def _base() -> Column:
    """The matches of all kinds as one array."""

    def entries(kind: str) -> Column:
        return F.transform(f"pii_{kind}", lambda m: _entry(m["start"], m["end"], F.lit(kind)))

    return F.concat(*[entries(kind) for kind in KINDS])


def _more(found: DataFrame, **how) -> DataFrame:
    """``pii_key_a, pii_key_b, more``: what contexts gave away, for the documents that have any."""
    entry = _entry(F.col("start"), F.col("end"), F.col("kind"))
    return discovered(_mentions(found), **how).groupBy(*KEY).agg(F.collect_list(entry).alias("more"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with 128 bits that stand for a row's id and text; equal rows share them."""
    of = [F.col(id_col), F.col(text_col)]
    return docs.withColumns({KEY[0]: F.xxhash64(F.lit(0), *of), KEY[1]: F.xxhash64(F.lit(1), *of)})


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``<id_col>, base, spans`` for every document.

    ``base`` and ``spans`` are arrays of ``start, place, end, kind`` (``place`` orders the kinds), ``spans`` with what
    contexts gave away. Options are those of ``discovered``.
    """
    slim = _keyed(docs.select(id_col, text_col), id_col, text_col)
    found = cut(base_spans(slim, text_col).drop(text_col))
    base = _base()
    return found.join(_more(found, **how), list(KEY), "left").select(
        id_col,
        F.array_sort(base).alias("base"),
        F.array_sort(F.concat(base, F.coalesce("more", F.array()))).alias("spans"),
    )


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with every span in the text replaced by its kind in capitals and brackets.

    Of spans that overlap, the first names the replacement of them all. ``n_chars``, if there, is that of the new text.
    Other columns stay as they are.
    """
    rows = as_rows(docs).select(
        "row", F.col("row").getField(id_col).alias("id"), F.col("row").getField(text_col).alias("text")
    )
    keyed = _keyed(rows, "id", "text")
    slim = cut(base_spans(keyed.drop("row"), "text").drop("text"))
    more = broadcast_if_small(_more(slim, **how))
    spans = F.array_sort(F.concat(_base(), F.coalesce("more", F.array())))
    text = F.col("text")

    def replaced(so_far: Column, span: Column) -> Column:
        fresh = span["start"] >= so_far["at"]
        piece = F.substring(text, so_far["at"] + 1, span["start"] - so_far["at"])
        mark = F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(so_far["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(so_far["out"], piece, mark)).otherwise(so_far["out"]).alias("out"),
        )

    def closed(so_far: Column) -> Column:
        return F.concat(so_far["out"], F.substring(text, so_far["at"] + 1, F.length(text)))

    clean = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), replaced, closed)
    clean = F.when(F.size(spans) > 0, clean).otherwise(text)
    result = base_spans(keyed, "text").join(more, list(KEY), "left").select("row", clean.alias("clean"))
    changed = {text_col: F.col("clean")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("clean").cast(docs.schema["n_chars"].dataType)
    return result.select(*columns_of(docs.columns, **changed))


def _entry(start: Column, end: Column, kind: Column) -> Column:
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)
    return F.struct(start.alias("start"), place.alias("place"), end.alias("end"), kind.alias("kind"))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of spans in their order, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
