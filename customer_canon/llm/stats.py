"""Counts and ratios of a text, and the labelled sample that models of quality learn from."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What ``text_counts`` counts, in order.
COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_unique",
    "n_adjacent",
    "n_upper",
    "n_digits",
    "n_marks",
    "n_lines",
)

_BYTES = np.arange(256)
_BLANK = np.isin(_BYTES, list(b"\x20\x09\x0a\x0b\x0c\x0d"))
_CONTINUES = (_BYTES >= 0x80) & (_BYTES < 0xC0)  # bytes that begin no code point
_SYMBOL = np.isin(_BYTES, list(b"#*$%&|<>"))
_UPPER = (_BYTES >= ord("A")) & (_BYTES <= ord("Z"))
_DIGIT = (_BYTES >= ord("0")) & (_BYTES <= ord("9"))
_MARK = np.isin(_BYTES, list(b"!?.,;:'\"()[]{}-_/\\=+@^~`"))


def _words_in_repeats(codes: np.ndarray, kinds: int) -> int:
    """Words that lie in a window of three words that occurs twice or more."""
    if len(codes) < 4:
        return 0
    _, pairs = np.unique(codes[:-1] * kinds + codes[1:], return_inverse=True)
    _, windows, times = np.unique(pairs[:-1] * kinds + codes[2:], return_inverse=True, return_counts=True)
    repeated = times[windows] > 1
    inside = np.zeros(len(codes), dtype=bool)
    for shift in range(3):
        inside[shift : shift + len(repeated)] |= repeated
    return int(inside.sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """The ``COUNTS`` of a whole text; of a null text all 0."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    numbers: dict[bytes, int] = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    of = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        int(of[~_BLANK & ~_CONTINUES].sum()),
        int(of[_SYMBOL].sum()),
        len(lines) - len(set(lines)),
        _words_in_repeats(codes, len(numbers)),
        len(numbers),
        int((codes[1:] == codes[:-1]).sum()),
        int(of[_UPPER].sum()),
        int(of[_DIGIT].sum()),
        int(of[_MARK].sum()),
        len(lines),
    )


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with one more column ``counts``, a struct of ``COUNTS``."""

    @F.pandas_udf(", ".join(f"{name} long" for name in COUNTS))
    def counts(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_counts(t) for t in texts], columns=list(COUNTS), dtype="int64")

    return docs.withColumn("counts", counts(F.col(text_col)))


#: Ratios that models see, as (name, counted, per); ``log`` ones are of 1 plus the value.
RATIOS = (
    ("words", "n_words", None),
    ("word_length", "word_chars", "n_words"),
    ("symbols", "n_symbols", "word_chars"),
    ("dup_lines", "n_dup_lines", "n_lines"),
    ("repeats", "n_repeat_words", "n_words"),
    ("unique", "n_unique", "n_words"),
    ("adjacent", "n_adjacent", "n_words"),
    ("upper", "n_upper", "word_chars"),
    ("digits", "n_digits", "word_chars"),
    ("marks", "n_marks", "word_chars"),
    ("line_words", "n_words", "n_lines"),
)
RATIO_NAMES = tuple(name for name, _, _ in RATIOS)
LOGS = ("words", "word_length", "line_words")


def ratio_columns(counts: str = "counts") -> dict[str, Column]:
    """Each ratio as an expression over a struct of counts; 0 where there is nothing to divide by."""
    found = {}
    for name, counted, per in RATIOS:
        value = F.col(f"{counts}.{counted}").cast("double")
        if per:
            value = F.when(F.col(f"{counts}.{per}") > 0, value / F.col(f"{counts}.{per}")).otherwise(0.0)
        found[name] = F.log1p(value) if name in LOGS else value
    return found


def ratio_array(texts: pd.Series) -> np.ndarray:
    """The same ratios in numpy, a row for each text."""
    counts = np.array([text_counts(t) for t in texts], dtype=float).reshape(-1, len(COUNTS))
    columns = []
    for name, counted, per in RATIOS:
        value = counts[:, COUNTS.index(counted)]
        if per:
            below = counts[:, COUNTS.index(per)]
            value = np.divide(value, below, out=np.zeros_like(value), where=below > 0)
        columns.append(np.log1p(value) if name in LOGS else value)
    return np.stack(columns, axis=1)


def held_out(doc_id: Column) -> Column:
    """Whether a document is never learned from: one fifth, by its id as text; a null id is an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def labelled_ratios(docs: DataFrame, labels: DataFrame, most: int, label: str = "quality") -> DataFrame:
    """``doc_id, <ratios>, good`` of at most ``most`` labelled documents that are not held out.

    Takes the labelled ids with the smallest hashes, so the sample is random, the same in every run, and small
    enough to broadcast; the documents' texts are not shuffled. Labels of one id are averaged. An id that
    stands for several documents gives one row.
    """
    wanted = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.avg(label).alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    found = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id")  # at most ``most`` rows
    return (
        with_counts(found)
        .groupBy("doc_id", "good")
        .agg(F.min("counts").alias("counts"))
        .select("doc_id", *[c.alias(n) for n, c in ratio_columns().items()], "good")
    )
