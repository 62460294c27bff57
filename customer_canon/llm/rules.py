"""Quality rules: a decision list learned from labelled statistics.

Sequential covering: on two thirds of the labelled rows a conjunction of thresholds grows, by information gain,
until it covers bad documents only; on the last third its end is pruned while that covers bad documents better. It is
kept if it is precise enough, the bad documents it covers are set aside, and the next one grows. The list becomes
ordered Spark ``when`` expressions over the counts of a text, which anyone can read.

The labels come from a documented sample (``most`` rows, see ``stats.labelled_ratios``); the rules judge every
text, whole.

Nulls: a null text has no words and so fails the base rule; a null id is never learned from. Repeated rows get the
same verdict. Without usable labels there are no rules beyond the base. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from customer_canon.llm.common import as_rows, columns_of
from customer_canon.llm.stats import RATIO_NAMES, labelled_ratios, ratio_columns, with_counts

MOST_LABELLED = 20_000
#: Steps of each statistic that thresholds are chosen from.
STEPS = 48


@dataclass(frozen=True)
class Threshold:
    """``name > value``, or ``name <= value``."""

    name: str
    above: bool
    value: float

    def holds(self, rows: np.ndarray) -> np.ndarray:
        column = rows[:, RATIO_NAMES.index(self.name)]
        return column > self.value if self.above else column <= self.value

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.value:.6g}"


Rule = tuple[Threshold, ...]


def _covered(rule: Rule, rows: np.ndarray) -> np.ndarray:
    found = np.ones(len(rows), dtype=bool)
    for threshold in rule:
        found &= threshold.holds(rows)
    return found


def _thresholds(rows: np.ndarray, bad: np.ndarray) -> list[Threshold]:
    """Midpoints between neighbouring quantiles of all rows and of the bad ones."""
    found = []
    for place, name in enumerate(RATIO_NAMES):
        steps = np.linspace(0, 1, STEPS)
        values = np.concatenate([np.quantile(rows[:, place], steps), np.quantile(rows[bad, place], steps)])
        values = np.unique(values)
        for value in (values[1:] + values[:-1]) / 2:
            found += [Threshold(name, True, float(value)), Threshold(name, False, float(value))]
    return found


def _grown(rows: np.ndarray, bad: np.ndarray, longest: int) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(rows), dtype=bool)
    choices = _thresholds(rows, bad)
    holds = np.array([t.holds(rows) for t in choices])
    while len(rule) < longest and (inside & ~bad).any():
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        ps, ns = (holds & inside & bad).sum(axis=1), (holds & inside & ~bad).sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(ps > 0, ps * (np.log2(ps / (ps + ns)) - np.log2(p / (p + n))), -np.inf)
        best = int(np.argmax(gain))
        if gain[best] <= 0:
            break
        rule += (choices[best],)
        inside &= holds[best]
    return rule


def _worth(rule: Rule, rows: np.ndarray, bad: np.ndarray) -> float:
    inside = _covered(rule, rows)
    p, n = (inside & bad).sum(), (inside & ~bad).sum()
    return (p - n) / (p + n) if p + n else -1.0


def learned_list(
    rows: np.ndarray,
    bad: np.ndarray,
    precision: float = 0.97,
    least: int = 3,
    longest: int = 4,
    most: int = 24,
    seed: int = 7,
) -> list[Rule]:
    """The rules, in the order learned, from ratios (a row for each document) and which documents are bad."""
    order = np.random.default_rng(seed).permutation(len(rows))
    rows, bad = rows[order], bad[order]
    pruning = np.arange(len(rows)) % 3 == 2
    left = np.ones(len(rows), dtype=bool)
    found: list[Rule] = []
    while len(found) < most:
        growing = left & ~pruning
        if (growing & bad).sum() < least or not (growing & ~bad).any():
            break
        rule = _grown(rows[growing], bad[growing], longest)
        judged = left & pruning
        ends = range(1, len(rule) + 1)
        rule = max((rule[:n] for n in ends), key=lambda r: (_worth(r, rows[judged], bad[judged]), len(r)), default=())
        inside = left & _covered(rule, rows)
        if not rule or (inside & bad).sum() < least or (inside & bad).sum() < precision * inside.sum():
            break
        found.append(rule)
        left &= ~inside
    return found


def learn_rules(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, **how) -> list[Rule]:
    """The decision list for bad documents, from at most ``most`` labelled ones."""
    sample = labelled_ratios(docs, labels, most).orderBy("doc_id").collect()  # at most ``most`` rows
    if not sample:
        return []
    rows = np.array([[r[n] for n in RATIO_NAMES] for r in sample])
    return learned_list(rows, np.array([r["good"] < 0.5 for r in sample]), **how)


def rule_verdict(rules: list[Rule], counts: str = "counts") -> Column:
    """Whether a document is kept, as ordered conditions over its counts."""
    ratios = ratio_columns(counts)
    verdict = F.when(F.lit(False), F.lit(False))
    for rule in rules:
        condition = F.lit(True)
        for t in rule:
            condition &= ratios[t.name] > t.value if t.above else ratios[t.name] <= t.value
        verdict = verdict.when(condition, F.lit(False))
    return verdict.otherwise(F.lit(True))


def base_failed(counts: str = "counts") -> Column:
    """The fixed rule that comes before the learned ones."""
    words, repeats = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (words < 50) | (100 * repeats > 50 * words)


def good_documents(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """The documents that neither the base rule nor the learned ones reject. Columns stay as they are."""
    rows = as_rows(docs).select("row", F.col("row").getField(text_col).alias("text"))
    return with_counts(rows).where(~base_failed() & rule_verdict(rules)).select(*columns_of(docs.columns))
