"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Document statistics are scaled and mapped to cosines of random projections, which approximate a Gaussian
kernel. Every partition of the labelled rows sums its part of the normal equations; the driver adds a bounded
number of such sums, each as large as the square of the number of features, and solves them. Raw scores are
counted in bins of fixed width, and pooling adjacent violators over those bins makes a rising curve from raw score
to the share of good documents.

The labels come from a documented sample (``most`` rows, see ``stats.labelled_ratios``); scoring covers every
text, whole. Inputs of a score are counts of the text only.

Nulls: a null text is an empty one and gets a score like any other; a null id is never learned from. Ties and
repeated rows get equal scores. Without any usable label every score is 0.5. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from customer_canon.llm.common import as_rows, columns_of, cut
from customer_canon.llm.stats import RATIO_NAMES, labelled_ratios, ratio_array

#: Labelled rows learned from at most, random features, parts that sum the equations, bins of raw scores per unit.
MOST_LABELLED = 20_000
FEATURES = 96
PARTS = 16
BINS = 500


@dataclass(frozen=True)
class QualityModel:
    """What scoring needs; ``knots`` and ``levels`` are the calibration curve."""

    centre: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray


def _features(model: QualityModel, ratios: np.ndarray) -> np.ndarray:
    scaled = np.clip((ratios - model.centre) / model.scale, -6, 6)
    waves = np.sqrt(2 / len(model.phases)) * np.cos(scaled @ model.directions + model.phases)
    return np.hstack([waves, np.ones((len(waves), 1))])


def _raw(model: QualityModel, ratios: np.ndarray) -> np.ndarray:
    return np.clip(_features(model, ratios) @ model.weights, -1, 2)


def pooled(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The rising sequence nearest to ``values``, each weighted by its count."""
    blocks: list[list[float]] = []
    for value, count in zip(values, counts):
        blocks.append([value, count, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            (a, m, i), (b, n, j) = blocks[-2:]
            blocks[-2:] = [[(a * m + b * n) / (m + n), m + n, i + j]]
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def fit_quality(
    docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, width: float = 3.0, ridge: float = 1e-2, seed: int = 7
) -> QualityModel:
    """Learns from labelled documents that are not held out; ``width`` is that of the kernel, in scaled units."""
    names = list(RATIO_NAMES)
    sample = cut(labelled_ratios(docs, labels, most))
    sums = sample.agg(
        *[F.avg(n).alias(f"m_{n}") for n in names], *[F.stddev_pop(n).alias(f"s_{n}") for n in names]
    ).first()
    random = np.random.default_rng(seed)
    model = QualityModel(
        centre=np.array([sums[f"m_{n}"] or 0.0 for n in names]),
        scale=np.array([max(sums[f"s_{n}"] or 0.0, 1e-3) for n in names]),
        directions=random.normal(scale=1 / width, size=(len(names), FEATURES)),
        phases=random.uniform(0, 2 * np.pi, FEATURES),
        weights=np.zeros(FEATURES + 1),
        knots=np.array([0.0]),
        levels=np.array([0.5]),
    )

    def equations(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left, right = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
        for part in parts:
            x = _features(model, part[names].to_numpy(float))
            left += x.T @ x
            right += x.T @ part["good"].to_numpy(float)
        yield pd.DataFrame({"left": [left.ravel()], "right": [right]})

    dealt = sample.repartition(PARTS, "doc_id").sortWithinPartitions("doc_id")
    parts = dealt.mapInPandas(equations, "left array<double>, right array<double>").collect()
    left = sum((np.array(p["left"]) for p in parts), np.zeros((FEATURES + 1) ** 2)).reshape(FEATURES + 1, -1)
    right = sum((np.array(p["right"]) for p in parts), np.zeros(FEATURES + 1))
    if not left.any():
        return model
    weights = np.linalg.solve(left + ridge * np.eye(FEATURES + 1), right)
    model = QualityModel(**{**model.__dict__, "weights": weights})

    @F.pandas_udf("int")
    def bin_of(ratios: pd.Series) -> pd.Series:
        return pd.Series(np.floor(_raw(model, np.stack(ratios.to_list())) * BINS).astype(int))

    bins = (
        sample.select(bin_of(F.array(*names)).alias("bin"), "good")
        .groupBy("bin")
        .agg(F.count("*").alias("n"), F.avg("good").alias("good"))
        .orderBy("bin")
        .collect()  # a row for each bin at most
    )
    levels = pooled(np.array([b["good"] for b in bins]), np.array([b["n"] for b in bins], dtype=float))
    knots = (np.array([b["bin"] for b in bins]) + 0.5) / BINS
    return QualityModel(**{**model.__dict__, "knots": knots, "levels": np.clip(levels, 0, 1)})


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1, higher for better texts; a column of that name is replaced."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(np.interp(_raw(model, ratio_array(texts)), model.knots, model.levels))

    return docs.withColumn(into, score(F.col(text_col)))


def good_documents(docs: DataFrame, model: QualityModel, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The documents that score ``least`` or more. Columns stay as they are."""
    rows = as_rows(docs).select("row", F.col("row").getField(text_col).alias("text"))
    return score_quality(rows, model).where(F.col("score") >= least).select(*columns_of(docs.columns))
