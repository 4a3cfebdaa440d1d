"""Quality classifier: a regularised quadratic discriminant over document statistics.

Counts become logarithms and shares become angles (arc sine of the root), which are
near to normal. Each class has a mean and a covariance, shrunk towards the pooled one
and towards a multiple of the identity. A score is the probability from the difference
of the two Mahalanobis log-densities, through Cholesky factors that are computed once.

Means and covariances come from sums over all training rows: a fixed number of values
per class, whatever the input.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import utf8
from tidemark.llm.textstats import NAMES, statistics
from tidemark.session import materialize

SHRINK_POOLED = 0.2
SHRINK_IDENTITY = 0.02
THRESHOLD = 0.3

FEATURES = (
    "log_words", "word_length", "symbols", "symbol_words", "dup_lines", "repeats", "ended", "distinct", "upper", "digits", "high", "plain", "stops", "bangs", "line_words",
)


def features(stats: np.ndarray) -> np.ndarray:
    """Transformed statistics: one row of ``FEATURES`` per row of ``textstats.NAMES``."""
    s = dict(zip(NAMES, np.asarray(stats, float).reshape(-1, len(NAMES)).T))
    share = lambda a, b: np.arcsin(np.sqrt(np.clip(s[a] / np.maximum(b, 1), 0, 1)))
    words, chars, letters = s["n_words"], s["word_chars"], s["n_upper"] + s["n_lower"]
    return np.column_stack(
        [
            np.log1p(words),
            np.log1p(chars / np.maximum(words, 1)),
            share("n_symbols", chars),
            share("n_symbols", words),
            share("n_dup_lines", s["n_lines"]),
            share("n_repeat_words", words),
            share("n_ended_lines", s["n_lines"]),
            share("n_distinct_words", words),
            share("n_upper", letters),
            share("n_digits", chars),
            share("n_high", s["n_bytes"]),
            share("n_plain_words", s["n_distinct_words"]),
            share("n_stops", words),
            share("n_bangs", words),
            np.log1p(words / np.maximum(s["n_lines"], 1)),
        ]
    )


@dataclass
class Discriminant:
    log_prior: np.ndarray
    means: np.ndarray
    inverse: np.ndarray  # inverse Cholesky factor of each class
    log_scale: np.ndarray  # half the log-determinant of each class

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the second class for each row."""
        log = [
            p - scale - 0.5 * (((x - mean) @ inv.T) ** 2).sum(1)
            for p, mean, inv, scale in zip(self.log_prior, self.means, self.inverse, self.log_scale)
        ]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))


def fit(sums: list[tuple[float, np.ndarray, np.ndarray]], pooled: float = SHRINK_POOLED, identity: float = SHRINK_IDENTITY) -> Discriminant | None:
    """From count, sum and sum of products of each class; None unless both classes occur."""
    counts = np.array([n for n, _, _ in sums])
    if (counts < 1).any():
        return None
    means = np.array([s / n for n, s, _ in sums])
    scatter = np.array([p - n * np.outer(m, m) for (n, _, p), m in zip(sums, means)])
    common = scatter.sum(0) / counts.sum()
    d = len(common)
    inverse, scale = [], []
    for n, own in zip(counts, scatter):
        cov = (1 - pooled) * own / n + pooled * common
        cov = (1 - identity) * cov + identity * max(np.trace(cov) / d, 1e-6) * np.eye(d)
        lower = np.linalg.cholesky(cov)
        inverse.append(np.linalg.inv(lower))
        scale.append(np.log(np.diag(lower)).sum())
    return Discriminant(np.log(counts / counts.sum()), means, np.array(inverse), np.array(scale))


def features_column(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(list(features(np.array([statistics(t) for t in texts], float))) if len(texts) else [], dtype=object)

    return of(utf8(text))


def class_sums(rows: DataFrame) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of products of ``x`` for the labels 0 and 1."""
    d = len(FEATURES)
    ones = F.concat(F.array(F.lit(1.0)), F.col("x"))
    products = F.flatten(F.transform(ones, lambda a: F.transform(ones, lambda b: a * b)))
    cells = rows.select("label", F.posexplode(products).alias("at", "v")).groupBy("label", "at").agg(F.sum("v").alias("v")).collect()
    sums = np.zeros((2, (d + 1) ** 2))
    for r in cells:
        sums[r["label"], r["at"]] = r["v"]
    table = sums.reshape(2, d + 1, d + 1)
    return [(t[0, 0], t[0, 1:], t[1:, 1:]) for t in table]


def score_column(x: Column, model: Discriminant | None) -> Column:
    @F.pandas_udf("double")
    def score(values: pd.Series) -> pd.Series:
        if model is None or not len(values):
            return pd.Series(np.full(len(values), 0.5))
        return pd.Series(model.score(np.array(values.tolist(), float)))

    return score(x)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: id, ``trained`` (the value of ``train``), ``score``, ``predicted``.

    ``train`` is a condition on the id column; only documents that meet it give labels.
    A null text is scored as an empty one. Each labelled pair of rows counts, also if
    ids repeat; labels other than 0 and 1 and null ids count for nothing. If a class
    has no document, every score is 0.5. An empty table gives an empty result. Other
    columns are not read.
    """
    rows = docs.select(F.col(id_col), features_column(F.col(text_col)).alias("x"))
    rows = materialize(rows.select(F.col(id_col).alias("id"), F.coalesce(train, F.lit(False)).alias("trained"), "x"), "quality-features")
    marks = labels.select(F.col(id_col).alias("of"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")
    known = rows.where("trained").join(marks, F.col("id") == F.col("of")).select("label", "x")
    model = fit(class_sums(known))
    scored = rows.withColumn("score", score_column(F.col("x"), model))
    return scored.select(F.col("id").alias(id_col), "trained", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
