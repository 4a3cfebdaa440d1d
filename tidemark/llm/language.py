"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its subwords: letter n-grams inside words,
word ends marked, hashed into a table. Embeddings and softmax are trained by
stochastic gradient descent in numpy on a bounded sample of labelled passages: at most
about ``DOCS_PER_LANGUAGE`` documents of a language, ``PASSAGES`` passages of each,
chosen by hash. A fifth of them is kept for calibration: it sets the temperature of
the softmax and the confidence below which a text is rejected: that which all but a
share ``MAX_REJECTED`` of passages in the learned languages reach, less a margin.

Scoring needs only the product of both tables. Texts are read whole, in slices.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
DOCS_PER_LANGUAGE = 400
PASSAGES = 8
PASSAGE_CHARS = 200
MAX_REJECTED = 0.001
MARGIN = 10.0  # in odds: a text may be much shorter than a passage
BUCKETS = 1 << 16
DIM = 16
ORDERS = (1, 2, 3, 4)
EPOCHS = 4
RATE = 20.0
SLICE = 1 << 18


@functools.cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def subwords(text: str) -> np.ndarray:
    """Bucket of each subword of a text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_letters()[codes], codes, 0).astype(np.uint32)
    codes = np.concatenate(([0], codes, [0])).astype(np.uint32)
    codes = codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    inner, out = codes != 0, []
    for order in ORDERS:
        n = len(codes) - order + 1
        if n < 1:
            break
        valid = inner[:n].copy() if order == 1 else np.ones(n, bool)
        hashed = np.full(n, order, np.uint32)
        for i in range(order):
            hashed = (hashed ^ codes[i : i + n]) * np.uint32(0x9E3779B1)
            hashed ^= hashed >> np.uint32(15)
            if 0 < i < order - 1:
                valid &= inner[i : i + n]
        out.append(hashed[valid] & np.uint32(BUCKETS - 1))
    return np.concatenate(out).astype(np.int64)


def slices(text: str):
    return (text[i : i + SLICE] for i in range(0, len(text), SLICE))


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # bucket by language: embedding times softmax weights
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0

    def logits(self, text: str) -> np.ndarray | None:
        """None if the text has no letter."""
        total, n = np.zeros(len(self.languages)), 0
        for part in slices(text):
            ids = subwords(part)
            total += self.table[ids].sum(0, dtype=np.float64)
            n += len(ids)
        return total / n + self.bias if n else None

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated probability, and whether the text is rejected."""
        logits = self.logits(text) if text and self.languages else None
        if logits is None:
            return UNKNOWN, 0.0, True
        p = softmax(logits / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] < self.least)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(passages: list[tuple[str, str]], seed: int = 7) -> Model:
    """Fits a model to pairs of language and passage; without any it knows no language."""
    languages = sorted({lang for lang, _ in passages})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    rng = np.random.default_rng(seed)
    data = []
    for lang, text in sorted(passages):
        ids, counts = np.unique(subwords(text), return_counts=True)
        if len(ids):
            data.append((ids, (counts / counts.sum()).astype(np.float32), languages.index(lang)))
    rng.shuffle(data)
    held = data[: len(data) // 5]
    fit = data[len(held) :] or data
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out = np.zeros((DIM, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    step, steps = 0, EPOCHS * len(fit)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(fit)):
            ids, weight, label = fit[i]
            rate = RATE * (1 - step / steps)
            x = weight @ emb[ids]
            error = softmax(x @ out + bias)
            error[label] -= 1
            back = out @ error
            out -= 0.05 * rate * np.outer(x, error)
            bias -= 0.001 * rate * error
            emb[ids] -= rate * weight[:, None] * back
            step += 1
    model = Model(languages, emb @ out, bias)
    calibrate(model, held or fit)
    return model


def calibrate(model: Model, held: list[tuple[np.ndarray, np.ndarray, int]]) -> None:
    """Temperature of least log loss, and the confidence that few correct passages miss."""
    logits = np.array([w @ model.table[ids] + model.bias for ids, w, _ in held], np.float64)
    labels = np.array([y for _, _, y in held])
    at = np.arange(len(labels))
    grid = np.geomspace(0.1, 10, 41)
    loss = [-np.log(softmax(logits / t)[at, labels] + 1e-12).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    sure = np.sort(softmax(logits / model.temperature).max(1)[logits.argmax(1) == labels])
    if len(sure):
        least = sure[int(MAX_REJECTED * len(sure))]
        model.least = float(least / (least + MARGIN * (1 - least)))


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = DOCS_PER_LANGUAGE) -> list[tuple[str, str]]:
    """Passages of the labelled rows of ``docs``, chosen by a hash of the row.

    Each language gives about ``per_language`` documents, as its share is set from its
    count, and each document at most ``PASSAGES`` passages. No language is left out: the
    model has ``BUCKETS`` weights for each.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    rows = rows.where("lang is not null and text is not null")
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return []
    share = F.create_map(*(x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, per_language / r["count"])))))
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / (1 << 30)
    chosen = rows.where(draw < F.element_at(share, F.col("lang")))

    def cut(frames):
        for pdf in frames:
            found = []
            for lang, text in zip(pdf["lang"], pdf["text"]):
                starts = np.arange(0, max(1, len(text) - PASSAGE_CHARS // 2), PASSAGE_CHARS)
                if len(starts) > PASSAGES:
                    starts = np.random.default_rng(len(text)).choice(starts, PASSAGES, replace=False)
                found += [(lang, text[s : s + PASSAGE_CHARS]) for s in starts]
            yield pd.DataFrame(found, columns=["lang", "text"])

    return [tuple(r) for r in chosen.select("lang", "text").mapInPandas(cut, "lang string, text string").collect()]


def predict_column(text: Column, model) -> Column:
    """Struct of ``lang``, ``score`` and ``rejected``; ``model`` is a broadcast."""

    @F.pandas_udf("lang string, score double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.value.predict(t) for t in texts], columns=["lang", "score", "rejected"])

    return predict(text)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``lang_pred``, ``score``, ``rejected``.

    A null text and one without a letter are ``und`` with score 0 and rejected, and so
    is any text if no language was learned. Other texts get a learned language and its
    probability; ``rejected`` says that this is below the calibrated limit. Repeated
    rows are judged alike; an empty table gives an empty result. Only id and text are read.
    """
    found = predict_column(F.col("text"), docs.sparkSession.sparkContext.broadcast(model))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select("id", found.alias("p"))
    return rows.select(F.col("id").alias(id_col), F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"), F.col("p.rejected").alias("rejected"))


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents that are not rejected, all columns as they came."""
    found = predict_column(F.col(text_col), docs.sparkSession.sparkContext.broadcast(model))
    return docs.where(~found.getField("rejected"))
