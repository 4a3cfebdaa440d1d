"""Quality by weak supervision: rules vote, expectation-maximisation weighs them.

Each rule reads the statistics of a text and votes good, bad or abstains. No label is
used: the accuracies of the rules, for good and for bad documents, and the share of
good documents are estimated from the agreement of the votes of all documents that the
base rules leave open. A document is kept if its posterior probability of being good is
high enough, whatever single rules say.

The estimation needs only how often each pattern of votes occurs: at most 3 to the
number of rules rows, however many documents there are.
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

MIN_WORDS = 10
MAX_REPEATED = 20  # percent of words
KEEP = 0.5
ROUNDS = 100
# Accuracies on good and on bad documents start here and are drawn towards it with the weight of so
# many votes. A rule seldom blames a good document, but knows only one of the ways to be bad.
START_GOOD, START_BAD, WEIGHT = 0.98, 0.3, 20.0

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Votes good where ``good`` holds, else bad where ``bad`` holds, else abstains."""

    name: str
    good: str
    bad: str


RULES = (
    Rule("length", "n_words >= 30", "n_words < 15"),
    Rule("word_length", "word_chars between 3.5 * n_words and 9 * n_words", "word_chars < 3 * n_words or word_chars > 10 * n_words"),
    Rule("symbols_per_word", "n_symbols * 50 < n_words", "n_symbols * 10 > n_words"),
    Rule("symbols_per_character", "n_symbols * 200 < word_chars", "n_symbols * 40 > word_chars"),
    Rule("odd_words", "(n_distinct_words - n_plain_words) * 20 < n_distinct_words", "(n_distinct_words - n_plain_words) * 5 > n_distinct_words"),
    Rule("duplicate_lines", "n_lines >= 3 and n_dup_lines = 0", "n_dup_lines * 10 > n_lines * 3"),
    Rule("repetition", "n_words >= 30 and n_repeat_words * 50 < n_words", "n_repeat_words * 10 > n_words"),
    Rule("capitals", "n_upper * 10 < n_upper + n_lower", "n_upper * 10 > 3 * (n_upper + n_lower)"),
    Rule("shouting", "n_bangs * 100 < n_words", "n_bangs * 10 > n_words"),
    Rule("ended_lines", "n_lines > 0 and n_ended_lines * 10 >= n_lines * 7", "n_ended_lines * 10 < n_lines * 3"),
    Rule("digits", "n_digits * 100 < word_chars", "n_digits * 10 > word_chars"),
)


def stats_column(text: Column) -> Column:
    @F.pandas_udf(", ".join(f"{n} long" for n in NAMES))
    def stats(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics(t) for t in texts], columns=list(NAMES))

    return stats(utf8(text))


def vote_columns(rules=RULES) -> dict[str, Column]:
    return {f"vote_{r.name}": F.when(F.expr(r.good), 1).when(F.expr(r.bad), -1).otherwise(0) for r in rules}


@dataclass
class Weights:
    """Share of good documents; per rule, chance that its vote is right on good and on bad ones."""

    good: float
    on_good: np.ndarray
    on_bad: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        yes, no = votes > 0, votes < 0
        log = lambda p: np.log(np.clip(p, 1e-9, 1 - 1e-9))
        up = log(self.good) + yes @ log(self.on_good) + no @ log(1 - self.on_good)
        down = log(1 - self.good) + yes @ log(1 - self.on_bad) + no @ log(self.on_bad)
        return 1 / (1 + np.exp(np.clip(down - up, -500, 500)))


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> Weights:
    """Expectation-maximisation over vote patterns (rows of -1, 0, 1) and their counts."""
    n = votes.shape[1]
    w = Weights(0.8, np.full(n, START_GOOD), np.full(n, START_BAD))
    yes, no = (votes > 0).astype(float), (votes < 0).astype(float)
    for _ in range(rounds if len(votes) else 0):
        p = w.posterior(votes)
        good, bad = counts * p, counts * (1 - p)
        old = w
        w = Weights(
            float((good.sum() + 1) / (counts.sum() + 2)),
            (good @ yes + START_GOOD * WEIGHT) / (good @ (yes + no) + WEIGHT),
            (bad @ no + START_BAD * WEIGHT) / (bad @ (yes + no) + WEIGHT),
        )
        if max(np.abs(w.on_good - old.on_good).max(), np.abs(w.on_bad - old.on_bad).max()) < 1e-7:
            break
    return w


def posterior_column(w: Weights, names: list[str]) -> Column:
    """Posterior of the votes in the columns ``names``."""
    log_odds = F.lit(float(np.log(w.good) - np.log1p(-w.good)))
    a, b = np.clip(w.on_good, 1e-9, 1 - 1e-9), np.clip(w.on_bad, 1e-9, 1 - 1e-9)
    for name, up, down in zip(names, np.log(a) - np.log(1 - b), np.log(1 - a) - np.log(b)):
        log_odds = log_odds + F.when(F.col(name) > 0, float(up)).when(F.col(name) < 0, float(down)).otherwise(0.0)
    return 1 / (1 + F.exp(-log_odds))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES, keep: float = KEEP) -> DataFrame:
    """One row per document: id, the base statistics, ``base_failed``, ``posterior``, ``kept``.

    A null or empty text has no words: it fails the base rules and is not kept.
    Repeated rows are judged alike and count each. An empty table gives an empty
    result. Other columns are not read.
    """
    stats = docs.select(F.col(id_col).alias("id"), stats_column(F.col(text_col)).alias("s")).select("id", "s.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    stats = stats.select("id", *BASE, failed.alias("base_failed"), *(c.cast("byte").alias(n) for n, c in vote_columns(rules).items()))
    stats = materialize(stats, "quality-votes")
    names = [f"vote_{r.name}" for r in rules]
    patterns = stats.where("not base_failed").groupBy(*names).count().collect()
    votes = np.array([[r[n] for n in names] for r in patterns], float).reshape(-1, len(names))
    w = estimate(votes, np.array([r["count"] for r in patterns], float))
    return stats.select(F.col("id").alias(id_col), *BASE, "base_failed", posterior_column(w, names).alias("posterior")).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep))
