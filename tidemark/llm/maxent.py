"""Language model: hashed maximum entropy with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class, history).

* The ``HEAD`` most frequent words form classes of ``MEMBERS`` by frequency. Any other
  word belongs to one of ``TAILS`` classes by its last two bytes.
* The class factor is a softmax over all classes, the word factor of a head class one
  over its members. Both have a bias and features of the history, hashed into tables
  of weights: the last word, the last two, and skips to the second and, for classes, the
  third last; the last of these has a row per mark.
* Inside a tail class a word has its smoothed share of the class's count, and all
  unseen words together that of a word counted zero times.

Counts come from all training texts. Weights are trained in ``ROUNDS`` rounds, each
over another part of the training documents: tasks sum gradients in numpy, Spark adds
them by table block, and the driver takes one preconditioned step. Everything that is
broadcast or collected is bounded by ``HOT`` and the table sizes. Counts of words beyond
the ``HOT`` most frequent never leave the executors: they join the rare words of a text.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, utf8
from tidemark.session import materialize

HEAD, MEMBERS, TAILS = 512, 32, 32
HEADS = HEAD // MEMBERS
CLASSES = HEADS + TAILS
MARKS = HEAD + CLASSES + 1
HOT = 1 << 18
CLASS_ROWS, WORD_ROWS = 1 << 13, 1 << 12
ROUNDS = 3
RATE, LIMIT, PRIOR = 0.9, 1.5, 2.0
CHUNK = 1 << 13
END = b"\n"  # no word holds it
BLOCK_ROWS = 32


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case, then the end."""
    words = text.lower().split()
    words.append(END)
    return words


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAILS


# The tail classes of all endings: two bytes, or one byte after 256 * 256.
_TAIL = np.array([zlib.crc32(bytes(divmod(i, 256))) % TAILS for i in range(1 << 16)] + [zlib.crc32(bytes([i])) % TAILS for i in range(256)])
_BLANK = np.isin(np.arange(256), list(b"\t\n\x0b\x0c\r "))
_RANDOM = np.random.default_rng(11)
_POWERS = _RANDOM.integers(0, 1 << 63, 1 << 16, np.uint64) | np.uint64(1)
_SLOTS = 1 << 20


@dataclass
class Words:
    """The words of several texts in a row: bytes, where each starts and ends, its 64-bit hash, words of each text."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Words:
        data = b" ".join(texts).lower()
        letters = np.frombuffer(data, np.uint8)
        inside = ~_BLANK[letters]
        edges = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
        starts, ends = edges[::2], edges[1::2]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        counts = np.diff(np.append(np.searchsorted(starts, np.cumsum(sizes) - sizes), len(starts)))
        return cls(data, starts, ends, word_hashes(letters[inside], ends - starts), counts)

    def tail_classes(self) -> np.ndarray:
        letters = np.frombuffer(self.data, np.uint8)
        last = letters[self.ends - 1].astype(np.int64)
        before = letters[np.maximum(self.ends - 2, 0)].astype(np.int64)
        return _TAIL[np.where(self.ends - self.starts > 1, 256 * before + last, (1 << 16) + last)]


def word_hashes(letters: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each word from the letters of all."""
    if not len(lengths):
        return np.zeros(0, np.uint64)
    starts = np.cumsum(lengths) - lengths
    at = np.arange(len(letters)) - np.repeat(starts, lengths)
    terms = (letters.astype(np.uint64) + np.uint64(1)) * _POWERS[at & 0xFFFF]
    h = np.add.reduceat(terms, starts) + lengths.astype(np.uint64)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


@dataclass
class Vocabulary:
    """Counts of the hot words and totals of all; class sizes are for words outside the head."""

    total: int
    distinct: int
    hot: list[bytes]
    counts: np.ndarray
    tail_tokens: np.ndarray
    tail_words: np.ndarray

    def __post_init__(self):
        self._index()
        self.head = min(HEAD, len(self.hot))
        self.heads, self.classes = HEADS, CLASSES
        cls = np.arange(len(self.hot), dtype=np.int32) // MEMBERS
        cls[self.head :] = [self.heads + tail_class(w) for w in self.hot[self.head :]]
        self.cls = cls
        self.log1 = np.log10(self.counts + 1.0)
        self.tail_log = np.log10(self.tail_tokens + self.tail_words + 1.0)
        # The biases are the logarithms of the smoothed counts, the largest moved to 0.
        size = np.bincount(self.cls[: self.head], self.counts[: self.head], self.classes).astype(float)
        size[self.heads :] += self.tail_tokens
        self.class_bias = np.log((size + 1.0) / (size.max() + 1.0)).astype(np.float32)
        counts = np.zeros((self.heads, MEMBERS))
        counts.reshape(-1)[: self.head] = self.counts[: self.head] + 1.0
        with np.errstate(divide="ignore"):
            self.word_bias = np.log(counts / np.maximum(counts.max(1, keepdims=True), 1.0)).astype(np.float32)

    def __getstate__(self):
        return (self.total, self.distinct, self.hot, self.counts, self.tail_tokens, self.tail_words)

    def __setstate__(self, state):
        self.__init__(*state)

    def _index(self):
        """Two tables from hash to id. A word that finds both slots taken by more frequent ones is no hot word here."""
        self.hashes = word_hashes(np.frombuffer(b"".join(self.hot), np.uint8), np.fromiter(map(len, self.hot), np.int64, len(self.hot)))
        self.slots = np.full((2, _SLOTS), -1, np.int32)
        left = np.arange(len(self.hot))[::-1]  # the most frequent come last and stay
        for table, shift in zip(self.slots, (0, 20)):
            slot = ((self.hashes[left] >> np.uint64(shift)) & np.uint64(_SLOTS - 1)).astype(np.int64)
            table[slot] = left
            left = left[table[slot] != left]
        self.end = self.hot.index(END) if END in self.hot else -1

    def ids_of(self, hashes: np.ndarray) -> np.ndarray:
        """Hot id of each word, or -1. Two words are one if their 64-bit hashes are."""
        out = np.full(len(hashes), -1, np.int32)
        if len(self.hot):
            for table, shift in zip(self.slots, (0, 20)):
                ids = table[((hashes >> np.uint64(shift)) & np.uint64(_SLOTS - 1)).astype(np.int64)]
                np.copyto(out, ids, where=(ids >= 0) & (self.hashes[ids] == hashes))
        return out

    def encode(self, texts: list[bytes]) -> Tokens:
        """Tokens of several texts in a row, an end after each."""
        words = Words.of(texts)
        sizes = words.counts + 1
        ends = np.cumsum(sizes) - 1
        ids, cls = (np.empty(int(sizes.sum()), np.int32) for _ in range(2))
        here = np.arange(len(words.starts)) + np.repeat(np.arange(len(texts)), words.counts)
        ids[here], ids[ends] = self.ids_of(words.hashes), self.end
        cls[here], cls[ends] = self.heads + words.tail_classes(), self.heads + tail_class(END)
        head = np.flatnonzero((ids >= 0) & (ids < self.head))
        cls[head] = ids[head] // MEMBERS
        # A word outside the head acts in histories through its class; before a text stands a mark of its own.
        marks = HEAD + cls
        marks[head] = ids[head]
        starts = ends - words.counts
        at = np.arange(len(ids)) + 3 * np.repeat(np.arange(1, len(texts) + 1), sizes)
        padded = np.full(len(ids) + 3 * len(texts), MARKS - 1, np.int32)
        padded[at] = marks
        return Tokens(words, here, ids, cls, (padded[at - 1], padded[at - 2]), padded[at - 3], starts, sizes)


@dataclass
class Tokens:
    """Tokens of texts in a row: their words and where those stand, hot id (or -1), class, last two marks of the
    history and the third last, where texts start and their sizes."""

    words: Words
    here: np.ndarray
    ids: np.ndarray
    cls: np.ndarray
    history: tuple[np.ndarray, np.ndarray]
    third: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray


def gathered(texts: pd.Series, most: int = 8 * CHUNK):
    """Lists of texts with about ``most`` bytes together; a longer text is alone in its list."""
    texts = texts.tolist()
    for start, stop in batches(texts, most):
        yield texts[start:stop]


@dataclass
class Weights:
    class_table: np.ndarray = field(default_factory=lambda: np.zeros((CLASS_ROWS, CLASSES), np.float32))
    word_table: np.ndarray = field(default_factory=lambda: np.zeros((WORD_ROWS, MEMBERS), np.float32))
    skip_table: np.ndarray = field(default_factory=lambda: np.zeros((MARKS, CLASSES), np.float32))

    def __getstate__(self):
        return self.class_table, self.word_table, self.skip_table

    def __setstate__(self, state):
        self.class_table, self.word_table, self.skip_table = state

    def class_logs(self, bias: np.ndarray) -> np.ndarray:
        """Log-probabilities of the classes after each pair of marks, without the third last: worked out once."""
        if "_logs" not in self.__dict__:
            logs = np.empty((MARKS * MARKS, CLASSES), np.float32)
            for s in range(0, len(logs), 4 * CHUNK):
                z = exponents(bias, self.class_table, class_rows(*(h[s : s + 4 * CHUNK] for h in PAIRS)))
                z -= np.log(np.exp(z) @ np.ones(CLASSES, z.dtype))[:, None]
                logs[s : s + len(z)] = z
            self._logs = logs
        return self._logs


PAIRS = tuple(x.reshape(-1) for x in np.meshgrid(np.arange(MARKS, dtype=np.int32), np.arange(MARKS, dtype=np.int32), indexing="ij"))


# Tables of random numbers: the hash of a feature is the exclusive-or of its parts' numbers.
_MARK_ROWS = _RANDOM.integers(0, CLASS_ROWS, (4, MARKS)).astype(np.uint16)
_MARK_WORD_ROWS = _RANDOM.integers(0, WORD_ROWS, (2, MARKS)).astype(np.uint16)
_CLASS_WORD_ROWS = _RANDOM.integers(0, WORD_ROWS, (2, CLASSES)).astype(np.uint16)


def class_rows(h1, h2) -> list[np.ndarray]:
    """Rows of the features last word, last two words and second last word."""
    one, two, back, second = _MARK_ROWS
    return [one[h1], two[h1] ^ back[h2], second[h2]]


def word_rows(cls, h1, h2) -> list[np.ndarray]:
    """Rows of the features class with last word, and class with second last word."""
    return [c[cls] ^ m[h] for c, m, h in zip(_CLASS_WORD_ROWS, _MARK_WORD_ROWS, (h1, h2))]


def exponents(bias: np.ndarray, table: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """Bias and weights of the features added up. Biases are at most 0 and weights bounded, so exp() is safe."""
    z = np.take(table, rows[0], axis=0)
    z += bias
    for r in rows[1:]:
        z += np.take(table, r, axis=0)
    return z


def pairs_of(t: Tokens) -> np.ndarray:
    """Number of the pair of marks before each token, in the order of ``PAIRS``."""
    return t.history[0].astype(np.int64) * MARKS + t.history[1]


def class_chunks(vocabulary: Vocabulary, t: Tokens, weights: Weights):
    """Slices of the tokens with their pairs of marks and the exponents of all classes."""
    logs, pairs = weights.class_logs(vocabulary.class_bias), pairs_of(t)
    for s in range(0, len(t.ids), CHUNK):
        at = slice(s, s + CHUNK)
        z = np.take(logs, pairs[at], axis=0)
        z += np.take(weights.skip_table, t.third[at], axis=0)
        yield at, pairs[at], z


def chunks(vocabulary: Vocabulary, t: Tokens, weights: Weights):
    """Places of the head words, a chunk at a time, with their members, rows of features and exponents of all members."""
    heads = np.flatnonzero((t.ids >= 0) & (t.ids < vocabulary.head))
    for s in range(0, len(heads), CHUNK):
        at = heads[s : s + CHUNK]
        c = t.cls[at]
        rows = word_rows(c, t.history[0][at], t.history[1][at])
        yield at, t.ids[at] % MEMBERS, rows, exponents(vocabulary.word_bias[c], weights.word_table, rows)


def log_share(z: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log-probability of the target of each row; takes ``z`` over."""
    own = z[np.arange(len(z)), target]
    return own - np.log(np.exp(z, out=z) @ np.ones(z.shape[1], z.dtype))


def shares(z: np.ndarray) -> np.ndarray:
    """Probabilities; takes ``z`` over."""
    np.exp(z, out=z)
    z /= (z @ np.ones(z.shape[1], z.dtype))[:, None]
    return z


class Gradient:
    """Observed and expected counts of the tables; the gradient is their difference.

    Expected counts of classes are summed by pair of marks first; ``finish`` brings them
    to the rows of the features of that pair.
    """

    def __init__(self):
        w = Weights()
        self.tables = [(np.zeros_like(t), np.zeros_like(t)) for t in (w.class_table, w.word_table, w.skip_table)]
        self.pairs = np.zeros(MARKS * MARKS * CLASSES, np.float32)

    def learn(self, vocabulary: Vocabulary, texts: list[bytes], weights: Weights) -> None:
        t, one = vocabulary.encode(texts), np.float32(1)
        seen, skips, skips_expected = self.tables[0][0].reshape(-1), *(x.reshape(-1) for x in self.tables[2])
        for r in class_rows(*t.history):
            np.add.at(seen, r.astype(np.int64) * CLASSES + t.cls, one)
        np.add.at(skips, t.third.astype(np.int64) * CLASSES + t.cls, one)
        for at, pairs, z in class_chunks(vocabulary, t, weights):
            p = shares(z).reshape(-1)
            for sums, first in ((self.pairs, pairs), (skips_expected, t.third[at].astype(np.int64))):
                np.add.at(sums, (first[:, None] * CLASSES + np.arange(CLASSES)).reshape(-1), p)
        observed, expected = (x.reshape(-1) for x in self.tables[1])
        for _, member, rows, z in chunks(vocabulary, t, weights):
            p = shares(z).reshape(-1)
            for r in rows:
                first = r.astype(np.int64) * MEMBERS
                np.add.at(expected, (first[:, None] + np.arange(MEMBERS)).reshape(-1), p)
                np.add.at(observed, first + member, one)

    def finish(self, vocabulary: Vocabulary, weights: Weights) -> None:
        """Bring the expected counts of pairs to the rows of their features."""
        counts = self.pairs.reshape(-1, CLASSES)
        met = np.flatnonzero(counts.any(1))
        for r in class_rows(*(h[met] for h in PAIRS)):
            np.add.at(self.tables[0][1], r, counts[met])

    def blocks(self):
        """Rows of which table, block number and both sums; blocks without a trace are left out."""
        for which, (observed, expected) in enumerate(self.tables):
            for b in range(0, len(observed), BLOCK_ROWS):
                o, e = (t[b : b + BLOCK_ROWS] for t in (observed, expected))
                if e.any():
                    yield which, b, (o - e).tobytes(), e.tobytes()


_BLOCKS = "which int, block int, diff binary, expected binary"


def gradients(rows: DataFrame, vocabulary, weights) -> DataFrame:
    """Sum of the gradients over the texts in ``body``, by table block.

    There are as many tasks as the cluster has cores, so that what they send is bounded
    by the cluster and not by the data; the sum runs block by block.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism

    def learn(frames):
        g = Gradient()
        for pdf in frames:
            for texts in gathered(pdf["body"]):
                g.learn(vocabulary.value, texts, weights.value)
        g.finish(vocabulary.value, weights.value)
        yield pd.DataFrame(g.blocks(), columns=["which", "block", "diff", "expected"])

    def add(frames):
        sums: dict = {}
        for pdf in frames:
            for which, block, diff, expected in pdf.itertuples(index=False):
                d, e = (np.frombuffer(x, np.float32) for x in (diff, expected))
                old = sums.get((which, block), (0, 0))
                sums[which, block] = (old[0] + d, old[1] + e)
        yield pd.DataFrame([(w, b, d.tobytes(), e.tobytes()) for (w, b), (d, e) in sums.items()], columns=["which", "block", "diff", "expected"])

    return rows.coalesce(cores).mapInPandas(learn, _BLOCKS).repartition(cores, "which", "block").mapInPandas(add, _BLOCKS)


def step(weights: Weights, blocks: list, rate: float = RATE) -> Weights:
    """One ascent step, each weight scaled by its expected count."""
    tables = [weights.class_table.copy(), weights.word_table.copy(), weights.skip_table.copy()]
    for r in blocks:
        t = tables[r["which"]]
        diff, expected = (np.frombuffer(r[c], np.float32).reshape(-1, t.shape[1]) for c in ("diff", "expected"))
        t[r["block"] : r["block"] + len(diff)] += rate / 2 * np.clip(diff / (expected + PRIOR), -LIMIT, LIMIT)
    return Weights(*tables)


def count_words(bodies: DataFrame) -> DataFrame:
    """``word``, ``class`` if outside the head, ``n``: summed in each batch before the shuffle."""

    def count(frames):
        for pdf in frames:
            c: Counter = Counter()
            for text in pdf["body"]:
                c.update(words_of(text))
            yield pd.DataFrame({"word": list(c), "class": [tail_class(w) for w in c], "n": list(c.values())})

    return bodies.mapInPandas(count, "word binary, class int, n long").groupBy("word").agg(F.first("class").alias("class"), F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The most frequent words, at most ``most``: those above a count limit.

    The limit comes from a histogram in sixteenths of powers of two, a thousand rows at
    most, so that no task or driver ranks more than it returns.
    """
    level = F.floor(F.log2("n") * 16)
    above, limit = 0, 0
    for r in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        above += r["count"]
        if above > most:
            limit = r["level"] + 1
            break
    return counts.where(level >= limit)


def vocabulary_of(counts: DataFrame) -> Vocabulary:
    total = counts.agg(F.sum("n"), F.count("*")).first()
    found = frequent(counts, HOT).toArrow()
    hot = sorted(zip((-n for n in found["n"].to_pylist()), found["word"].to_pylist(), found["class"].to_pylist()))
    del found
    tokens, words = np.zeros(TAILS), np.zeros(TAILS)
    for r in counts.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        tokens[r["class"]], words[r["class"]] = r["n"], r["v"]
    for n, _, cls in hot[:HEAD]:
        tokens[cls] += n
        words[cls] -= 1
    return Vocabulary(int(total[0] or 0), total[1], [w for _, w, _ in hot], np.array([-n for n, _, _ in hot], float), tokens, words)


def train(rows: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, Vocabulary, Weights]:
    """Counts, vocabulary and weights from the texts in ``body``; ``part`` deals them to rounds."""
    sc = rows.sparkSession.sparkContext
    counts = materialize(count_words(rows.select("body")), "word-counts")
    vocabulary = vocabulary_of(counts)
    shared, weights = sc.broadcast(vocabulary), Weights()
    for i in range(rounds if vocabulary.total else 0):
        sent = sc.broadcast(weights)
        blocks = gradients(rows.where(F.col("part") % rounds == i).select("body"), shared, sent).collect()
        weights = step(weights, blocks)
        sent.destroy()
    return counts, vocabulary, weights


def score_texts(vocabulary: Vocabulary, weights: Weights, texts: list[bytes]) -> list[tuple]:
    """Of each text: tokens, hot tokens, sum of log10(count + 1) of those, the rest of the score, rare words and how often."""
    t = vocabulary.encode(texts)
    log = np.empty(len(t.ids))
    for at, _, z in class_chunks(vocabulary, t, weights):
        log[at] = log_share(z, t.cls[at])
    for at, member, _, z in chunks(vocabulary, t, weights):
        log[at] += log_share(z, member)
    log /= np.log(10)
    known = t.ids >= 0
    base = np.where(known, vocabulary.log1[t.ids], 0.0) if len(vocabulary.hot) else np.zeros(len(t.ids))
    tail = np.flatnonzero(~known | (t.ids >= vocabulary.head))
    log[tail] += base[tail] - vocabulary.tail_log[t.cls[tail] - vocabulary.heads]
    hot, bases, logs = (np.add.reduceat(x, t.starts) for x in (known.astype(np.int64), base, log))
    rare = np.flatnonzero(t.ids[t.here] < 0)
    cuts = np.searchsorted(rare, np.append(0, np.cumsum(t.words.counts)))
    spans = [t.words.data[s:e] for s, e in zip(t.words.starts[rare].tolist(), t.words.ends[rare].tolist())]
    rows = []
    for i, size in enumerate(t.sizes.tolist()):
        c = Counter(spans[cuts[i] : cuts[i + 1]])
        if vocabulary.end < 0:
            c[END] += 1
        rows.append((size, int(hot[i]), float(bases[i]), float(logs[i]), list(c), list(c.values())))
    return rows


_SCORED = "n long, hot long, base double, log double, rare array<binary>, times array<long>"


def score(docs: DataFrame, train_on: Column, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per document: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    ``train_on`` is a condition on the id column: the texts to learn from. ``score`` is
    the model's log10 probability of the text and its end, ``base_score`` that of the
    smoothed word counts. A null text is an empty one, which has the end only. Repeated
    rows count each. Without training texts every word is unseen. An empty table gives
    an empty result. Other columns are not read.
    """
    wanted = F.coalesce(train_on, F.lit(False))
    rows = docs.select(F.col(id_col), F.col(text_col).alias("t")).select(
        F.col(id_col).alias("id"), utf8(F.col("t")).alias("body"), wanted.alias("train"), F.pmod(F.xxhash64(id_col, F.lit("round")), F.lit(1 << 20)).alias("part")
    )
    counts, vocabulary, weights = train(rows.where("train").select("body", "part"), rounds)
    sc = docs.sparkSession.sparkContext
    shared, sent = sc.broadcast(vocabulary), sc.broadcast(weights)

    @F.pandas_udf(_SCORED)
    def scored(texts: pd.Series) -> pd.DataFrame:
        found = [row for held in gathered(texts) for row in score_texts(shared.value, sent.value, held)]
        return pd.DataFrame(found, columns=[x.split()[0] for x in _SCORED.split(", ")])

    found = rows.select("id", "train", F.monotonically_increasing_id().alias("row"), scored("body").alias("s")).select("id", "train", "row", "s.*")
    found = materialize(found, "scores")
    rare = found.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.times").alias("times"))
    seen = rare.join(counts.select("word", F.col("n").alias("count")), "word")
    seen = seen.groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("count") + 1.0)).alias("logs"))
    out = found.drop("rare", "times").join(seen, "row", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    space = float(np.log10(vocabulary.total + vocabulary.distinct + 1))
    return out.select(
        F.col("id").alias(id_col),
        (~F.col("train")).alias("held_out"),
        F.col("n").alias("n_tokens"),
        (F.col("hot") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n") * space).alias("base_score"),
        (F.col("log") + logs).alias("score"),
    )
