"""Quality classifier: an additive model with pairwise interactions.

Every feature has a lookup table over its quantile bins, every chosen pair of features one over coarse bins
of both. Boosting goes round the features in turn: each turn fits a tree of at most three leaves to the
gradient of the log loss along that feature's bins and adds it, shrunken, to the feature's table. Then the pairs
whose four-leaf trees reduce the remaining gradient most are boosted likewise. A score is the sum of
looked-up values, through the logistic function.

Features are counted by Spark over whole texts. The tables are fitted on at most ``MAX_ROWS`` labelled rows,
the least by a hash of id and text; scoring sees every document where it is read, without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import small_batches, table
from emberlog.llm.outliers import kept_bytes, text_counts

#: Bound on the labelled rows that a model is fitted on.
MAX_ROWS = 20_000
BINS = 32
COARSE = 8
ROUNDS = 150
PAIR_ROUNDS = 60
PAIRS = 6
RATE = 0.15
RIDGE = 2.0
#: Rows a leaf holds at least.
LEAF = 5

FEATURES = (
    "log_words", "word_length", "symbols", "signs", "upper", "digits", "repeats", "dup_lines",
    "top_word", "distinct", "bars", "bangs", "line_words",
)
NOT_BAR = bytes(c for c in range(256) if c != ord("|"))
NOT_BANG = bytes(c for c in range(256) if c != ord("!"))


def text_features(text: str | None) -> list[float]:
    """``FEATURES`` of a whole text; shares are of words, lines or characters. Null counts as empty."""
    n_words, chars, symbols, dup_lines, repeats, letters, upper, digits = text_counts(text)
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = Counter(raw.split())
    n, c = max(1, n_words), max(1, chars)
    lines = raw.count(b"\n") + 1
    return [
        np.log1p(n_words), chars / n, symbols / c, max(0, chars - letters - digits) / c, upper / c, digits / c,
        repeats / n, dup_lines / lines, max(words.values(), default=0) / n, len(words) / n,
        kept_bytes(raw, NOT_BAR) / n, kept_bytes(raw, NOT_BANG) / n, np.log1p(n_words / lines),
    ]


def feature_column(text: Column) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([text_features(t) for t in batch], dtype=object)

    return F.pandas_udf(run, "array<double>")(text)


def best_tree(grad: np.ndarray, hess: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Newton values per bin of the best tree of up to three leaves over ordered bins."""
    g, h, c = (np.concatenate([[0.0], np.cumsum(x)]) for x in (grad, hess, count))
    n = len(grad)
    gain = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + RIDGE)
    i, j = np.triu_indices(n + 1, 0)  # leaves [0, i), [i, j), [j, n); an empty one is no leaf
    full = lambda a, b: (a == b) | (c[b] - c[a] >= LEAF)
    fine = full(0, i) & full(i, j) & full(j, n)
    total = np.where(fine, gain(0, i) + gain(i, j) + gain(j, n), -1.0)
    k = int(np.argmax(total))
    values = np.zeros(n)
    for a, b in ((0, i[k]), (i[k], j[k]), (j[k], n)):
        if b > a:
            values[a:b] = -(g[b] - g[a]) / (h[b] - h[a] + RIDGE)
    return values


def best_pair_tree(grad: np.ndarray, hess: np.ndarray) -> tuple[np.ndarray, float]:
    """Values and gain of the best four-leaf tree: one cut of the first feature, one of the second."""
    g, h = (np.pad(x, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for x in (grad, hess))
    a, b = np.meshgrid(np.arange(1, grad.shape[0]), np.arange(1, grad.shape[1]), indexing="ij")

    def leaf(x: np.ndarray, part: int) -> np.ndarray:
        low, left, above, whole = x[a, b], x[a, -1], x[-1, b], x[-1, -1]
        return (low, left - low, above - low, whole - left - above + low)[part]

    scores = sum(leaf(g, k) ** 2 / (leaf(h, k) + RIDGE) for k in range(4))
    if not scores.size:
        return np.zeros_like(grad), 0.0
    at = np.unravel_index(int(np.argmax(scores)), scores.shape)
    step = [-leaf(g, k)[at] / (leaf(h, k)[at] + RIDGE) for k in range(4)]
    values = np.empty_like(grad)
    i, j = at[0] + 1, at[1] + 1
    values[:i, :j], values[:i, j:], values[i:, :j], values[i:, j:] = step
    return values, float(scores[at])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Additive:
    """Lookup tables: bin edges and values per feature, coarse edges and values per pair."""

    bias: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Chance of label 1 for each row of features."""
        total = np.full(len(x), self.bias)
        for j, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += t[np.searchsorted(e, x[:, j], side="right")]
        if self.pairs:
            bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.coarse)]
            for (a, b), t in zip(self.pairs, self.pair_tables, strict=True):
                total += t[bins[a], bins[b]]
        return sigmoid(total)


def edges_of(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins)) if len(values) else np.empty(0)


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pair_rounds: int = PAIR_ROUNDS) -> Additive:
    """Boost the tables. With one class only the score is (ones + 1) / (rows + 2); without rows nothing
    speaks against a document and every score is 1."""
    width = len(FEATURES)
    edges = [edges_of(x[:, j], BINS) for j in range(width)] if len(x) else [np.empty(0)] * width
    coarse = [edges_of(x[:, j], COARSE) for j in range(width)] if len(x) else [np.empty(0)] * width
    share = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(share / (1 - share))) if len(y) else 40.0
    model = Additive(bias, edges, [np.zeros(len(e) + 1) for e in edges], coarse, [], [])
    if len(y) == 0 or y.min() == y.max():
        return model
    fine = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    counts = [np.bincount(b, minlength=len(e) + 1) for b, e in zip(fine, edges, strict=True)]
    total = np.full(len(y), model.bias)
    for _ in range(rounds):
        for j, b in enumerate(fine):
            p = sigmoid(total)
            n = len(edges[j]) + 1
            step = RATE * best_tree(np.bincount(b, p - y, n), np.bincount(b, p * (1 - p), n), counts[j])
            model.tables[j] += step
            total += step[b]
    rough = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(coarse)]

    def pair_tree(a: int, b: int) -> tuple[np.ndarray, float]:
        p = sigmoid(total)
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        cell = rough[a] * shape[1] + rough[b]
        sums = [np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (p - y, p * (1 - p))]
        return best_pair_tree(*sums)

    ranked = sorted(combinations(range(width), 2), key=lambda ab: -pair_tree(*ab)[1])
    model.pairs = ranked[:PAIRS]
    model.pair_tables = [np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for k, (a, b) in enumerate(model.pairs):
            step = RATE * pair_tree(a, b)[0]
            model.pair_tables[k] += step
            total += step[rough[a], rough[b]]
    return model


def held_out(doc_id: Column) -> Column:
    """The fold that no model may learn from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> Additive:
    """Fit on labelled documents outside the held-out fold, at most ``max_rows`` of them.

    Labels without id or value teach nothing. A document labelled several times counts as often, as does
    a repeated document.
    """
    small_batches(docs.sparkSession)
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select(F.col("doc_id").alias("_id"), F.col(label).cast("double").alias("_y"))
    some = known.orderBy(F.xxhash64("_id"), "_y").limit(max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("_id"))
    seen = rows.select(F.xxhash64("doc_id", "text").alias("_h"), "_y", feature_column(F.col("text")).alias("_x"))
    taken = seen.orderBy("_h", "_y").limit(max_rows).toPandas()
    x = np.array(taken["_x"].tolist(), dtype=np.float64).reshape(-1, len(FEATURES))
    return fit(x, taken["_y"].to_numpy(dtype=np.float64))


def score_column(text: Column, model: Additive) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.array([text_features(t) for t in batch], dtype=np.float64).reshape(-1, len(FEATURES))
            yield pd.Series(model.score(x))

    return F.pandas_udf(run, "double")(text)


def score_quality(docs: DataFrame, model: Additive, threshold: float = 0.7) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 if at least ``threshold``) to every row.

    Null and empty texts are scored as texts without words. Rows are independent; an empty table gives an
    empty result. Columns of the input that bear a name of the result are replaced.
    """
    small_batches(docs.sparkSession)
    scored = docs.withColumn("score", score_column(F.col("text"), model))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op1_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
