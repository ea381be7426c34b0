"""Quality classifier: a linear hinge-loss model over Naive Bayes features.

A text's features are indicators of hashed n-grams: of its characters in lower
case, of its shape (characters replaced by their kind, runs collapsed), of its
words, and of equal neighbouring words.  Each indicator is scaled by the
log-count ratio of the two classes, rows are brought to length 1, and dual
coordinate descent fits the hinge-loss model.  A logistic curve fitted on rows
that the model hasn't seen turns margins into probabilities.

Learning uses a bounded sample of labelled rows: at most ``max_rows`` rows with
texts of at most ``max_chars`` characters.  Scoring is one pass over whole texts.

Null and empty texts have no features and get the score of a zero margin.  A
document with several labels counts by their mean, ties as 1; null labels and
null ids don't count.  Without labels of both classes every score is the share
of label 1 (0.5 without labels).  Repeated rows get equal scores, an empty table
an empty result; other columns pass through (named like an added one: replaced).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, bounded_sample, held_out, keep_rows
from .ngrams import code_points, distinct, mixed, shapes, windows

BITS = 18
REJECT_BELOW = 0.3


def features(text: str, scratch: np.ndarray) -> np.ndarray:
    """Indices of the n-grams that occur."""
    if not text:
        return np.zeros(0, dtype=np.int64)
    found = [mixed(w, n, BITS) for n, w in enumerate(windows(code_points(text.lower()), 3), 1)]
    kind = shapes()[code_points(text)].astype(np.uint64)
    kind = kind[np.append(True, kind[1:] != kind[:-1])]
    found += [mixed(w, 20 + n, BITS) for n, w in enumerate(windows(kind, 5), 1)]
    words = np.fromiter(map(hash_word, text.lower().split()), dtype=np.uint64)
    found.append(mixed(words, 40, BITS))
    same = (words[1:] == words[:-1]).astype(np.uint64) + np.uint64(1)
    found += [mixed(w, 50 + n, BITS) for n, w in enumerate(windows(same, 4), 1)]
    return distinct(np.concatenate(found), scratch)


def hash_word(word: str) -> int:
    data = word.encode("utf-8", "surrogatepass")
    if len(data) > 16:
        data = hashlib.blake2b(data, digest_size=16).digest()
    return int.from_bytes(data.ljust(8, b"\0"), "little") % 0xFFFFFFFFFFFFFFC5


@dataclass
class Model:
    weights: np.ndarray  # of the scaled indicators, times their scale
    squares: np.ndarray  # of the scales
    bias: float
    slope: float
    offset: float
    constant: float | None = None

    def margins(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(rows), self.bias)
        for i, u in enumerate(rows):
            if norm := float(self.squares[u].sum(dtype=np.float64)):
                out[i] += float(self.weights[u].sum(dtype=np.float64)) / norm**0.5
        return out

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(rows), self.constant)
        return logistic(self.slope * self.margins(rows) + self.offset)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, smooth: float = 1.0, least: int = 3) -> np.ndarray:
    """log of the classes' smoothed indicator counts over their sums; 0 for n-grams of fewer than ``least`` rows."""
    counts = np.zeros((2, 1 << BITS))
    for u, y in zip(rows, labels):
        counts[int(y), u] += 1
    p, q = counts[1] + smooth, counts[0] + smooth
    return np.where(counts.sum(0) >= least, np.log(p / p.sum()) - np.log(q / q.sum()), 0.0)


def dual_descent(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, cost: float = 1.0, epochs: int = 30,
                 seed: int = 7, tolerance: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights of the scaled indicators and bias of the L1-loss hinge model, one dual variable a step."""
    y = np.where(labels > 0, 1.0, -1.0)
    share = np.bincount((labels > 0).astype(int), minlength=2) / len(labels)
    upper = cost * 0.5 / share[(labels > 0).astype(int)]  # either class weighs as much
    values = [scale[u] / max(np.sqrt((scale[u] ** 2).sum()), 1e-12) for u in rows]
    w, b, alpha = np.zeros(len(scale)), 0.0, np.zeros(len(rows))
    diagonal = np.array([float(v @ v) + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            gradient = y[i] * (float(w[rows[i]] @ values[i]) + b) - 1
            new = min(max(alpha[i] - gradient / diagonal[i], 0.0), upper[i])
            if step := new - alpha[i]:
                w[rows[i]] += step * y[i] * values[i]
                b += step * y[i]
                alpha[i] = new
                worst = max(worst, abs(step))
        if worst < tolerance:
            break
    return w, b


def calibrate(margins: np.ndarray, labels: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and offset of the logistic curve, by Newton's method on smoothed targets."""
    n1, n0 = float((labels > 0).sum()), float((labels <= 0).sum())
    target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, theta = np.stack([margins, np.ones_like(margins)], 1), np.array([1.0, 0.0])
    for _ in range(steps):
        p = logistic(x @ theta)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(hessian, x.T @ (p - target))
        theta -= np.clip(move, -2, 2)
        if abs(move).max() < 1e-9:
            break
    return max(float(theta[0]), 1e-6), float(theta[1])


def fit_rows(texts: list[str], labels: np.ndarray) -> Model:
    """Model from texts and their labels (0 or 1)."""
    none = np.zeros(1 << BITS, dtype=np.float32)
    if len(set(labels.tolist())) < 2:
        return Model(none, none, 0.0, 1.0, 0.0, float(labels.mean()) if len(labels) else 0.5)
    scratch = np.zeros(1 << BITS, dtype=np.int64)
    rows = [features(t, scratch).astype(np.int32) for t in texts]
    apart = np.arange(len(rows)) % 5 == 0  # the rows come in the order of a hash
    apart &= np.array([min((labels[~apart] == v).sum() for v in (0, 1)) > 0 and min((labels[apart] == v).sum() for v in (0, 1)) > 0])
    learn = ~apart if apart.any() else np.ones(len(rows), dtype=bool)
    check = apart if apart.any() else learn
    pick = lambda mask: [r for r, m in zip(rows, mask) if m]
    scale = log_count_ratios(pick(learn), labels[learn])
    w, bias = dual_descent(pick(learn), labels[learn], scale)
    model = Model((w * scale).astype(np.float32), (scale**2).astype(np.float32), bias, 1.0, 0.0)
    model.slope, model.offset = calibrate(model.margins(pick(check)), labels[check])
    return model


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, max_chars: int = 50_000) -> Model:
    """Learn from documents outside the held-out fold that have a label."""
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label")).filter(~held_out())
    )
    sample = bounded_sample(known, F.col("doc_id"), max_rows)  # so many rows at most: small enough to send to every task
    rows = (
        docs.select("doc_id", "text").filter((F.length("text") > 0) & (F.length("text") <= max_chars))
        .join(F.broadcast(sample), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * max_rows).toPandas()
    )
    return fit_rows(rows["text"].tolist(), rows["label"].to_numpy(dtype=np.int64))


def score_texts(texts: list[str | None], model: Model) -> np.ndarray:
    scratch = np.zeros(1 << BITS, dtype=np.int64)
    return model.scores([features(t or "", scratch) for t in texts])


def score(df: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """Add ``score`` (0 to 1, higher: label 1 likelier)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    return add_columns(
        df, text, f"`{score}` double", lambda column: [pa.array(score_texts(column.to_pylist(), shared.value))])


def keep_good(df: DataFrame, model: Model, text: str = "text", least: float = REJECT_BELOW) -> DataFrame:
    """The rows whose score is at least ``least``, columns unchanged; all of them if nothing could be learnt."""
    if model.constant is not None:
        return df
    shared = df.sparkSession.sparkContext.broadcast(model)
    return keep_rows(df, text, lambda column: pa.array(score_texts(column.to_pylist(), shared.value) >= least))
