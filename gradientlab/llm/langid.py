"""Language ID: averaged embeddings of hashed subwords under a linear softmax.

A text is lower-cased, what isn't a letter counts as a blank, and its subwords
are the runs of 1 to 4 characters that cross no word boundary (a blank at either
end marks one).  The mean of the subwords' embeddings goes through a linear
softmax; embeddings and softmax are trained together by stochastic gradient
descent in numpy.  A temperature fitted on rows apart calibrates the
probabilities.  A text is rejected if it is null or has no letter, or if its
probability is below a threshold that parts right from wrong predictions on the
rows apart.  These are a fifth of each language's rows; a language with a single
row has none, and only if no language has any are the learnt rows taken instead.

As the model is linear, embeddings and softmax are multiplied once into a table
of one row per subword, so scoring is a sum over the whole text.

Learning uses a bounded sample: at most ``max_rows`` rows with texts of at most
``max_chars`` characters, drawn apart for each language, so that a rare one is learnt
at any size of the table.  Rows with a null language don't count in it.  Without
any labelled row every text with a letter gets language ``und`` and is rejected.
Repeated rows get equal results, an empty table an empty result; other columns
pass through (named like an added one: replaced).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, held_out, keep_rows, sample_by_group
from .ngrams import code_points, letters, mixed, windows

BITS = 16
UNKNOWN = "und"


def subwords(text: str) -> np.ndarray:
    """Hashes of all subwords, with repetitions."""
    codes = code_points(text.lower())
    is_letter = letters()[codes]
    if not is_letter.any():
        return np.zeros(0, dtype=np.int64)
    codes = np.concatenate([[32], np.where(is_letter, codes, 32), [32]]).astype(np.uint64)
    solid = np.concatenate([[False], is_letter, [False]])
    found = []
    for n, values in enumerate(windows(codes, 4), 1):
        last = len(solid) - n + 1
        if n == 1:
            inside = solid.copy()
        elif n == 2:
            inside = solid[:last] | solid[1 : 1 + last]
        else:
            inside = np.ones(last, dtype=bool)
            for k in range(1, n - 1):
                inside &= solid[k : k + last]
        found.append(mixed(values[inside], n, BITS))
    return np.concatenate(found)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (subwords, languages)
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, text: str) -> np.ndarray | None:
        """None for a text without letters."""
        found = subwords(text)
        if not len(found):
            return None
        counts = np.bincount(found, minlength=1 << BITS) if len(found) > 1 << BITS else None
        total = counts @ self.table if counts is not None else self.table[found].sum(0, dtype=np.float64)
        return softmax((total / len(found) + self.bias) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, size: int = 16, epochs: int = 8,
          rate: float = 1.0, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(subword table, bias).  ``rows`` are distinct subwords and their shares; classes are drawn evenly."""
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / size, 1 / size, (1 << BITS, size))
    w, b = np.zeros((classes, size)), np.zeros(classes)
    members = [np.flatnonzero(labels == k) for k in range(classes)]
    steps, step = epochs * len(rows), 0
    for _ in range(epochs):
        order = rng.permuted(np.concatenate([rng.choice(m, -(-len(rows) // classes)) for m in members]))
        for i in order[: len(rows)]:
            lr = rate * (1 - step / steps)
            step += 1
            u, share = rows[i]
            a = share @ emb[u]
            error = softmax(w @ a + b)
            error[labels[i]] -= 1
            back = w.T @ error
            w -= lr * np.outer(error, a)
            b -= lr * error * 0.1
            emb[u] -= lr * np.outer(share, back) * size
    return emb @ w.T, b


def choose_threshold(best: np.ndarray, right: np.ndarray, labels: np.ndarray, slack: float = 0.005) -> float:
    """Probability that parts right from wrong predictions, every language weighing as much.

    Cost is the weight of right predictions below it and of wrong ones from it up.  Of all thresholds whose cost is within
    ``slack`` of the least, that nearest to 0.5 is taken, from which a calibrated prediction is rather right than wrong.
    """
    kinds, kind, counts = np.unique(labels, return_inverse=True, return_counts=True)
    weight = 1 / (counts[kind] * len(kinds))
    order = np.argsort(best, kind="stable")
    gain = np.where(right, weight, -weight)[order]
    tries = np.append(np.unique(best), 0.5)
    cost = np.append(0, np.cumsum(gain))[np.searchsorted(best[order], tries)]  # but for a constant
    near = tries[cost <= cost.min() + slack]
    return float(near[np.abs(near - 0.5).argmin()])


def fit_rows(texts: list[str], langs: list[str]) -> Model:
    found = [np.unique(subwords(t), return_counts=True) for t in texts]
    use = [i for i, (u, _) in enumerate(found) if len(u)]
    languages = sorted({langs[i] for i in use})
    if not languages:
        return Model([], np.zeros((1 << BITS, 0), dtype=np.float32), np.zeros(0), 1.0, 0.0)
    labels = np.array([languages.index(langs[i]) for i in use])
    rows = [(found[i][0], found[i][1] / found[i][1].sum()) for i in use]
    apart = np.zeros(len(rows), dtype=bool)
    for k in range(len(languages)):  # the first row of each is always learnt
        apart[np.flatnonzero(labels == k)[1::5]] = True
    learn = np.flatnonzero(~apart)
    table, bias = train([rows[i] for i in learn], labels[learn], len(languages))
    check = np.flatnonzero(apart) if apart.any() else learn
    logits = np.array([rows[i][1] @ table[rows[i][0]] + bias for i in check])
    loss = lambda t: -np.mean([np.log(softmax(x / t)[y] + 1e-12) for x, y in zip(logits, labels[check])])
    temperature = min(np.geomspace(0.1, 10, 41), key=loss)
    best = np.array([softmax(x / temperature).max() for x in logits])
    threshold = choose_threshold(best, logits.argmax(1) == labels[check], labels[check])
    return Model(languages, table.astype(np.float32), bias, float(temperature), threshold)


def fit(docs: DataFrame, max_rows: int = 4000, max_chars: int = 20_000) -> Model:
    """Learn from documents outside the held-out fold that have a language."""
    known = docs.filter(F.col("lang").isNotNull() & ~held_out() & (F.length("text") > 0) & (F.length("text") <= max_chars))
    rows = sample_by_group(known.select("doc_id", "text", "lang"), "lang", F.col("doc_id"), max_rows).toPandas()
    return fit_rows(rows["text"].tolist(), rows["lang"].tolist())


def identify_texts(texts: list[str | None], model: Model) -> list[tuple[str, float, bool]]:
    """(language, probability, whether it is accepted) of each text."""
    out = []
    for t in texts:
        p = model.probabilities(t) if t and model.languages else None
        if p is None:
            out.append((UNKNOWN, 0.0, False))
        else:
            k = int(p.argmax())
            out.append((model.languages[k], float(p[k]), float(p[k]) >= model.threshold))
    return out


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add lang_pred, score (calibrated probability) and accepted."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(column: pa.Array) -> list[pa.Array]:
        found = identify_texts(column.to_pylist(), shared.value)
        kinds = (pa.string(), pa.float64(), pa.bool_())
        return [pa.array([row[k] for row in found], type=kind) for k, kind in enumerate(kinds)]

    return add_columns(df, text, "lang_pred string, score double, accepted boolean", run)


def keep_accepted(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows whose language is accepted, columns unchanged; all of them if nothing could be learnt."""
    if not model.languages:
        return df
    shared = df.sparkSession.sparkContext.broadcast(model)
    return keep_rows(df, text, lambda column: pa.array(
        [ok for _, _, ok in identify_texts(column.to_pylist(), shared.value)], type=pa.bool_()))
