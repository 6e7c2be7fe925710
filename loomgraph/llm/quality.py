"""Operator 2, quality classifier by positive-unlabelled learning.

Trusted positives are labelled rows of quality 1; labelled rows of quality 0 are not used. Unlabelled rows are texts of
the same folds. A text is described by shares of character classes, repetition, word and line statistics, each cut at
quantiles into bins. The class prior is estimated from first classifiers of positives against unlabelled texts, one for each
half of the rows, of which each scores the other half: the smallest ratio of unlabelled to positive mass above a threshold,
with a confidence term (best bin estimation). Every unlabelled text of the folds counts in it, through a histogram of
HISTOGRAM bins of the score that is made on the executors. The second classifier minimises the non-negative unbiased risk prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) with the
logistic loss; where the second part is negative its gradient is reversed. Gradient
steps use at most MAX_POSITIVE and MAX_UNLABELLED rows (expected size of a stable draw), on the driver; every text is scored
whole.

Defined results: null and empty texts are scored as a text without characters; a null id is never held out and never
trained on; several labels of one id count by their maximum; repeated rows are scored alike; with no positives the
score is 0.5; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import fold, held_out, ship
from loomgraph.llm.sampling import texts_of, thinned, ticket

MAX_POSITIVE, MAX_UNLABELLED = 12_000, 24_000
BINS, STEPS, RATE, DECAY = 12, 600, 0.05, 1e-4
HISTOGRAM = 4096
UPPER, LOWER, DIGIT, SPACE, END, SYMBOL, OTHER = range(7)
N_FEATURES = 14


@lru_cache(1)
def classes() -> np.ndarray:
    """Character class of each code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x3000):
        ch, cat = chr(c), unicodedata.category(chr(c))
        out[c] = (
            SPACE if ch.isspace() else UPPER if cat == "Lu" else LOWER if cat in ("Ll", "Lo", "Lm", "Mn") else DIGIT if cat == "Nd"
            else END if ch in ".,;:'\"-()?" else SYMBOL
        )
    return out


def features(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    n = max(1, len(codes))
    share = np.bincount(classes()[codes], minlength=7) / n
    words = text.split()
    k = max(1, len(words))
    same = sum(map(str.__eq__, words, words[1:]))
    lines = [x for x in text.split("\n") if x.strip()]
    m = max(1, len(lines))
    runs = np.count_nonzero(codes[1:] == codes[:-1]) if len(codes) > 1 else 0
    return np.array([
        np.log1p(len(words)), share[UPPER], share[LOWER], share[DIGIT], share[END], share[SYMBOL], share[OTHER],
        len(set(words)) / k, same / k, n / k, len(set(lines)) / m, np.log1p(k / m), runs / n,
        sum(w[-1] in ".!?" for w in words) / k,
    ], np.float32)


class Model:
    def __init__(self, cuts: list[np.ndarray], weights: np.ndarray):
        self.cuts, self.weights = cuts, weights

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.weights[-1], np.float64)
        at = 0
        for j, c in enumerate(self.cuts):
            out += self.weights[at + np.searchsorted(c, x[:, j], side="right")]
            at += len(c) + 1
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """One-hot bins of every feature and a constant."""
    size = sum(len(c) + 1 for c in cuts) + 1
    out = np.zeros((len(x), size), np.float32)
    at = 0
    for j, c in enumerate(cuts):
        out[np.arange(len(x)), at + np.searchsorted(c, x[:, j], side="right")] = 1
        at += len(c) + 1
    out[:, -1] = 1
    return out


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(gradient, size: int) -> np.ndarray:
    """Adam with a fixed number of steps."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, STEPS + 1):
        g = gradient(w) + DECAY * w
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def separate(p: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Positives against unlabelled texts, both with half the weight."""
    return _descend(lambda w: 0.5 * (p.T @ (_sigmoid(p @ w) - 1) / len(p) + u.T @ _sigmoid(u @ w) / len(u)), p.shape[1])


def class_prior(p: np.ndarray, u: np.ndarray, delta: float = 0.1) -> float:
    """Best bin estimation from scores of held-back positives and unlabelled rows."""
    t = np.unique(p)
    qp = 1 - np.searchsorted(np.sort(p), t, side="left") / len(p)
    qu = 1 - np.searchsorted(np.sort(u), t, side="left") / len(u)
    slack = np.sqrt(np.log(4 / delta) / 2) * (1 / np.sqrt(len(p)) + 1 / np.sqrt(len(u)))
    best = np.argmin((qu + slack) / qp)
    return float(np.clip(qu[best] / qp[best], 0.01, 0.99))


def prior_of_counts(p: np.ndarray, u: np.ndarray, delta: float = 0.1) -> float:
    """Best bin estimation from the numbers of positives and of unlabelled rows in each bin of the score, lowest first."""
    if not p.sum() or not u.sum():
        return 0.5
    qp, qu = (np.cumsum(x[::-1])[::-1] / x.sum() for x in (p, u))
    slack = np.sqrt(np.log(4 / delta) / 2) * (1 / np.sqrt(p.sum()) + 1 / np.sqrt(u.sum()))
    at = np.flatnonzero(p)
    best = at[np.argmin((qu[at] + slack) / qp[at])]
    return float(np.clip(qu[best] / qp[best], 0.01, 0.99))


def score_bin(score: np.ndarray) -> np.ndarray:
    """Bins of scores in [0, 1]; even in the logit, so that both ends stay apart."""
    z = np.log(np.maximum(score, 1e-12)) - np.log(np.maximum(1 - score, 1e-12))
    return np.clip((z + 16) * (HISTOGRAM / 32), 0, HISTOGRAM - 1).astype(np.int64)


def non_negative(p: np.ndarray, u: np.ndarray, prior: float) -> np.ndarray:
    """Weights of least non-negative risk."""

    def gradient(w):
        sp, su = _sigmoid(p @ w), _sigmoid(u @ w)
        fp, fu = np.clip(p @ w, -30, 30), np.clip(u @ w, -30, 30)
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        g_neg = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
        if negative < 0:
            return -g_neg
        return prior * (p.T @ (sp - 1)) / len(p) + g_neg

    return _descend(gradient, p.shape[1])


def cuts_of(p: np.ndarray, u: np.ndarray) -> list[np.ndarray]:
    both = np.vstack([p, u])
    return [np.unique(np.quantile(both[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(both.shape[1])]


def half(doc_id) -> "F.Column":
    """Which half of the rows an id is in; independent of the draw of rows."""
    return F.pmod(F.xxhash64(F.lit(29), doc_id), F.lit(2)).cast("int")


def histogram(docs: DataFrame, judges: list[Model]) -> np.ndarray:
    """Number of texts in each bin of the score that the other half's judge gives."""

    def run(batches):
        count = np.zeros(HISTOGRAM, np.int64)
        for b in batches:
            x = np.array([features(t or "") for t in b.column(0).to_pylist()], np.float32).reshape(-1, N_FEATURES)
            side = b.column(1).to_numpy()
            for h in (0, 1):
                count += np.bincount(score_bin(judges[1 - h].score(x[side == h])), minlength=HISTOGRAM)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(count[at], pa.int64())], names=["bin", "n"])

    rows = docs.select("text", half("doc_id").alias("half")).mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(HISTOGRAM, np.int64)
    out[rows.column("bin").to_numpy()] = rows.column("n").to_numpy()
    return out


def feature_rows(df: DataFrame) -> DataFrame:
    """doc_id, text -> x: the features as floats; half."""
    ship(df.sparkSession)

    def run(batches):
        for b in batches:
            x = [features(t or "") for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float32())), b.column(1)], names=["x", "half"])

    return df.select("text", half("doc_id").alias("half")).mapInArrow(run, "x array<float>, half int")


def fit(docs: DataFrame, labels: DataFrame, k: int = 3, r: int = 1) -> tuple[Model, float]:
    """Model and class prior from labelled rows and texts whose fold is not r."""
    one = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("y"))
    one = one.where((F.col("y") == 1) & (fold(F.col("doc_id"), k) != r)).select("doc_id")
    ids = thinned(one, one.count(), MAX_POSITIVE, "doc_id")
    rest = docs.where(fold(F.col("doc_id"), k) != r)
    free = rest.where(ticket("doc_id") < int((1 << 30) * min(1, MAX_UNLABELLED / max(1, rest.count()))))

    def take(d: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        got = feature_rows(d).toArrow()
        return np.array([x.as_py() for x in got.column("x")], np.float32).reshape(-1, N_FEATURES), got.column("half").to_numpy()

    (p, p_half), (u, u_half) = take(texts_of(docs, ids)), take(free)
    if not len(p) or not len(u):
        return Model([np.empty(0)] * N_FEATURES, np.zeros(N_FEATURES + 1)), 0.5
    cuts = cuts_of(p, u)
    P, U = binned(p, cuts).astype(np.float64), binned(u, cuts).astype(np.float64)
    prior = 0.5
    if all((p_half == h).any() and (u_half == h).any() for h in (0, 1)):
        judges = [Model(cuts, separate(P[p_half == h], U[u_half == h])) for h in (0, 1)]
        seen = sum(np.bincount(score_bin(judges[1 - h].score(p[p_half == h])), minlength=HISTOGRAM) for h in (0, 1))
        prior = prior_of_counts(seen, histogram(rest, judges))
    return Model(cuts, non_negative(P, U, prior)), prior


def score(docs: DataFrame, model: Model, k: int = 3, r: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    ship(docs.sparkSession)

    def run(batches):
        for b in batches:
            x = np.array([features(t or "") for t in b.column(2).to_pylist()], np.float32).reshape(-1, N_FEATURES)
            s = model.score(x)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), k, r).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels)[0])
