"""Operator 7, counterfactual-regularised toxicity classifier.

A text is the set of its lower-cased words and of their prefixes. Features that labelled toxic texts have significantly
more often than others are kept (at most MAX_FEATURES), and every identity term is a feature too. A logistic model is
fitted with an added penalty: every sentence of the labelled texts is rewritten once for each identity term that it holds,
with that term swapped for another (or, where it holds none, with a term put in front), and the squared change of the score
is penalised, so that a neutral mention of a group moves no score. The changes enter the fit as the sum of their outer
products, made on the executors and at most features x features large, so no number of sentences is too many. Fitting
uses at most MAX_LABELLED rows (expected size of a stable draw), with feature counts made on the executors; every text is
scored whole.

Defined results: null and empty texts have no feature and get the score of the constant alone; a null id is never held
out and never trained on; several labels of one id count by their maximum; repeated rows are scored alike; with no
toxic or no clean label the score is the share of toxic labels, or 0 without labels; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import fold, held_out, ship
from loomgraph.llm.sampling import texts_of, thinned

MAX_LABELLED, MAX_FEATURES = 10_000, 1024
MIN_TEXTS, MIN_Z = 3, 3.0
PREFIXES = (4, 5, 6, 7, 8)
PENALTY, DECAY, STEPS, RATE = 1.0, 1e-5, 800, 0.1
CACHE = 400_000
TOKEN = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[.!?\n]+")
#: Group names, used neutrally; fixed values.
IDENTITY = (
    "women", "men", "woman", "man", "girls", "boys", "gay", "lesbian", "bisexual", "transgender", "queer", "straight",
    "muslim", "muslims", "jewish", "jews", "christian", "christians", "catholic", "hindu", "buddhist", "atheist",
    "black", "white", "asian", "african", "latino", "latina", "arab", "european", "american", "mexican", "indian",
    "chinese", "immigrant", "immigrants", "refugee", "refugees", "disabled", "deaf", "blind", "old", "young",
    "femmes", "hommes", "musulmans", "juifs", "chrétiens", "noirs", "blancs", "immigrés",
    "frauen", "männer", "muslime", "juden", "christen", "schwarze", "ausländer",
    "mujeres", "hombres", "musulmanes", "judíos", "cristianos", "negros", "blancos", "inmigrantes",
)


def words(text: str) -> set[str]:
    return set(TOKEN.findall(text.lower()))


def word_features(word: str) -> list[str]:
    """The word itself and its prefixes, marked by a tilde."""
    return [word, *(word[:k] + "~" for k in PREFIXES if len(word) > k)]


def text_features(text: str) -> set[str]:
    return {f for w in words(text) for f in word_features(w)}


class Model:
    def __init__(self, index: dict[str, int], weights: np.ndarray, bias: float):
        self.index, self.weights, self.bias = index, weights, bias
        self.cache: dict[str, tuple] = {}

    def __reduce__(self):
        return Model, (self.index, self.weights, self.bias)

    def hits(self, word: str) -> tuple:
        got = self.cache.get(word)
        if got is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            got = self.cache[word] = tuple(self.index[f] for f in word_features(word) if f in self.index)
        return got

    def of_words(self, found: set[str]) -> set[int]:
        """Indices of the features that a set of words has."""
        out: set[int] = set()
        for got in filter(None, map(self.hits, found)):
            out.update(got)
        return out

    def vector(self, text: str) -> list[int]:
        return sorted(self.of_words(words(text)))

    def score(self, text: str) -> float:
        z = self.bias + float(self.weights[self.vector(text)].sum())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def counterfactuals(sentence: str) -> list[tuple[set[str], set[str]]]:
    """Words of a sentence and of each of its rewritings. The new term depends on the sentence and the old term alone."""
    own = words(sentence)
    if not own:
        return []
    draw = zlib.crc32(sentence.encode("utf-8", "replace"))
    out = []
    for term in sorted(own & _PLACE.keys()):
        other = IDENTITY[(_PLACE[term] + 1 + draw % (len(IDENTITY) - 1)) % len(IDENTITY)]
        out.append((own, own - {term} | {other}))
    return out or [(own, own | {IDENTITY[draw % len(IDENTITY)]})]


_PLACE = {term: i for i, term in enumerate(IDENTITY)}


def fit_rows(x: np.ndarray, y: np.ndarray, d: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, float]:
    """Weights and bias; d holds the differences of counterfactual pairs."""
    return fit_gram(x, y, d.T @ d, len(d), penalty)


def fit_gram(x: np.ndarray, y: np.ndarray, gram: np.ndarray, pairs: int, penalty: float = PENALTY) -> tuple[np.ndarray, float]:
    """Weights and bias of least mean log loss + penalty * mean squared change + decay; gram sums the pairs' d d'."""
    w, v, m = (np.zeros(x.shape[1] + 1, np.float32) for _ in range(3))
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    gram = (gram / max(1, pairs)).astype(np.float32)
    for t in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) / len(y) + DECAY * np.append(w[:-1], np.float32(0))
        if pairs:
            g[:-1] += penalty * 2 * (gram @ w[:-1])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - np.float32(RATE) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + np.float32(1e-8))
    return w[:-1], float(w[-1])


def changes(texts: DataFrame, model: Model) -> DataFrame:
    """text -> i, j, s: entries of the sum of d d' over all counterfactual pairs; their number at i = j = -1."""

    def run(batches):
        for b in batches:
            kinds: Counter = Counter()
            for text in b.column(0).to_pylist():
                for sentence in SENTENCE.split(text or ""):
                    for old, new in counterfactuals(sentence):
                        a, c = model.of_words(old), model.of_words(new)
                        kinds[tuple(sorted([(i, 1.0) for i in c - a] + [(i, -1.0) for i in a - c]))] += 1
            total: Counter = Counter()
            for d, n in kinds.items():
                total[-1, -1] += n
                for i, x in d:
                    for j, y in d:
                        total[i, j] += n * x * y
            i, j = zip(*total) if total else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(list(total.values()), pa.float64())], names=["i", "j", "s"])

    return texts.select("text").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))


def count_features(rows: DataFrame) -> DataFrame:
    """doc text, y -> f, toxic, clean: texts of each kind that have feature f, added up within tasks first."""

    def run(batches):
        toxic, clean = Counter(), Counter()
        for b in batches:
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                (toxic if y else clean).update(text_features(text or ""))
            if len(toxic) + len(clean) > CACHE:
                yield flush(toxic, clean)
                toxic, clean = Counter(), Counter()
        yield flush(toxic, clean)

    def flush(toxic, clean):
        keys = [*toxic, *(k for k in clean if k not in toxic)]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()), pa.array([clean[k] for k in keys], pa.int64())],
            names=["f", "toxic", "clean"],
        )

    out = rows.select("text", "y").mapInArrow(run, "f string, toxic long, clean long")
    return out.groupBy("f").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fit(docs: DataFrame, labels: DataFrame, k: int = 5, r: int = 0, penalty: float = PENALTY) -> Model:
    """Model from labelled rows whose fold is not r."""
    ship(docs.sparkSession)
    one = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("y"))
    one = one.where(fold(F.col("doc_id"), k) != r)
    by = {row["y"]: row["count"] for row in one.groupBy("y").count().collect()}
    n = sum(by.values())
    if not by.get(1) or not by.get(0):
        share = by.get(1, 0) / n if n else 0.0
        return Model({}, np.zeros(0), 30.0 if share else -30.0)
    rows = texts_of(docs, thinned(one, n, MAX_LABELLED, "doc_id"))
    seen = {row["y"]: row["count"] for row in rows.groupBy("y").count().collect()}
    n_toxic, n_clean = seen.get(1, 0), seen.get(0, 0)
    odds = [(F.col("toxic") + 0.5, n_toxic - F.col("toxic") + 0.5), (F.col("clean") + 0.5, n_clean - F.col("clean") + 0.5)]
    z = (F.log(odds[0][0] / odds[0][1]) - F.log(odds[1][0] / odds[1][1])) / F.sqrt(sum(1 / c for pair in odds for c in pair))
    best = count_features(rows).where(F.col("toxic") >= MIN_TEXTS).withColumn("z", z).where(F.col("z") >= MIN_Z)
    kept = [row["f"] for row in best.orderBy(F.col("z").desc(), "f").limit(MAX_FEATURES).select("f").collect()]
    index = {f: i for i, f in enumerate(dict.fromkeys([*kept, *IDENTITY]))}
    model = Model(index, np.zeros(len(index)), 0.0)

    def run(batches):
        for b in batches:
            v = [model.vector(text or "") for text in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.list_(pa.int32())), b.column(1)], names=["v", "y"])

    got = rows.select("text", F.col("y").cast("int")).mapInArrow(run, "v array<int>, y int").toArrow()
    y = got.column("y").to_numpy().astype(np.float32)
    x = np.zeros((len(y), len(index)), np.float32)
    for i, v in enumerate(got.column("v")):
        x[i, v.values.to_numpy()] = 1
    sums = changes(rows, model).toArrow()
    i, j, s = (sums.column(c).to_numpy() for c in ("i", "j", "s"))
    gram = np.zeros((len(index), len(index)))
    gram[i[i >= 0], j[i >= 0]] = s[i >= 0]
    used = np.flatnonzero(x.any(axis=0) | (gram.diagonal() > 0))
    w, bias = fit_gram(x[:, used], y, gram[np.ix_(used, used)], int(s[i < 0].sum()), penalty)
    weights = np.zeros(len(index))
    weights[used] = w
    return Model(index, weights, bias)


def score(docs: DataFrame, model: Model, k: int = 5, r: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    ship(docs.sparkSession)

    def run(batches):
        for b in batches:
            s = np.array([model.score(t or "") for t in b.column(2).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), k, r).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of docs, all columns as they are, that the model does not call toxic."""
    ship(docs.sparkSession)
    names = docs.columns
    at = names.index("text")

    def run(batches):
        for b in batches:
            yield b.filter(pa.array([model.score(t or "") < 0.5 for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
