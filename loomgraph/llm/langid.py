"""Operator 8, language identification by interpolated Kneser-Ney character models.

Each language has a character model of order ORDER over lower-cased text in which every run of non-letters is one
space. Counts come from a stable sample of about MAX_CHARS characters a language and are made on the executors. The
models are kept as sorted arrays of n-gram hashes (the union over languages) with one row of log probabilities per
n-gram and one row of back-off weights per context; a text's cross-entropy is found by binary search over all of its
positions. The language of least cross-entropy per character wins. A text whose cross-entropy lies above its language's
calibrated limit (a high quantile over texts that were kept apart from the counts) is marked `rejected`; the score is
the winner's share under a softmax whose temperature is calibrated on the same texts, halved for rejected texts.

Defined results: null texts and texts without a letter are `und` with score 0; if no language could be learned every
text is `und`; ties go to the first language in code point order; a null id is never held out and never trained on;
texts of any length are read whole, in blocks; repeated rows are predicted alike; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import fold, held_out, ship
from loomgraph.llm.sampling import SPAN, ticket

ORDER = 4
MAX_CHARS = 1_500_000
MAX_CALIBRATION = 400
REJECT_QUANTILE = 0.995
BLOCK = 1 << 20
FLOOR = 1e-7
NON_LETTERS = re.compile(r"[\W\d_]+")
LETTER = re.compile(r"[^\W\d_]")
UND = "und"


def normalised(text: str | None) -> str:
    """Letters in lower case, other runs as one space, a space at both ends; empty without letters."""
    s = NON_LETTERS.sub(" ", (text or "").lower()).strip()
    return f" {s} " if s else ""


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)


_MUL = np.uint64(0x9E3779B97F4A7C15)


def hashes(c: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n characters that end at each position from n - 1 on."""
    m = len(c) - n + 1
    h = np.full(m, n, np.uint64)
    for k in range(n):
        h = (h ^ c[k : k + m]) * _MUL
        h ^= h >> np.uint64(29)
    return h


class Model:
    """Joint tables of all languages: grams[n] -> log p, contexts[n] -> log back-off, for n = 1..ORDER."""

    def __init__(self, langs, grams, probs, contexts, backoffs, limit, temperature):
        self.langs, self.grams, self.probs, self.contexts, self.backoffs = langs, grams, probs, contexts, backoffs
        self.limit, self.temperature = limit, temperature

    def log_probs(self, c: np.ndarray) -> np.ndarray:
        """Log probability under each language of every character after the first."""
        out = np.empty((len(c) - 1, len(self.langs)), np.float32)
        for i in range(1, min(ORDER, len(c))):  # too little context for the full order
            out[i - 1] = self._at(c[: i + 1], np.array([0]), i + 1)[0]
        if len(c) >= ORDER:
            out[ORDER - 2 :] = self._at(c, np.arange(len(c) - ORDER + 1), ORDER)
        return out

    def _at(self, c: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
        """Log probabilities of the n-grams that start at the given places."""
        h = hashes(c, n)[start]
        table = self.grams[n]
        at = np.minimum(np.searchsorted(table, h), len(table) - 1)
        out = self.probs[n][at]
        miss = np.flatnonzero(table[at] != h)
        if len(miss):
            if n == 1:
                out[miss] = np.log(FLOOR)
            else:
                low = self._at(c, start[miss] + 1, n - 1)
                ctx = hashes(c, n - 1)[start[miss]]
                t = self.contexts[n]
                k = np.minimum(np.searchsorted(t, ctx), len(t) - 1)
                out[miss] = low + np.where((t[k] == ctx)[:, None], self.backoffs[n][k], 0)
        return out

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Cross-entropy per character of normalised, non-empty texts under each language."""
        total = np.zeros((len(texts), len(self.langs)))
        size = np.array([max(1, len(t) - 1) for t in texts])
        group, chars = [], 0
        for i, t in enumerate(texts):
            if len(t) > BLOCK:
                c = codes(t)
                for a in range(0, len(c) - 1, BLOCK):
                    back = min(a, ORDER - 2)
                    total[i] += self.log_probs(c[a - back : a + BLOCK + 1])[back:].sum(axis=0, dtype=np.float64)
                continue
            group.append(i)
            chars += len(t)
            if chars >= BLOCK:
                self._sum(texts, group, total)
                group, chars = [], 0
        self._sum(texts, group, total)
        return -total / size[:, None]

    def _sum(self, texts, group, total) -> None:
        """Texts joined end to end are looked up at once; what spans two texts is looked up again."""
        if not group:
            return
        c = codes("".join(texts[i] for i in group))
        lp = self.log_probs(c)
        ends = np.cumsum([len(texts[i]) for i in group])
        starts = np.concatenate([[0], ends[:-1]])
        for s, e in zip(starts[1:], ends[1:]):
            k = min(ORDER - 1, e - s)
            if k > 1:
                lp[s : s + k - 1] = self.log_probs(c[s : s + k])
        run = np.vstack([np.zeros((1, lp.shape[1])), np.cumsum(lp, axis=0, dtype=np.float64)])
        for i, s, e in zip(group, starts, ends):
            total[i] += run[e - 1] - run[s]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        flat = [normalised(t) for t in texts]
        use = [i for i, t in enumerate(flat) if t] if self.langs else []
        out = [(UND, 0.0, True)] * len(texts)
        if not use:
            return out
        ce = self.entropies([flat[i] for i in use])
        best = ce.argmin(axis=1)
        z = np.exp(-(ce - ce.min(axis=1, keepdims=True)) * self.temperature)
        share = 1 / z.sum(axis=1)
        for i, b, e, p in zip(use, best.tolist(), ce, share.tolist()):
            rejected = bool(e[b] > self.limit[b])
            out[i] = (self.langs[b], p / 2 if rejected else p, rejected)
        return out


def kneser_ney(counts: list[Counter], langs: list[str]) -> tuple[dict, dict, dict, dict]:
    """Tables from each language's counts of ORDER-grams (and shorter ones at text starts)."""
    orders = range(1, ORDER + 1)
    per: list[list[dict]] = []
    for full in counts:
        use = {n: Counter() for n in orders}
        for g, c in full.items():
            if len(g) == ORDER:
                use[ORDER][g] += c
        seen = {n: set() for n in orders}
        seen[ORDER] = set(use[ORDER])
        for n in range(ORDER - 1, 0, -1):  # continuation counts: distinct characters before
            longer = seen[n + 1]
            use[n].update(g[1:] for g in longer)
            seen[n] = set(use[n])
            for g, c in full.items():  # text starts have no character before
                if len(g) == n:
                    use[n][g] += c
                    seen[n].add(g)
        per.append([{}, *(use[n] for n in orders)])
    union = {n: sorted(set().union(*(p[n] for p in per))) for n in orders}
    probs: dict[int, np.ndarray] = {}
    backs: dict[int, np.ndarray] = {}
    ctxs: dict[int, list[str]] = {}
    lower: list[dict] = [{} for _ in langs]
    for n in orders:
        ctxs[n] = sorted({g[:-1] for g in union[n]})
        place = {g: i for i, g in enumerate(ctxs[n])}
        probs[n] = np.empty((len(union[n]), len(langs)), np.float32)
        backs[n] = np.zeros((len(ctxs[n]), len(langs)), np.float32)
        for j in range(len(langs)):
            use = per[j][n]
            kinds = Counter(use.values())
            d = kinds[1] / (kinds[1] + 2 * kinds[2]) if kinds[1] and kinds[2] else 0.5
            total, types = Counter(), Counter()
            for g, c in use.items():
                total[g[:-1]] += c
                types[g[:-1]] += 1
            bow = {h: d * types[h] / total[h] for h in total}
            here = {}
            for i, g in enumerate(union[n]):
                h = g[:-1]
                base = FLOOR if n == 1 else lower[j].get(g[1:], FLOOR)
                c = use.get(g, 0)
                here[g] = (max(c - d, 0) / total[h] if c else 0) + (bow.get(h, 1.0) * base)
                probs[n][i, j] = np.log(max(here[g], 1e-30))
            for h, b in bow.items():
                backs[n][place[h], j] = np.log(b)
            lower[j] = here
    pack = lambda keys, k: np.array([hashes(codes(g), k)[0] if k else 0 for g in keys], np.uint64)
    grams, contexts = {}, {}
    for n in orders:
        h = pack(union[n], n)
        order = np.argsort(h)
        grams[n], probs[n] = h[order], probs[n][order]
        h = pack(ctxs[n], n - 1)
        order = np.argsort(h)
        contexts[n], backs[n] = h[order], backs[n][order]
    return grams, probs, contexts, backs


def gram_counts(rows: DataFrame) -> DataFrame:
    """lang, text -> lang, gram, n: grams of ORDER characters, and the shorter ones that start a text."""

    def run(batches):
        own: dict[str, Counter] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = normalised(text)
                c = own.setdefault(lang, Counter())
                c.update(s[i : i + ORDER] for i in range(len(s) - ORDER + 1))
                c.update(s[:k] for k in range(2, min(ORDER, len(s) + 1)))
        flat = [(lang, g, n) for lang, c in own.items() for g, n in c.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in flat], pa.string()), pa.array([x[1] for x in flat], pa.string()), pa.array([x[2] for x in flat], pa.int64())],
            names=["lang", "gram", "n"],
        )

    return rows.mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, k: int = 4, r: int = 2) -> Model:
    """Model from rows with a language whose fold is not r."""
    spark = docs.sparkSession
    ship(spark)
    ok = docs.where(F.col("lang").isNotNull() & (fold(F.col("doc_id"), k) != r)).select(F.col("lang").cast("string").alias("lang"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sizes = ok.groupBy("lang").agg(F.sum(F.length("text")).alias("chars"), F.count("*").alias("rows"))
    draw = ticket("doc_id")
    # one row a language; a language's rows are drawn with a chance that gives about MAX_CHARS characters
    bound = sizes.select("lang", (F.least(F.lit(1.0), F.lit(MAX_CHARS) / F.greatest("chars", F.lit(1))) * SPAN).cast("long").alias("upto"), (F.least(F.lit(1.0), F.lit(MAX_CALIBRATION) / F.col("rows")) * SPAN * 2).cast("long").alias("extra"))
    drawn = ok.join(F.broadcast(bound), "lang").withColumn("draw", draw)
    got = gram_counts(drawn.where("draw < upto and draw % 8 > 0").select("lang", "text")).toArrow()
    by: dict[str, Counter] = {}
    for lang, g, n in zip(*(got.column(c).to_pylist() for c in ("lang", "gram", "n"))):
        by.setdefault(lang, Counter())[g] = n
    langs = sorted(x for x, c in by.items() if any(len(g) == ORDER for g in c))
    if not langs:
        return Model([], {}, {}, {}, {}, np.empty(0), 1.0)
    model = Model(langs, *kneser_ney([by[x] for x in langs], langs), np.full(len(langs), np.inf), 1.0)
    apart = drawn.where("draw % 8 = 0 and draw < extra").select("lang", "text").toPandas()
    return calibrated(model, apart["lang"].tolist(), apart["text"].tolist())


def calibrated(model: Model, langs: list[str], texts: list[str]) -> Model:
    """Set the rejection limits and the temperature from texts of known language."""
    flat = [(x, normalised(t)) for x, t in zip(langs, texts)]
    flat = [(x, t) for x, t in flat if t and x in model.langs]
    if not flat:
        return model
    ce = model.entropies([t for _, t in flat])
    y = np.array([model.langs.index(x) for x, _ in flat])
    for j in range(len(model.langs)):
        own = ce[y == j, j]
        if len(own) >= 20:
            model.limit[j] = float(np.quantile(own, REJECT_QUANTILE) * 1.25)
    gap = ce - ce.min(axis=1, keepdims=True)
    best = (np.inf, 1.0)
    for t in (0.5, 1, 2, 4, 8, 16):
        z = -gap * t
        loss = float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(y)), y]).mean())
        best = min(best, (loss, float(t)))
    model.temperature = best[1]
    return model


def label(docs: DataFrame, model: Model, k: int = 4, r: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every row."""
    ship(docs.sparkSession)

    def run(batches):
        for b in batches:
            got = model.predict(b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), k, r).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame) -> DataFrame:
    return label(docs, fit(docs))
