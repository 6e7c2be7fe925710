"""Each operator against a brute-force version, an exact round trip or held-out accuracy, and its edge cases."""

import base64
import hashlib
import io
import os
import re
import time
import wave
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomgraph.llm import ann, common, langid, line_dedup, linking, media, mixing, ngram_join, pieces, quality, toxicity, warc
from loomgraph.llm.common import shared_dir, table

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, v long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, texts, sources=None):
    """Documents with extra columns whose names clash with the operators' own."""
    rows = [(i, t, "en", (sources or ["a"])[i % len(sources or ["a"])], len(t or ""), "x", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def prose(seed, n, size=400):
    r = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in r.integers(0, size, n))


# ---- 1 -------------------------------------------------------------------------------------------------------------


def brute_lines(texts):
    """Lines that are left of each text, by all pairs of distinct normalised lines and Spark-independent edit distance."""
    def norm(x):
        return re.sub(r"[^\w]+|_", " ", x.lower()).strip()

    def edit(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    return norm, edit


def test_simhash_agrees_with_plain_counts(spark):
    r = np.random.default_rng(5)
    arrays = [r.integers(-(2**63), 2**63 - 1, n).tolist() for n in (1, 2, 3, 62, 63, 64, 65, 16_383, 16_384, 40_000)]
    rows = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "i int, h array<bigint>")
    got = {x.i: x.s & (1 << 64) - 1 for x in rows.select("i", line_dedup.simhash(F.col("h")).alias("s")).collect()}
    for i, a in enumerate(arrays):
        bits = np.unpackbits(np.array(a, np.int64).view(np.uint64).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0)
        assert got[i] == sum(1 << b for b in range(64) if 2 * bits[b] > len(a))


def test_line_dedup_of_clashing_columns_and_long_lines(spark):
    long = " ".join(f"word{i}" for i in range(30_000))
    rows = [(0, long, 1, "a", 5), (1, long.replace("word77 ", "ward77 "), 2, "b", 6), (None, "x y z", 3, "c", 7), (None, "x y z", 4, "d", 8)]
    d = spark.createDataFrame(rows, "doc_id long, text string, gone int, _key string, `row.id` int")
    out = sorted(line_dedup.dedup_documents(d).collect(), key=lambda r: r["gone"])
    assert d.columns == out[0].__fields__ and [r["_key"] for r in out] == ["a", "b", "c", "d"]
    assert [r.text for r in out] == [long, "", "x y z", "x y z"]


def test_line_dedup_against_brute_force(spark):
    base = [prose(i, 60) for i in range(6)]
    near = base[0].replace("w1 ", "q1 ", 1)
    texts = [f"{base[0]}\n{base[1]}\n---", f"{base[2]}\n{base[0].upper()}!\n---", f"{near}\n{base[3]}", base[4], base[4], None, "", "\n\n", f"{base[5]}\n{base[5]}"]
    norm, edit = brute_lines(texts)
    rows = [(i, j, norm(x)) for i, t in enumerate(texts) if t for j, x in enumerate(t.split("\n")) if norm(x)]
    distinct = sorted({x for _, _, x in rows})
    group = {x: x for x in distinct}
    for a in distinct:
        for b in distinct:
            if a < b and 1 - edit(a, b) / max(len(a), len(b)) >= 0.8:
                ga, gb = group[a], group[b]
                group = {x: ga if g == gb else g for x, g in group.items()}
    first, kept = set(), defaultdict(list)
    for i, j, x in rows:
        if group[x] not in first:
            first.add(group[x])
            kept[i].append(j)
    want = {}
    for i, t in enumerate(texts):
        want[i] = t if t is None else "\n".join(x for j, x in enumerate(t.split("\n")) if not norm(x) or j in kept[i])
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs(spark, texts)).collect()}
    assert got == want
    assert got[4] == "" and got[1].endswith("---")


def test_line_dedup_edges(spark):
    out = line_dedup.dedup_documents(docs(spark, ["a b c\nx y z", "a b c"]))
    assert out.columns == DOCS.replace(" long", "").replace(" string", "").split(", ")
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {0: ("a b c\nx y z", 11), 1: ("", 0)}
    assert line_dedup.dedup_lines(empty(spark)).count() == 0
    same = docs(spark, ["p q r"]).union(docs(spark, ["p q r"]))
    assert [r.text for r in line_dedup.dedup_lines(same).collect()] == ["p q r", "p q r"]


def test_line_dedup_recall_against_plain_edit_similarity(spark):
    r = np.random.default_rng(11)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    texts, pairs = [], []
    for n in (1, 2, 4, 8, 17, 40, 90):
        for share in (0.0, 0.05, 0.1, 0.15):
            for _ in range(6):
                line = " ".join("".join(r.choice(letters, r.integers(3, 10))) for _ in range(n))
                if len(line) < 5:
                    line += "xyz"
                other = list(line)
                for i in r.choice([i for i, c in enumerate(line) if c != " "], max(1, int(len(line) * share)), replace=False):
                    other[i] = r.choice([c for c in letters if c != line[i]])
                pairs.append((len(texts), len(texts) + 1, n))
                texts += [line, "".join(other)]
    unspaced = "".join(r.choice(letters, 60))
    pairs.append((len(texts), len(texts) + 1, 1))
    texts += [unspaced, unspaced[:30] + "0" + unspaced[31:]]
    _, edit = brute_lines(texts)
    pairs = [(a, b) for a, b, n in pairs if n > 20 or 1 - edit(texts[a], texts[b]) / max(len(texts[a]), len(texts[b])) >= 0.8]
    gone = {x.doc_id for x in line_dedup.dedup_lines(docs(spark, texts)).where("n_gone = 1").collect()}
    assert len(pairs) > 150 and gone <= {b for _, b in pairs}
    assert len(gone) >= 0.95 * len(pairs) and len(texts) - 1 in gone


def test_line_keys_follow_from_the_line_alone(spark):
    r = np.random.default_rng(8)
    letters = list("abcdefghijklmnopqrstuvwxyz")

    def words(n):
        return " ".join("".join(r.choice(letters, r.integers(3, 10))) for _ in range(n))

    pairs = []
    for n in (8, 17, 40, 90):
        for _ in range(40):
            line = list(words(n))
            other = list(line)
            for i in r.choice([i for i, c in enumerate(line) if c != " "], int(len(line) * 0.12), replace=False):
                other[i] = r.choice([c for c in letters if c != line[i]])
            pairs.append(("".join(line), "".join(other)))
    a, b = (line_dedup.line_keys(F.col(c)) for c in "ab")
    shared = spark.createDataFrame(pairs, "a string, b string").where(F.arrays_overlap(a, b)).count()
    assert shared >= 0.95 * len(pairs)  # in a table of any size


def test_line_dedup_leaves_one_table(spark):
    def folders():
        return set(os.listdir("/" + shared_dir(spark).removeprefix("file:").lstrip("/")))

    before = folders()
    lines = [prose(i, 30) for i in range(8)]
    out = line_dedup.dedup_lines(docs(spark, [f"{x}\n{x.replace('w', 'q', 1)}" for x in lines]))
    left = {x.rsplit("-", 1)[0] for x in folders() - before} - {"cc", "merged"}  # small ones
    assert left == {"line-gone"}
    assert out.agg(F.sum("n_gone")).first()[0] == 8


def test_tables_leave_no_shuffle_files(spark):
    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {x for x in found.mkString("\n").split("\n") if "/shuffle_" in x}

    before = files()
    out = table(spark.range(20000).groupBy((F.col("id") % 700).alias("k")).count(), "t")
    until = time.time() + 10  # they are deleted in the background
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before
    assert spark.conf.get(common.CLEANUP, None) is None
    assert out.count() == 700


def test_line_dedup_in_slices(spark, monkeypatch):
    lines = [prose(i, 30) for i in range(12)]
    shared = "the same passage of some words in each of them"  # of lines that are not similar
    unlike = [f"{prose(100 + i, 20 + 9 * i)} {shared}" for i in range(9)]
    rows = defaultdict(list)

    def counted(df, name):
        out = table(df, name)
        rows[name].append(out.count())
        return out

    for module, name, value in ((line_dedup, "table", counted), (linking, "table", counted), (line_dedup, "SLICED_ROWS", 0), (linking, "SLICE_ROWS", 10), (linking, "SLICES", 2)):
        monkeypatch.setattr(module, name, value)
    out = line_dedup.dedup_lines(docs(spark, [f"{x}\n{x.replace('w', 'q', 2)}" for x in lines] + unlike))
    assert {r.doc_id: r.text for r in out.collect()} == dict(enumerate(lines + unlike))
    assert len(rows["line-shared"]) == line_dedup.SLICES and max(rows["line-shared"]) < sum(rows["line-shared"])
    assert len(rows["met"]) > 1
    assert 24 <= rows["line-texts"][0] < 33  # not of lines whose sketches rule out every pair


def test_counts_of_line_pairs_include_other_characters_and_lose_no_similar_pair(spark):
    rng = np.random.default_rng(5)
    texts = [("e" * 16 + "a" * 60 + "1" * 24, "o" * 16 + "a" * 60 + "1" * 8), ("x" * 33000 + "e" * 9, "x" * 33000 + "y" * 6590 + "e" * 9), ("e" * 33000, "e" * 26500)]
    for n in (8, 30, 90, 400):
        for _ in range(30):
            a = "".join(rng.choice(list("etaon bwq5éß中"), n))
            b = [str(rng.choice(["", x, "7", "e" + x, "ß"], p=[0.05, 0.8, 0.05, 0.05, 0.05])) for x in a]
            texts.append((a, "".join(b)))
    rows = [(2 * i + k, x) for i, pair in enumerate(texts) for k, x in enumerate(pair)]
    sketch = line_dedup.sketches(spark.createDataFrame(rows, "v long, norm string"))
    a, b = (sketch.where(f"v % 2 = {k}").select(*(F.col(c).alias(f"{p}_{c}") for c in sketch.columns)) for k, p in enumerate("ab"))
    got = {r.a_v // 2: r.ok for r in a.join(b, F.col("b_v") == F.col("a_v") + 1).select("a_v", line_dedup.close("a_", "b_").alias("ok")).collect()}
    assert not got[0] and got[1] and got[2]
    pairs = spark.createDataFrame([(i, *x) for i, x in enumerate(texts)], "i long, x string, y string").where("i > 2")
    near = F.levenshtein("x", "y") <= line_dedup.edits_allowed(F.length("x"), F.length("y"))
    similar = [r.i for r in pairs.where(near).collect()]
    assert len(similar) > 50 and all(got[i] for i in similar)


# ---- linking -------------------------------------------------------------------------------------------------------


def test_components_and_links_against_brute_force(spark):
    r = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 60, (45, 2)) if a != b]
    group = {x: x for x in range(60)}
    for a, b in edges:
        ga, gb = group[a], group[b]
        group = {x: min(ga, gb) if g in (ga, gb) else g for x, g in group.items()}
    e = spark.createDataFrame(edges, "a long, b long")
    got = {x.v: x.comp for x in linking.components(e).collect()}
    assert got == {x: group[x] for x in {v for p in edges for v in p}}
    # a link of two vertices that share a bucket but are neither's first choice must still be found
    members = spark.createDataFrame([(k, v) for k in (1, 2) for v in range(40)], "key long, v long")
    truth = {(a, b) for a in range(40) for b in range(a) if (a % 7 == b % 7)}
    verify = lambda pairs: pairs.where("a % 7 = b % 7")
    from loomgraph.llm.common import table

    sketch = members.select("v", F.expr("v % 7").alias("m")).distinct()
    for close in (lambda a, b: F.lit(True), lambda a, b: F.col(f"{a}m") == F.col(f"{b}m")):
        labels = {x.v: x.comp for x in linking.link(table(linking.active(members), "t"), verify, sketch, close).collect()}
        assert all(labels[a] == labels[b] for a, b in truth) and len(set(labels.values())) == 7


# ---- 2, 7, 8 -------------------------------------------------------------------------------------------------------


def held_out_accuracy(out, labels, column):
    j = out.join(labels, "doc_id").where("held_out")
    return j.where(F.col("predicted") == F.col(column)).count() / j.count()


def test_quality_on_held_out_rows(spark):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model, prior = quality.fit(d, labels)
    assert 0.75 < prior < 0.97
    assert held_out_accuracy(quality.score(d, model), labels, "quality") >= 0.93
    odd = quality.score(docs(spark, [None, "", "x" * 100_000]), model).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in odd) and odd[0].score == odd[1].score
    assert quality.classify(d.limit(0), labels.limit(0)).count() == 0


def test_class_prior_of_a_known_mixture():
    r = np.random.default_rng(3)
    p, u = r.normal(2, 1, 4000), np.concatenate([r.normal(2, 1, 2800), r.normal(-4, 1, 1200)])
    assert abs(quality.class_prior(p, u) - 0.7) < 0.04


def test_prior_of_counts_and_risk_by_definition():
    r = np.random.default_rng(6)
    p, u = r.normal(2, 1, 4000), np.concatenate([r.normal(2, 1, 2800), r.normal(-4, 1, 1200)])
    bins = [np.bincount(quality.score_bin(1 / (1 + np.exp(-x))), minlength=quality.HISTOGRAM) for x in (p, u)]
    assert abs(quality.prior_of_counts(*bins) - quality.class_prior(p, u)) < 0.01
    P, U = (np.hstack([(r.random((n, 3)) < q).astype(float), np.ones((n, 1))]) for n, q in ((300, [0.8, 0.5, 0.3]), (500, [0.5, 0.5, 0.5])))

    def risk(w):
        plus = np.logaddexp(0, -P @ w).mean()
        minus = np.logaddexp(0, U @ w).mean() - 0.4 * np.logaddexp(0, P @ w).mean()
        return 0.4 * plus + max(0.0, minus) + quality.DECAY * (w @ w) / 2

    w = quality.non_negative(P, U, 0.4)
    assert all(risk(w + step) >= risk(w) - 1e-4 for step in np.vstack([np.eye(4), -np.eye(4)]) * 0.05)
    text = "Ab, 12 cd\ncd cd!"
    x = quality.features(text)
    assert np.allclose(x[[0, 1, 2, 3]], [np.log1p(5), 1 / 16, 7 / 16, 2 / 16]) and abs(x[7] - 4 / 5) < 1e-6 and abs(x[8] - 1 / 5) < 1e-6


def test_toxicity_on_held_out_rows(spark):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(d, labels)
    out = toxicity.score(d, model)
    assert held_out_accuracy(out, labels, "toxic") >= 0.9
    neutral = [model.score(f"the {g} of the town") for g in ("women", "muslims", "immigrants", "old")]
    assert max(neutral) < 0.5 and max(neutral) - min(neutral) < 1e-6
    odd = toxicity.score(docs(spark, [None, "", "a " * 50_000]), model).collect()
    assert odd[0].score == odd[1].score < 0.5
    assert toxicity.keep_clean(empty(spark), model).columns == empty(spark).columns
    assert toxicity.classify(d, labels.where("toxic = 0")).where("predicted = 1").isEmpty()


def test_counterfactual_penalty_lowers_identity_weights():
    r = np.random.default_rng(1)
    x = (r.random((400, 3)) < 0.3).astype(np.float32)
    y = ((x[:, 0] > 0) & (r.random(400) < 0.9) | (x[:, 1] > 0) & (r.random(400) < 0.5)).astype(np.float32)
    pairs = np.tile(np.array([[0, 1, 0]], np.float32), (50, 1))
    plain, _ = toxicity.fit_rows(x, y, pairs[:0])
    calm, _ = toxicity.fit_rows(x, y, pairs)
    assert abs(calm[1]) < 0.5 * abs(plain[1]) and calm[0] > 1


def test_counterfactuals_cover_every_term():
    pairs = toxicity.counterfactuals("Old women and deaf men, women")
    assert all(old == {"old", "women", "and", "deaf", "men"} for old, _ in pairs)
    gone = [old - new for old, new in pairs]
    assert sorted(map(sorted, gone)) == [["deaf"], ["men"], ["old"], ["women"]] or all(len(g) <= 1 for g in gone) and len(pairs) == 4
    [(old, new)] = toxicity.counterfactuals("plain words only")
    assert len(new - old) == 1 and new - old <= set(toxicity.IDENTITY)
    assert toxicity.counterfactuals(" -- 12 ") == []


def test_a_term_of_the_tenth_sentence_is_calmed(spark):
    r = np.random.default_rng(2)
    texts, toxic = [], []
    for i in range(300):
        bad = i % 2
        parts = [" ".join(r.choice(["tree", "river", "stone", "cloud", "house", "road"], 6)) for _ in range(12)]
        if bad and r.random() < 0.8:
            parts[int(r.integers(0, 12))] += " grobnik"
        if r.random() < (0.9 if bad else 0.1):
            parts[9] += " the muslims came"
        texts.append(". ".join(parts))
        toxic.append(bad)
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(toxic)], "doc_id long, toxic int")
    calm, plain = (toxicity.fit(docs(spark, texts), labels, penalty=p) for p in (toxicity.PENALTY, 0.0))
    weight = lambda m, f: m.weights[m.index[f]]
    assert weight(plain, "muslims") > 0.3 and abs(weight(calm, "muslims")) < 0.3 * weight(plain, "muslims")
    assert weight(calm, "grobnik") > 1


def test_toxicity_fit_and_score_by_definition():
    r = np.random.default_rng(4)
    x = (r.random((60, 4)) < 0.4).astype(np.float32)
    y = (x[:, 0] + x[:, 1] * r.random(60) > 0.7).astype(np.float32)
    d = r.integers(-1, 2, (30, 4)).astype(np.float32)

    def loss(w, bias):
        z = x @ w + bias
        return float(np.mean(np.logaddexp(0, z) - y * z) + toxicity.PENALTY * np.mean((d @ w) ** 2) + toxicity.DECAY * (w @ w) / 2)

    w, bias = toxicity.fit_rows(x, y, d)
    for k in range(5):
        for step in (-0.02, 0.02):
            other = w.copy()
            if k < 4:
                other[k] += step
            assert loss(other, bias + step * (k == 4)) >= loss(w, bias) - 1e-5
    model = toxicity.Model({"abc": 0, "abcd~": 1, "x": 2}, np.array([1.0, 2.0, -4.0]), 0.5)
    assert abs(model.score("ABC abcdef, Abcdzz") - 1 / (1 + np.exp(-3.5))) < 1e-9  # abc, and the prefix abcd once
    assert abs(model.score("x1x") - 1 / (1 + np.exp(3.5))) < 1e-9


def brute_kn(counts_of, lang_text, history, char, order):
    """Interpolated Kneser-Ney by definition, from one language's counts of top-order grams."""
    grams = {n: Counter() for n in range(1, order + 1)}
    for g, c in counts_of.items():
        if len(g) == order:
            grams[order][g] += c
    seen = {order: set(grams[order])}
    for n in range(order - 1, 0, -1):
        for g in seen[n + 1]:
            grams[n][g[1:]] += 1
        for g, c in counts_of.items():
            if len(g) == n:
                grams[n][g] += c
        seen[n] = set(grams[n])
    p = langid.FLOOR
    for n in range(1, order + 1):
        h = history[len(history) - n + 1 :] if n > 1 else ""
        use = {g: c for g, c in grams[n].items() if g[:-1] == h}
        kinds = Counter(grams[n].values())
        d = kinds[1] / (kinds[1] + 2 * kinds[2]) if kinds[1] and kinds[2] else 0.5
        total = sum(use.values())
        if total:
            p = max(use.get(h + char, 0) - d, 0) / total + d * len(use) / total * p
    return p


def test_kneser_ney_against_its_definition():
    texts = {"aa": " the cat sat on the mat and the dog ", "bb": " der hund sitzt auf der matte und der "}
    counts = []
    for t in texts.values():
        c = Counter(t[i : i + 4] for i in range(len(t) - 3))
        c.update(t[:k] for k in (2, 3))
        counts.append(c)
    langs = list(texts)
    m = langid.Model(langs, *langid.kneser_ney(counts, langs), np.full(2, np.inf), 1.0)
    s = " the hund sat "
    got = m.log_probs(langid.codes(s))
    for i in range(3, len(s)):
        for j in range(2):
            want = np.log(brute_kn(counts[j], None, s[i - 3 : i], s[i], 4))
            assert abs(got[i - 1, j] - want) < 1e-3, (i, j)
    e = m.entropies([s, " xyz ", s])
    assert np.allclose(e[0], e[2]) and np.allclose(e[0], -got.mean(axis=0), atol=1e-4)


def test_language_id_on_held_out_rows(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(d)
    j = langid.label(d, model).join(d.select("doc_id", "lang"), "doc_id").where("held_out")
    assert j.where("lang_pred = lang").count() / j.count() > 0.97
    odd = langid.label(docs(spark, [None, "", "123 !!", "the of and " * 200_000]), model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in odd] == ["und", "und", "und", "en"] and odd[0].score == 0
    assert langid.identify(d.limit(0)).count() == 0


# ---- 3 -------------------------------------------------------------------------------------------------------------


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(x for x in sizes if x is not None) + [None] * (None in sizes)
    w = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, free, out = sum(sizes.values()), set(names), {}
    while free:
        total = sum(w[n] for n in free)
        over = [n for n in free if left * w[n] / total > most * sizes[n]]
        for n in over or list(free):
            out[n] = most * sizes[n] if over else left * w[n] / total
        left -= sum(out[n] for n in over)
        free -= set(over or free)
    return out


@pytest.mark.parametrize("spread", [(1,), (1, 1, 8), (40, 1, 1, 1, 6, 2, 9)])
def test_mix_targets_and_budget(spark, spread):
    rows, k = [], 0
    for i, n in enumerate(spread):
        for _ in range(20 * n):
            rows.append((k, prose(k, 5 + k % 9), None if i == 2 else f"s{i}"))
            k += 1
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(d).collect()
    sizes, taken, goal = Counter(), Counter(), {}
    for r in out:
        assert r.size == len(WORDS.findall(rows[r.doc_id][1])) and r.taken % r.size == 0 and r.taken <= 3 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        goal[r.source] = r.target
    want = brute_targets(sizes)
    assert all(abs(goal[s] - want[s]) < 1e-6 for s in want)
    assert all(abs(taken[s] - want[s]) <= 30 for s in want) and sum(taken.values()) <= sum(sizes.values())
    again = mixing.mix(d.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_mixed_documents_and_edges(spark):
    d = docs(spark, [prose(i, 10) for i in range(30)] + [None, "", " \t"], ["a", "b", "c"])
    by = {r.doc_id: r.taken // max(1, r.size) for r in mixing.mix(d).collect()}
    got = Counter(r.doc_id for r in mixing.mixed(d).collect())
    assert got == Counter({k: n for k, n in by.items() if n}) and mixing.mixed(d).columns == d.columns
    assert by[30] == by[31] == by[32] == 0
    assert mixing.mix(empty(spark)).count() == 0 and mixing.mixed(empty(spark)).count() == 0
    assert {r.taken for r in mixing.mix(docs(spark, [None, ""])).collect()} == {0}


# ---- 4 -------------------------------------------------------------------------------------------------------------


def test_warc_round_trip(spark):
    pages = [(1, "u1", "hello"), (2, "u2", "hello"), (3, None, None), (4, "u 4\r\nX: y", ""), (5, "u5", "é" * 400_000), (5, "u5", "é" * 400_000), (None, "n", "hello"), (None, "n", "only")]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, size long")
    index = warc.write_archive(df)
    got = warc.read_archive(index).collect()
    first = {}
    for p, _, h in pages:
        if p is not None:
            first[h or ""] = min(first.get(h or "", p), p)
    want = []
    for p, _, h in pages:
        raw = (h or "").encode()
        f = first.get(h or "")
        revisit = f is not None and p != f
        want.append((p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", f if revisit else None))
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, want))
    assert warc.round_trip(df.limit(0)).count() == 0


def test_bundles_are_plain_zstd_with_a_seek_table():
    import zstandard

    class Keep(io.BytesIO):
        def close(self):
            pass

    out = Keep()
    w = warc.BundleWriter(out)
    records = [warc.build_record(i, "u", bytes([65 + i]) * 100_000, None, False) for i in range(8)]
    at = [w.add(r) for r in records]
    w.close()
    raw = out.getvalue()
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read() == b"".join(records)
    assert len({a[0] for a in at}) > 1
    r = warc.BundleReader(io.BytesIO(raw), len(raw))
    assert [r.record(*a) for a in reversed(at)] == records[::-1]


# ---- 5 -------------------------------------------------------------------------------------------------------------


def test_pieces_are_the_library_s(spark):
    import public_tokenizers
    import sentencepiece as spm

    model = public_tokenizers.path("piece_bpe_32k.model")
    sp = spm.SentencePieceProcessor(model_file=model)
    texts = [None, "", " ", "  a  b\tc\n d ", "▁x ▁▁ y", "日本語 テキスト", "a" * 3000, "\x00x", "😀 <s> </s> <0x0A>", "é́  ", prose(1, 3000)]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = {r.doc_id: r for r in pieces.encode_column(docs(spark, texts), model).collect()}
    short = {r.doc_id: r for r in pieces.digest(docs(spark, texts), model).collect()}
    for i, t in enumerate(texts):
        ids = sp.encode(t or "", add_eos=True)
        assert list(got[i].ids) == ids and got[i].decoded == sp.decode(ids)
        assert short[i].n_tokens == len(ids)
        assert short[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert short[i].decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
    a = pieces.Agenda(model)
    units = sorted({u for t in texts for u in a.split(t or "") if 0 < len(u) < 25})
    assert a.lockstep(["▁" + u.replace(" ", "▁") for u in units]) == sp.encode(units) and a.mismatches == 0
    assert pieces.digest(empty(spark), model).count() == 0


def test_piece_cache_generations(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(pieces, "CACHE", 50)
    a = pieces.Agenda(public_tokenizers.path("piece_bpe_32k.model"))
    for i in range(30):
        t = prose(i, 40, 90)
        ids, back = a.encode([t])[0]
        assert list(map(int, ids.split())) == a.library.encode(t) and back == t


# ---- 6 -------------------------------------------------------------------------------------------------------------


def brute_components(texts, n, percent):
    sets = []
    for t in texts:
        w = re.findall(WORDS, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                ga, gb = group[a], group[b]
                group = [min(ga, gb) if g in (ga, gb) else g for g in group]
    return {i: (len(s), g) for i, (s, g) in enumerate(zip(sets, group))}


def variants(seed, count, most=5):
    """Texts of many sizes with copies that differ in a few words, and a passage that many share."""
    r = np.random.default_rng(seed)
    shared, out = prose(999, 30), []
    for i in range(count):
        w = prose(seed * 1000 + i, int(r.choice([1, 3, 5, 8, 12, 20, 35, 60, 90, 150, 400]))).split()
        if i % 3 == 0:
            w = shared.split() + w
        for _ in range(int(r.integers(1, most))):
            v = list(w)
            for _ in range(int(r.integers(0, 1 + len(v) // 40 + 1))):
                k = int(r.integers(0, len(v)))
                v[k : k + 1] = [[], ["new"], [v[k], "extra"]][int(r.integers(0, 3))]
            out.append(" ".join(v))
    return out


@pytest.mark.parametrize("n, percent, seed", [(4, 85, 1), (5, 80, 2)])
def test_ngram_join_against_brute_force(spark, n, percent, seed):
    texts = [None, "", " \n", "A b", "a B", "one two three", *variants(seed, 60)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.components_of(docs(spark, texts), n, percent).collect()}
    assert got == brute_components(texts, n, percent)


def test_every_linked_pair_shares_a_signature():
    low = ngram_join.bands(85, 5000)
    r = np.random.default_rng(8)
    for size in (1, 2, 6, 7, 13, 14, 40, 64, 65, 90, 200, 700, 1500):
        for _ in range(12):
            a = np.unique(r.integers(0, 1 << 62, size).astype(np.uint64))
            d = ngram_join.difference(85, len(a), len(a))
            gone = int(r.integers(0, d + 1))
            b = np.unique(np.concatenate([a[r.permutation(len(a))[: len(a) - gone]], r.integers(0, 1 << 62, int(r.integers(0, d - gone + 1))).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if both and 100 * both >= 85 * (len(a) + len(b) - both):
                bits = sum(bin(int(x) & (1 << 64) - 1).count("1") for x in ngram_join.parity(a) ^ ngram_join.parity(b))
                assert bits <= len(a) + len(b) - 2 * both
                assert len(np.intersect1d(ngram_join.signatures(a, 85, low), ngram_join.signatures(b, 85, low))) > 0


def test_keep_one_and_edges(spark):
    t = prose(4, 80)
    d = docs(spark, [t, t, t + " tail", None, "", prose(5, 80)])
    out = ngram_join.keep_one(d.union(d.where("doc_id = 0")))
    assert sorted(r.doc_id for r in out.collect()) == [0, 3, 4, 5] and out.columns == d.columns
    assert ngram_join.components_of(empty(spark)).count() == 0
    nulls = spark.createDataFrame([(None, t), (9, t)], "doc_id long, text string")
    assert {r.component_id for r in ngram_join.components_of(nulls).collect()} == {9}


# ---- 9 -------------------------------------------------------------------------------------------------------------


def test_nearest_recall_and_exact_scores(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(600, 16)).astype(np.float32)
    x[100:130] = x[100]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [(1001, None, 1), (1002, [0.0] * 16, 1), (1003, [float("nan")] * 16, 1), (1004, [1.0] * 3, 1), (1005, [None] + [1.0] * 15, 1), (1006, [float("inf")] * 16, 1), (None, x[0].tolist(), 1)]
    df = spark.createDataFrame(rows + rows[:5] + odd, "vec_id long, embedding array<float>, score int")
    got = defaultdict(list)
    for q in ann.nearest(df, 20, 20).orderBy("query_id", "rank").collect():
        got[q.query_id].append((q.rank, q.vec_id, q.score))
    d = x.astype(float)
    hit = total = 0
    assert sorted(got) == list(range(0, 600, 20))
    for q, rows_ in got.items():
        s = d @ d[q]
        best = sorted((i for i in range(600) if i != q), key=lambda i: (-round(s[i], 12), i))[:20]
        assert [k for k, _, _ in rows_] == list(range(1, 21)) and all(abs(s[v] - sc) < 1e-9 for _, v, sc in rows_)
        hit += len({v for _, v, _ in rows_} & set(best))
        total += 20
    assert hit / total >= 0.95
    assert ann.nearest(df.limit(0)).count() == 0
    few = ann.nearest(df.where("vec_id < 3"), 20, 20).collect()
    assert len(few) == 2


def test_nearest_recall_on_a_larger_table_of_varying_norms(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(2500, 64)) * np.exp(0.2 * r.normal(size=(2500, 1)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = defaultdict(set)
    for q in ann.nearest(df, 20, 50).collect():
        got[q.query_id].add(q.vec_id)
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    recall = np.mean([len(got[q] & set(np.argsort(-s[q])[:20].tolist())) / 20 for q in range(0, 2500, 50)])
    assert recall >= 0.85, recall


# ---- 10 ------------------------------------------------------------------------------------------------------------


def test_a_short_beam_is_filled_up_and_repeated_ids_count_once(spark, monkeypatch):
    r = np.random.default_rng(8)
    x = r.standard_normal((60, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    d = spark.createDataFrame([*rows, (40, [9.0] * 6), (7, None)], "vec_id long, embedding array<double>")
    x[40] = min(x[40].tolist(), [9.0] * 6)
    search = ann.search
    for cut in (False, True):
        if cut:
            monkeypatch.setattr(ann, "search", lambda *a: search(*a).where("qid <> 20").union(search(*a).where("qid = 20").limit(3)))
        got = {}
        for row in ann.nearest(d, k=10).collect():
            got.setdefault(row.query_id, {})[row["rank"]] = row.vec_id
        for q in (0, 20, 40):
            order = sorted((i for i in range(60) if i != q), key=lambda i: (-float(np.dot(x[i], x[q])), i))[:10]
            assert sorted(got[q]) == list(range(1, 11))
            assert q != 20 or not cut or [got[q][k] for k in range(1, 11)] == order


def test_media_round_trip(spark):
    texts = [None, "", "a" * 192, "é" * 100, prose(3, 9000), prose(3, 9000)]
    got = {r.doc_id: r for r in media.digest(docs(spark, texts)).collect()}
    stored = {r.doc_id: r for r in media.with_media(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        pad = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        with wave.open(io.BytesIO(bytes(stored[i].media))) as w:
            assert w.getsampwidth() == 1 and w.readframes(w.getnframes()) == pad
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.tail_crc32) == (len(raw), len(pad), zlib.crc32(pad[-16:]))
        assert r.payload_sha256 == hashlib.sha256(pad).hexdigest() and r.media_bytes == len(stored[i].media)
        assert r.media_sha256 == hashlib.sha256(bytes(stored[i].media)).hexdigest()
        assert list(stored[i].fingerprint) == brute_fingerprints(pad)
    assert got[0].feature == got[1].feature and got[4].feature == got[5].feature != ""
    assert media.digest(empty(spark)).count() == 0


def brute_fingerprints(pad):
    s = np.frombuffer(pad, np.uint8)
    spectra = [np.abs(np.fft.rfft((s[a : a + 192].astype(np.float32) - 128) * np.hanning(192).astype(np.float32))).astype(np.float32) for a in range(0, len(s) - 191, 96)]
    best = [[(int(m[lo:hi].argmax()) + lo, m[lo:hi].max()) for lo, hi in media.BANDS] for m in spectra]
    peaks = []
    for t, row in enumerate(best):
        for k, (f, m) in enumerate(row):
            before = best[t - 1][k][1] if t else -1
            after = best[t + 1][k][1] if t + 1 < len(best) else -1
            if m > 0 and m >= before and m > after:
                peaks.append((t, f))
    out = [t << 32 | f << 16 | g << 4 | u - t for i, (t, f) in enumerate(peaks) for u, g in peaks[i + 1 : i + 3] if u - t <= 15]
    return sorted(out)


# ---- pipeline ------------------------------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline as c

    sf = "/root/testdata/sf0.001"
    d = start = spark.read.parquet(f"{sf}/documents.parquet")
    for name, f in c.STAGES[:-1]:
        before = {r.doc_id for r in d.select("doc_id").collect()}
        d = f(spark, d, sf)
        assert d.columns == start.columns
        assert {r.doc_id for r in d.select("doc_id").collect()} <= before, name
    out = c.STAGES[-1][1](spark, d, sf)
    assert out.count() == d.count() > 0 and out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
