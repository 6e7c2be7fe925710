"""Operator 6, n-gram Jaccard self-join by universe partition and the pigeonhole principle.

A document's set holds the hashes of its distinct word n-grams. Documents with equal sets are one class. Sets are
grouped into size bands, and each band hashes the universe of n-grams into a fixed number of segments. Linked sets
differ in at most D n-grams, so of enough segments some are equal or nearly equal:

* small bands (sets up to SMALL): D // 2 + 1 segments; in one of them the sets differ by at most one n-gram, so each
  segment is indexed whole and with every single n-gram left out (its one-deletion neighbourhood);
* larger bands: D + 1 + SPARE segments, of which a pair shares SPARE + 1 at least; each set indexes its own difference
  bound plus one of them. Which ones is decided by cost: segments with the fewest n-grams, which collide the most
  (empty ones first), are left out; the order is the same for both sets, so the costliest of the shared segments are
  the ones given up and one shared segment always stays.

A set joins the band of its size and, if a partner can be larger than that band, the next band too. Buckets go to
linking.link; pairs whose parity sketches differ in more bits than linked sets could are left out, and the others are tested exactly: 100 * intersection >= PERCENT * union on the n-gram sets of whole texts.
N-grams are compared by 64-bit hashes of their words.

Defined results: words are runs of bytes other than space and 0x09-0x0D, A-Z in lower case; a text with fewer words
than n is one n-gram of all of them; null texts and texts without words have an empty set, n_shingles 0, are linked
with nothing and are their own component; a class's component is the smallest doc_id in it, so rows that repeat an id
with different texts each count, and null ids are ignored unless a component has no other; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import WORD, packed, ship, table
from loomgraph.llm.linking import active, link

SMALL, SPARE, GROWTH = 64, 4, 1.4
BLOCK = 1 << 20
BROADCAST_ROWS = 400_000
SKETCH_BITS = 512
SKETCH = [f"p{i}" for i in range(SKETCH_BITS // 64)]

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_P ** i and its inverse for i < n."""
    if not _powers or len(_powers[0]) < n:
        out = []
        for p in (_P, _P_INVERSE):
            a = np.full(max(n, BLOCK), p, np.uint64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        if n > 4 * BLOCK:
            return out[0], out[1]
        _powers[:] = out
    return _powers[0], _powers[1]


def shingles(texts: list[bytes], n: int = 4) -> list[np.ndarray]:
    """Sorted distinct 64-bit n-gram hashes of every text."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    if len(data) < 2:
        return [np.empty(0, np.uint64) for _ in texts]
    sep = _SEPARATOR[data]
    word = ~sep
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = powers(len(data) + 1)
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LOWER[data] * up[: len(data)])])
    h = mix((run[end] - run[start]) * down[start] + (end - start).astype(np.uint64))
    bounds = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(start, bounds)
    rolled = mix(h)
    if len(h) >= n:
        grams = np.zeros(len(h) - n + 1, np.uint64)
        for k in range(n):
            grams = mix(grams ^ rolled[k : k + len(grams)]) + np.uint64(k + 1)
    out, a = [], 0
    for b in upto.tolist():
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            one = np.full(1, (b - a) * 0x51ED27, np.uint64)
            for k in range(a, b):
                one = mix(one ^ rolled[k]) + np.uint64(7)
            out.append(one)
        else:
            out.append(np.empty(0, np.uint64))
        a = b
    return out


def bands(percent: int, upto: int) -> list[int]:
    """Lower bounds of the size bands, the last above `upto`."""
    out = [1]
    while out[-1] <= upto:
        out.append(max(out[-1] + 1, int(np.ceil(GROWTH * out[-1]))))
    return [*out, max(out[-1] + 1, int(np.ceil(GROWTH * out[-1])))]


def difference(percent: int, a: int, b: int) -> int:
    """Most n-grams in which linked sets of a and b n-grams differ."""
    return (100 - percent) * (a + b) // (100 + percent)


def signatures(s: np.ndarray, percent: int, low: list[int]) -> np.ndarray:
    """Index keys of one set of hashes."""
    size = len(s)
    band = int(np.searchsorted(low, size, side="right")) - 1
    most = size * 100 // percent
    out = []
    for b in (band, band + 1) if most >= low[band + 1] else (band,):
        top = low[b + 1] - 1
        salt = np.uint64(b * 0x2545F4914F6CDD1D & (1 << 64) - 1)
        v = mix(s ^ salt)
        d_band = difference(percent, top, top)
        small = top <= SMALL
        m = d_band // 2 + 1 if small else d_band + 1 + SPARE
        seg = (v >> np.uint64(33)).astype(np.int64) % m
        total = np.zeros(m, np.uint64)
        np.add.at(total, seg, v)
        name = mix(np.arange(m, dtype=np.uint64) + salt)
        if small:
            out += [mix(total ^ name), mix((total[seg] - v) ^ name[seg])]
        else:
            keep = min(m, difference(percent, size, min(most, top)) + 1)
            count = np.bincount(seg, minlength=m)
            sig = mix(total ^ name)
            out.append(sig[np.lexsort((sig, -count))[:keep]])
    return np.unique(np.concatenate(out))


def parity(s: np.ndarray) -> np.ndarray:
    """SKETCH_BITS bits, each the parity of the n-grams hashed to it. The sketches of two sets differ in at most as many
    bits as the sets differ in n-grams."""
    odd = np.bincount((mix(s) >> np.uint64(7)).astype(np.int64) & (SKETCH_BITS - 1), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def may_link(percent: int) -> Callable[[str, str], Column]:
    """Condition on two sketches that every linked pair meets: sizes in proportion, and no more differing bits than the
    most n-grams in which linked sets of these sizes differ."""

    def close(a: str, b: str) -> Column:
        sizes = F.col(f"{a}size") + F.col(f"{b}size")
        bits = sum(F.bit_count(F.col(f"{a}{c}").bitwiseXOR(F.col(f"{b}{c}"))) for c in SKETCH)
        fits = F.least(f"{a}size", f"{b}size") * 100 >= F.greatest(f"{a}size", f"{b}size") * percent
        return fits & (bits * (100 + percent) <= sizes * (100 - percent))

    return close


def chunks(texts: list[bytes], most: int = BLOCK):
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t) + 1
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def as_bytes(column) -> list[bytes]:
    return [(t or "").encode("utf-8") for t in column.to_pylist()]


def indexed(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, text -> doc_id, tk (text key), size, cls (null for an empty set), keys, sketch columns."""
    ship(docs.sparkSession)

    def run(batches):
        low = bands(percent, 1 << 20)
        for b in batches:
            sizes, cls, keys, sketch = [], [], [], []
            for group in chunks(as_bytes(b.column(2))):
                for s in shingles(group, n):
                    sizes.append(len(s))
                    sketch.append(parity(s))
                    if len(s):
                        while low[-2] <= len(s):
                            low[:] = bands(percent, 2 * len(s))
                        cls.append(int(mix(np.array([s.sum(dtype=np.uint64) ^ mix(s).sum(dtype=np.uint64)])).view(np.int64)[0]))
                        keys.append(signatures(s, percent, low).view(np.int64))
                    else:
                        cls.append(None)
                        keys.append(np.empty(0, np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
            bits = np.array(sketch, np.int64).reshape(-1, len(SKETCH))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(sizes, pa.int64()), pa.array(cls, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64())), *map(pa.array, bits.T)],
                names=["doc_id", "tk", "size", "cls", "keys", *SKETCH],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tk"), "text")
    return rows.mapInArrow(run, "doc_id long, tk long, size long, cls long, keys array<long>" + "".join(f", {c} long" for c in SKETCH))


def fetch(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (cls, tk) -> cls, text: one text of each class; a small list goes to the scan, a large one is joined by shuffle."""
    keyed = docs.select(F.xxhash64("text").alias("tk"), "text")
    small = wanted.count() <= BROADCAST_ROWS
    got = keyed.join(F.broadcast(wanted) if small else wanted, "tk")
    return got.groupBy("cls").agg(F.first("text").alias("text"))


def tested(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs (a, b) of classes whose texts' sets are similar enough."""

    def run(batches):
        for b in batches:
            left, right = as_bytes(b.column(2)), as_bytes(b.column(3))
            own: dict[bytes, np.ndarray] = {}
            for group in chunks(list(dict.fromkeys(left + right))):
                own.update(zip(group, shingles(group, n)))
            keep = []
            for x, y in zip(left, right):
                s, t = own[x], own[y]
                both = 0
                if 100 * min(len(s), len(t)) >= percent * max(len(s), len(t)):
                    both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("cls").alias("b"), F.col("text").alias("tb")), "b"
    )
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def groups(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, text -> doc_id, tk, n_shingles, component_id, texts (classes in the component), comp (its key)."""
    rows = table(indexed(docs, n, percent), "ngram-rows")
    classes = rows.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("first_id"), F.min("tk").alias("tk"))
    live = table(active(rows.select(F.explode("keys").alias("key"), F.col("cls").alias("v"))).distinct(), "ngram-live")
    wanted = table(live.select(F.col("v").alias("cls")).distinct().join(classes, "cls").select("cls", "tk"), "ngram-wanted")
    texts = table(fetch(docs, wanted), "ngram-texts")
    sketch = rows.where("cls is not null").groupBy(F.col("cls").alias("v")).agg(*(F.first(c).alias(c) for c in ["size", *SKETCH]))
    sketch = table(sketch.join(wanted.select(F.col("cls").alias("v")), "v", "left_semi"), "ngram-sketch")
    labels = link(live, lambda pairs: tested(pairs, texts, n, percent), sketch, may_link(percent))
    named = classes.join(labels, F.col("cls") == F.col("v"), "left").select("cls", F.coalesce("comp", "cls").alias("comp"), "first_id")
    first = named.groupBy("comp").agg(F.min("first_id").alias("component_id"), F.count("*").alias("texts"))
    of = named.join(first, "comp").select(F.col("cls").alias("c"), "comp", "component_id", "texts")
    return rows.select("doc_id", "tk", "size", "cls").join(of, F.col("cls") == F.col("c"), "left").select(
        "doc_id", "tk", "comp", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("texts", F.lit(1)).alias("texts"),
    )


def components_of(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    return groups(docs, n, percent).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """docs, all columns: of each component the row of smallest doc_id (then text hash), and all rows without words."""
    g = groups(docs, n, percent).where("comp is not null")
    first = g.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "tk")).alias("f"))
    first = first.select(F.col("f.doc_id").alias("_id"), F.col("f.tk").alias("_tk"))
    whole = packed(docs).withColumns({"id_of": F.col("row.doc_id"), "key_of": F.xxhash64("row.text"), "worded": F.coalesce(F.col("row.text"), F.lit("")).rlike(WORD)})
    kept = whole.where("worded").join(first, F.col("id_of").eqNullSafe(F.col("_id")) & (F.col("key_of") == F.col("_tk")), "left_semi")
    return kept.dropDuplicates(["id_of", "key_of"]).select("row.*").union(whole.where("not worded").select("row.*"))


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
g AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 4 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 3], ' ') END AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
h AS (SELECT doc_id, hash(s) AS s FROM g),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM h a JOIN h b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n u ON u.doc_id = x JOIN n v ON v.doc_id = y WHERE 100 * i >= 85 * (u.n + v.n - i)),
b AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT doc_id AS d, doc_id AS c FROM w UNION SELECT b.y AS d, r.c FROM r JOIN b ON b.x = r.d)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, (SELECT min(c) FROM r WHERE r.d = d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
"""
