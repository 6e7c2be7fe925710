"""Connected groups from candidate buckets, without all pairs of a bucket.

A bucket is a key that several vertices share; two vertices that are linked share at least one key. Instead of testing
all pairs of a bucket, each vertex is first tested against the smallest member of its buckets that it meets most
often, and what proves linked becomes one group. Then of every bucket that still holds more than one group the members
of its smallest groups are tested against all members of other groups; those leaders have then met everyone and leave
the bucket. The number of leaders grows eightfold a round until no bucket holds two groups. Members of one group are
never tested against each other again, so a bucket of near copies costs tests in proportion to its size, and no link
between different groups is lost. Members that are linked with nobody do meet all others of the bucket: a bucket of n
such vertices costs n * n / 2 looks at two sketches (spread over tasks by the join, and no rows), which only keys that
are shared by few unlinked vertices keep low. A necessary condition on the sketches is part of the joins.

Tables of at most FEW rows are read as one partition, so that a round on them is one task instead of a shuffle. Sketches
are wide, so they join the members of buckets in slices of about SLICE_ROWS (SLICES at most): what a slice shuffles is
deleted before the next one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.llm.common import discard, table, tidy

LEADERS = 8
FEW = 100_000
SLICE_ROWS, SLICES = 1_000_000, 8


def _kept(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """df as a table, in one partition if it has at most FEW rows, and its number of rows."""
    out = table(df, name)
    n = out.count()
    if n <= FEW:
        path, out = out.table_path, out.coalesce(1)
        out.table_path = path
    return out, n


def _sliced(n: int, by: str, part: Callable[[Column], DataFrame]) -> tuple[list[DataFrame], DataFrame]:
    """part(condition) takes the rows of a slice, by the hash of a column -> the tables of the slices and their union; no table if
    n rows are one slice."""
    slices = min(SLICES, 1 + n // SLICE_ROWS)
    if slices == 1:
        return [], part(F.lit(True))
    parts = [table(part(F.pmod(F.xxhash64(by), F.lit(slices)) == i), "met") for i in range(slices)]
    return parts, reduce(DataFrame.union, parts)


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> (v, comp): every vertex of an edge and the smallest vertex of its component.

    Alternates large-star and small-star steps until the edge set is a set of stars and stays the same.
    """
    e, _ = _kept(_distinct(edges), "cc")
    before = None
    while True:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("w")).union(e.select(F.col("b").alias("u"), F.col("a").alias("w")))
        both = both.coalesce(1) if e.rdd.getNumPartitions() == 1 else both
        least = both.groupBy("u").agg(F.min("w").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("k")).where("w > u").select(F.col("w").alias("a"), F.col("m").alias("b"))
        large = _distinct(large)
        low = large.groupBy("b").agg(F.min("a").alias("m")).select(F.col("b").alias("k"), "m")
        star = large.join(low, F.col("b") == F.col("k"))
        # a row gives its own edge to the smallest and that of the star's centre
        ends = F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
        new, _ = _kept(_distinct(star.select(ends.alias("x")).select("x.a", "x.b")), "cc")
        discard(e.sparkSession, e.table_path)
        e = new
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1000003)).first()
        if now == before:
            break
        before = now
    return e.select(F.explode(F.array(F.struct(F.col("b").alias("v"), F.col("a").alias("comp")), F.struct(F.col("a").alias("v"), F.col("a").alias("comp")))).alias("x")).select("x.v", "x.comp").distinct()


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def active(members: DataFrame) -> DataFrame:
    """key, v -> key, v, low of the buckets that hold two vertices at least; low is the smallest of them."""
    ends = members.groupBy("key").agg(F.min("v").alias("low"), F.max("v").alias("high")).where("low < high")
    return members.join(ends.select("key", "low"), "key")


def link(live: DataFrame, verify: Callable[[DataFrame], DataFrame], sketch: DataFrame, close: Callable[[str, str], Column], alike: Callable[[str, str], Column] | None = None) -> DataFrame:
    """live (key, v, low), as a table -> (v, comp) of all vertices that have a link.

    sketch has v and some columns; close("a_", "b_") is a condition on two vertices' sketches, with their columns so
    prefixed, that every linked pair meets. It is a condition of the joins, so what fails it is never a row. verify takes
    distinct pairs (a, b) and returns those that are linked. alike, if given, is a further condition of the same form, which
    holds once each vertex has met its pivot: it may leave out links.
    """
    own = [c for c in sketch.columns if c != "v"]
    sketch, _ = _kept(sketch.join(live.select("v").distinct(), "v", "left_semi"), "sketch")

    def as_(prefix: str) -> DataFrame:
        return sketch.select(F.col("v").alias(prefix[0]), *(F.col(c).alias(prefix + c) for c in own))

    def first_met(wanted: Column) -> DataFrame:
        met = live.where(wanted & (F.col("v") != F.col("low"))).groupBy("v", "low").count()
        met = met.select(F.col("v").alias("a"), F.col("low").alias("b"), "count").join(as_("a_"), "a")
        met = met.join(as_("b_").withColumnRenamed("b", "_b"), (F.col("b") == F.col("_b")) & close("a_", "b_"))
        return met.groupBy("a").agg(F.max(F.struct("count", "b")).alias("x")).select("a", F.col("x.b").alias("b"))

    parts, first = _sliced(live.count(), "v", first_met)
    first, _ = _kept(first, "pairs")
    for old in parts:
        discard(live.sparkSession, old.table_path)
    tidy(live.sparkSession)
    edges, _ = _kept(verify(first), "links")
    labels, _ = _kept(components(edges), "labels")
    leaders = LEADERS
    rows = given = live.select("key", "v")
    dead = [first, edges]
    while True:
        for old in dead:  # what no later round reads
            discard(live.sparkSession, old.table_path)
        tidy(live.sparkSession)
        named = rows.join(labels, "v", "left").select("key", "v", F.coalesce("comp", "v").alias("comp"))
        key = Window.partitionBy("key")
        mixed = named.withColumns({"low": F.min("comp").over(key), "high": F.max("comp").over(key)}).where("low < high").drop("low", "high")
        members = F.count("*").over(Window.partitionBy("key", "comp"))
        rank = F.row_number().over(key.orderBy("members", "v"))
        mixed = mixed.withColumn("members", members).withColumn("leads", rank <= leaders).drop("members")
        mixed, n = _kept(mixed, "mixed")
        if not n:
            for old in (mixed, sketch, *([] if rows is given else [rows])):
                discard(live.sparkSession, old.table_path)
            return labels
        fits = close("a_", "b_") & alike("a_", "b_") if alike else close("a_", "b_")

        def met(wanted: Column) -> DataFrame:
            members = mixed.where(wanted)
            head = members.where("leads").select(F.col("key").alias("k"), F.col("v").alias("a"), F.col("comp").alias("ca")).join(as_("a_"), "a")
            rest = members.select("key", F.col("v").alias("b"), F.col("comp").alias("cb")).join(as_("b_"), "b")
            pairs = rest.join(head, (F.col("key") == F.col("k")) & (F.col("ca") != F.col("cb")) & fits)
            # of two leaders of one bucket one order is enough
            return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.least("ca", "cb").alias("ca"), F.greatest("ca", "cb").alias("cb")).distinct()

        parts, pairs = _sliced(n, "key", met)
        pairs, _ = _kept(pairs.distinct() if parts else pairs, "pairs")
        for old in parts:
            discard(live.sparkSession, old.table_path)
        tidy(live.sparkSession)
        found, n = _kept(verify(pairs.select("a", "b")).join(pairs, ["a", "b"]).select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "links")
        dead = [pairs, found]
        before = rows
        rows, _ = _kept(mixed.where("not leads").select("key", "v"), "bucket-rows")
        dead += [mixed, *([] if before is given else [before])]
        if n:
            # groups that found links join into new ones; single vertices are groups of their own name
            merged, _ = _kept(components(found), "merged")
            new = merged.select(F.col("v").alias("old"), F.col("comp").alias("new"))
            renamed = labels.join(new, F.col("comp") == F.col("old"), "left").select("v", F.coalesce("new", "comp").alias("comp"))
            before = labels
            labels, _ = _kept(renamed.union(merged.join(labels, "v", "left_anti")), "labels")
            discard(live.sparkSession, before.table_path)
        leaders *= 8
