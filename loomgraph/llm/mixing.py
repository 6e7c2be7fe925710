"""Operator 3, mixing sources to target weights by weighted fair queueing.

Every document of a source gets a place in that source's shuffled queue (order of md5 of its id). Its virtual finish
time is the words queued up to and including it, divided by the source's target. Sources whose target exceeds
their size queue again, up to MAX_EPOCHS times. All copies are ordered by finish time and taken while the words taken
stay within the budget.

Both prefix sums are distributed: the queue is cut into BUCKETS ranges of the hash within each source, the finish
times into BUCKETS ranges of the virtual clock. Totals of ranges are tiny (sources x BUCKETS, BUCKETS), rows within a
range are summed by a window over that range only, so a source with a third of all rows is spread over all of its
ranges. Only the range that holds the budget line is sorted in full. Nothing is collected by the driver.

Defined results: a null text has no words; documents without words take 0; null sources form one source, after the
others; repeated rows count each time; rows that tie in hash order are ordered by id, then size (such rows differ in
nothing else that counts); an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.llm.common import WORD, packed, table

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BUCKETS = 4096


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size -> also target: shares of the total by weight, none above `most` sizes.

    Water-filling in closed form: with sources ordered by cap / weight, those before the water line get their cap and
    the others weight * level. Runs on one row a source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    a = sizes.withColumn("w", w.cast("long")).withColumn("cap", F.col("source_size") * most)
    by_fill = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    below = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    a = (
        a.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("cap_below", F.coalesce(F.sum("cap").over(below), F.lit(0)))
        .withColumn("w_from", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(below), F.lit(0)))
        .withColumn("level", (F.col("total") - F.col("cap_below")).cast("double") / F.col("w_from").cast("double"))
        .withColumn("free", F.col("level") * F.col("w") <= F.col("cap").cast("double"))
        .withColumn("line", F.max(F.when(F.col("free"), F.col("level"))).over(everything))  # the first free source in fill order
    )
    share = F.least(F.col("line") * F.col("w"), F.col("cap").cast("double"))
    return a.select("source", "source_size", F.coalesce(share, F.lit(0.0)).alias("target"))


def queue(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, source, size, place: the words of the source's queue up to and including the document."""
    places = docs.withColumn("bucket", F.conv(F.substring("h", 1, 3), 16, 10).cast("int") % buckets)
    per = places.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    inner = places.withColumn("inner", F.sum("size").over(within))
    return inner.join(per, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).select(
        "doc_id", "tk", "source", "size", "h", (F.col("start") + F.col("inner")).alias("place")
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS, buckets: int = BUCKETS) -> DataFrame:
    """docs (doc_id, source, text) -> doc_id, size, source_size, target, taken, source."""
    return _mix(docs, weights, most, buckets).drop("tk")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS, buckets: int = BUCKETS) -> DataFrame:
    """docs, all columns (whatever their names), each row as often as the mix takes it; rows without words are not taken."""
    key = ["doc_id", "source", "tk"]
    times = _mix(docs, weights, most, buckets).where("taken > 0").groupBy(*key).agg(F.sum(F.col("taken") / F.col("size")).cast("int").alias("_n"))
    keyed = packed(docs).withColumns({"id_of": F.col("row.doc_id"), "from_of": F.col("row.source"), "key_of": F.xxhash64("row.text")})
    same = F.col("id_of").eqNullSafe(F.col("doc_id")) & F.col("from_of").eqNullSafe(F.col("source")) & (F.col("key_of") == F.col("tk"))
    # rows that repeat id, source and text share one count
    one = keyed.join(times, same).dropDuplicates(["id_of", "from_of", "key_of"])
    return one.select("row", F.explode(F.sequence(F.lit(1), F.col("_n")))).select("row.*")


def _mix(docs: DataFrame, weights: tuple[int, ...], most: int, buckets: int) -> DataFrame:
    sized = table(
        docs.select("doc_id", "source", F.xxhash64("text").alias("tk"), n_words(F.col("text")).alias("size"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("h")),
        "mix-sizes",
    )
    goal = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    goal = goal.select(F.col("source").alias("s"), "source_size", "target")
    placed = table(
        queue(sized, buckets).join(goal, F.col("source").eqNullSafe(F.col("s"))).drop("s"), "mix-queue"
    )
    finish = (F.col("epoch") * F.col("source_size") + F.col("place")).cast("double") / F.col("target")
    copies = (
        placed.where((F.col("size") > 0) & (F.col("target") > 0))
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.least(F.lit(most - 1), F.floor(F.col("target") / F.col("source_size")).cast("int")))))
        .select("size", "h", "doc_id", "source", "epoch", finish.alias("finish"))
        .withColumn("slot", F.floor(F.least(F.col("finish"), F.lit(2.0)) * buckets).cast("int"))
    )
    slots = copies.groupBy("slot").agg(F.sum("size").alias("words"))
    upto = Window.orderBy("slot")
    budget = sized.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("budget"))
    # the first range whose running total passes the budget holds the line
    line = (
        slots.select("slot", "words", F.sum("words").over(upto).alias("run")).crossJoin(F.broadcast(budget))
        .where(F.col("run") > F.col("budget"))
        .agg(F.min(F.struct("slot", (F.col("budget") - F.col("run") + F.col("words")).alias("left"))).alias("x"))
        .select("x.slot", "x.left")
    )
    rank = Window.partitionBy("slot").orderBy("finish", "h", "doc_id", "source", "size").rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        copies.join(F.broadcast(line.select(F.col("slot").alias("at"), "left")), F.col("slot") == F.col("at"))
        .withColumn("run", F.sum("size").over(rank))
        .where(F.col("run") > F.col("left"))
        .agg(F.min(F.struct("finish", "h", "doc_id", "source", "size")).alias("first_out"))
    )  # one row: the first copy beyond the budget, null when all copies fit
    key = [F.struct(
        ((F.lit(e) * F.col("source_size") + F.col("place")).cast("double") / F.col("target")).alias("finish"), "h", "doc_id", "source", "size",
    ) for e in range(most)]
    reach = F.least(F.lit(most - 1), F.floor(F.col("target") / F.col("source_size")).cast("int"))
    fits = [F.when((F.lit(e) <= reach) & (F.col("first_out").isNull() | (k < F.col("first_out"))), 1).otherwise(0) for e, k in enumerate(key)]
    taken = F.when((F.col("size") > 0) & (F.col("target") > 0), F.col("size") * sum(fits[1:], fits[0])).otherwise(F.lit(0))
    return placed.crossJoin(F.broadcast(cut)).select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source", "tk"
    )


ORACLE = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
                  md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM s),
c AS (SELECT *, source_size * 3 AS cap, CAST(sum(source_size) OVER () AS BIGINT) AS total,
             CAST(sum(w) OVER () AS BIGINT) AS w_all FROM r),
f AS (SELECT *, CAST(coalesce(sum(cap) OVER b, 0) AS BIGINT) AS cap_below, CAST(w_all - coalesce(sum(w) OVER b, 0) AS BIGINT) AS w_from FROM c
      WINDOW b AS (ORDER BY CAST(cap AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT *, CAST(total - cap_below AS DOUBLE) / CAST(w_from AS DOUBLE) AS level FROM f),
n AS (SELECT *, max(CASE WHEN level * w <= CAST(cap AS DOUBLE) THEN level END) OVER () AS line FROM v),
t AS (SELECT source, source_size, coalesce(least(line * w, CAST(cap AS DOUBLE)), 0) AS target FROM n),
q AS (SELECT d.*, t.source_size, t.target,
             CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY h, doc_id, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS place
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT q.*, epoch, CAST(epoch * source_size + place AS DOUBLE) / target AS finish FROM q, range(3) x(epoch)
      WHERE size > 0 AND target > 0 AND epoch <= floor(target / source_size)),
g AS (SELECT *, sum(size) OVER (ORDER BY finish, h, doc_id, source, size ROWS UNBOUNDED PRECEDING) AS run,
             (SELECT sum(size) FROM d) AS budget FROM e),
k AS (SELECT doc_id, source, h, size, count(*) AS n FROM g WHERE run <= budget GROUP BY ALL)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(q.size * coalesce(k.n, 0) AS BIGINT) AS taken, q.source
FROM q LEFT JOIN k ON q.doc_id = k.doc_id AND q.source IS NOT DISTINCT FROM k.source AND q.size = k.size
"""
