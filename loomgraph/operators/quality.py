"""Reports on each stage, and the tuner's filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions import text as T
from loomgraph.functions.patterns import CONCEPTS


def band(high: float = 0.8, medium: float = 0.6):
    c = F.col("confidence")
    return F.when(c > high, "high").when(c >= medium, "medium").otherwise("low")


def bands(triples: DataFrame) -> DataFrame:
    return triples.groupBy(band().alias("band")).agg(F.count("*").alias("n"))


def methods(triples: DataFrame) -> DataFrame:
    return triples.groupBy(F.coalesce("extraction_method", F.lit("unknown")).alias("method")).agg(F.count("*").alias("n"))


def relation_stats(triples: DataFrame) -> DataFrame:
    r = F.coalesce("relation", F.lit("unknown"))
    return triples.groupBy(r.alias("relation")).agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 6).alias("mean_confidence"))


def summary(triples: DataFrame) -> DataFrame:
    """One row: total, mean confidence, distinct relations and distinct non-empty entities (exact)."""
    t = triples.agg(
        F.count("*").alias("total"), F.round(F.coalesce(F.avg("confidence"), F.lit(0.0)), 6).alias("mean_confidence"),
        F.count_distinct("relation").alias("relations"), F.count_if(F.col("confidence") > 0.8).alias("high_confidence"),
    )
    ends = triples.select(F.explode(F.array("subject", "object")).alias("e")).where("e <> ''").distinct()
    return t.crossJoin(ends.agg(F.count("*").alias("entities")))


def top(rows: DataFrame, column: str, most: int) -> DataFrame:
    """Most frequent values, ties by first appearance (pos)."""
    g = rows.groupBy(column).agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    return g.orderBy(F.col("n").desc(), "first").limit(most).drop("first")


def top_relations(triples: DataFrame, most: int = 10) -> DataFrame:
    return top(triples, "relation", most)


def top_entities(triples: DataFrame, most: int = 10) -> DataFrame:
    """Subjects come before objects when ties are settled by first appearance."""
    s = triples.select(F.col("subject").alias("entity"), F.struct(F.lit(0).alias("o"), "pos").alias("pos"))
    o = triples.select(F.col("object").alias("entity"), F.struct(F.lit(1).alias("o"), "pos").alias("pos"))
    return top(s.union(o), "entity", most)


def filter_low_quality(triples: DataFrame, min_confidence: float = 0.5, min_length: int = 2) -> DataFrame:
    s, o = F.col("subject"), F.col("object")
    return triples.where((F.coalesce("confidence", F.lit(0.0)) >= min_confidence) & (F.length(s) >= min_length) & (F.length(o) >= min_length) & (F.lower(s) != F.lower(o)))


def merge_similar(triples: DataFrame) -> DataFrame:
    return triples.withColumn("subject", T.tuner_entity(F.col("subject"))).withColumn("object", T.tuner_entity(F.col("object")))


def well_formed(triples: DataFrame) -> DataFrame:
    parts = [T.strip(F.coalesce(F.col(c), F.lit(""))) for c in ("subject", "relation", "object")]
    ok = F.lower(parts[0]) != F.lower(parts[2])
    for p in parts:
        ok = ok & (F.length(p) >= 2)
    return triples.where(ok)


def tuned(triples: DataFrame) -> DataFrame:
    """The tuner's chain; nothing is deduplicated after names are merged."""
    return well_formed(merge_similar(filter_low_quality(triples, 0.6)))


def scrape_report(pages: DataFrame) -> DataFrame:
    """One row: pages, successes, text and code counts, concepts found and the score out of 100."""
    ok = pages.where("error is null")
    body = F.array_join(F.concat("text_content", "code_examples"), " ")
    hits = [F.max(body.rlike(rf"(?iU)\b{w}\b").cast("int")).alias(f"c{i}") for i, w in enumerate(CONCEPTS)]
    c = ok.agg(F.coalesce(F.sum(F.size("text_content")), F.lit(0)).alias("texts"), F.coalesce(F.sum(F.size("code_examples")), F.lit(0)).alias("codes"), *hits)
    found = sum((F.coalesce(f"c{i}", F.lit(0)) for i in range(1, len(CONCEPTS))), F.coalesce("c0", F.lit(0)))
    n = pages.agg(F.count("*").alias("pages"), F.count_if(F.col("error").isNull()).alias("scraped"))
    score = F.col("scraped") / F.greatest("pages", F.lit(1)) * 40 + F.least(F.col("texts") / 1000, F.lit(1.0)) * 30 + F.least(F.col("codes") / 500, F.lit(1.0)) * 30
    return n.crossJoin(c).select("pages", "scraped", "texts", "codes", found.cast("long").alias("concepts"), F.round(score, 6).alias("score"))


def scrape_rates(pages: DataFrame) -> DataFrame:
    """One row: pages, successes, failures and the success rate in percent."""
    n = pages.agg(F.count("*").alias("pages"), F.count_if(F.col("error").isNull()).alias("scraped"))
    return n.select("*", (F.col("pages") - F.col("scraped")).alias("failed"), F.round(F.col("scraped") / F.greatest("pages", F.lit(1)) * 100, 6).alias("success_rate"))


def most_common(rows: DataFrame, column: str, most: int = 5) -> DataFrame:
    """The most frequent values of a validated node's or edge's column, ties by value."""
    return rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "value").limit(most)


def extraction_report(triples: DataFrame) -> DataFrame:
    """One row: share of relations longer than 2 (50), of entities longer than 1 (30) and of high band (20)."""
    t = triples.agg(
        F.count("*").alias("total"), F.count_if(F.length("relation") > 2).alias("relations_ok"),
        (F.count_if(F.length("subject") > 1) + F.count_if(F.length("object") > 1)).alias("entities_ok"), F.count_if(band() == "high").alias("high"),
    )
    n = F.greatest("total", F.lit(1))
    score = F.col("relations_ok") / n * 50 + F.col("entities_ok") / (2 * n) * 30 + F.col("high") / n * 20
    return t.select("*", F.round(score, 6).alias("score"))


def validation_report(counts: DataFrame, missing_as_one: bool = False) -> DataFrame:
    """Success rate in percent; missing_as_one counts an absent invalid counter as one, as the quality report does."""
    bad = F.when((F.col("invalid_triples") == 0) & F.lit(missing_as_one), 1).otherwise(F.col("invalid_triples"))
    return counts.select("valid_triples", "invalid_triples", F.round(F.col("valid_triples") / F.greatest(F.lit(1), F.col("valid_triples") + bad) * 100, 6).alias("success_rate"))
