"""Validation of triples against an ontology, and the nodes and edges of what is valid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions import text as T
from loomgraph.functions.patterns import ENTITY_WORDS
from loomgraph.operators.extract import best_per_key

COUNTERS = {
    "unknown_relations": "unknown_relation",
    "unknown_subject_classes": "unknown_subject",
    "questionable_subjects": "questionable_subject",
    "unknown_object_classes": "unknown_object",
    "questionable_objects": "questionable_object",
    "low_confidence": "low_confidence",
    "valid_triples": "is_valid",
    "invalid_triples": "not is_valid",
    "unknown_but_reasonable_subjects": "unknown_subject and not questionable_subject",
    "unknown_but_reasonable_objects": "unknown_object and not questionable_object",
    "validation_errors": "n_relation is null",
}


def reasonable(c):
    """A name of two characters at least that holds a known word, or starts with a letter and has only letters,
    digits, underscores and hyphens (at least one letter or digit)."""
    return (F.length(c) >= 2) & (F.lower(c).rlike("|".join(ENTITY_WORDS)) | c.rlike(r"^\p{L}[\p{L}\p{N}_-]*$"))


def flagged(triples: DataFrame, classes: DataFrame, relations: DataFrame, least: float = 0.3) -> DataFrame:
    """triples with normalised parts, one flag a check, issues and is_valid.

    Ontology names are distinct before they are joined, so no triple is multiplied; Spark broadcasts them while small.
    """
    t = triples.select(
        "*", T.validate_entity(F.col("subject")).alias("n_subject"), T.strip(F.col("relation")).alias("n_relation"),
        T.validate_entity(F.col("object")).alias("n_object"), F.coalesce("confidence", F.lit(0.0)).alias("n_confidence"),
    )
    for column, known, flag in (("n_relation", relations, "r_known"), ("n_subject", classes, "s_known"), ("n_object", classes, "o_known")):
        t = t.join(known.select(F.col("name").alias(column), F.lit(True).alias(flag)).distinct(), column, "left")
    missing = lambda flag: F.col(flag).isNull()
    t = t.select(
        *triples.columns, "n_subject", "n_relation", "n_object", "n_confidence",
        missing("r_known").alias("unknown_relation"), missing("s_known").alias("unknown_subject"), missing("o_known").alias("unknown_object"),
        (missing("s_known") & ~reasonable(F.col("n_subject"))).alias("questionable_subject"),
        (missing("o_known") & ~reasonable(F.col("n_object"))).alias("questionable_object"),
        (F.col("n_confidence") < least).alias("low_confidence"),
    )
    say = lambda flag, prefix, c: F.when(F.col(flag), F.concat(F.lit(prefix), c))
    issues = F.array_compact(F.array(
        say("unknown_relation", "Unknown relation: ", "n_relation"), say("questionable_subject", "Questionable subject: ", "n_subject"),
        say("questionable_object", "Questionable object: ", "n_object"), say("low_confidence", "Low confidence: ", T.number(F.col("n_confidence"))),
    ))
    critical = F.col("unknown_relation") | F.col("questionable_subject") | F.col("questionable_object")
    return t.withColumn("issues", issues).withColumn("is_valid", ~critical)


def counters(flags: DataFrame) -> DataFrame:
    """One row of counts; a triple without a relation cannot be validated and counts as an error as well."""
    kept = F.when(F.col("is_valid"), F.struct("n_subject", "n_relation", "n_object"))
    return flags.agg(*(F.count_if(F.expr(c)).alias(name) for name, c in COUNTERS.items()), F.count_distinct(kept).alias("unique_valid_triples"))


def unique_valid(flags: DataFrame) -> DataFrame:
    """Best valid triple of each normalised, case-sensitive key, with normalised parts."""
    v = flags.where("is_valid").select(
        F.col("n_subject").alias("subject"), F.col("n_relation").alias("relation"), F.col("n_object").alias("object"),
        F.col("n_confidence").alias("confidence"), "source_url", F.coalesce("source_type", F.lit("text")).alias("source_type"), "pos",
    )
    return best_per_key(v, [F.col("subject"), F.col("relation"), F.col("object")])


def nodes(edges: DataFrame) -> DataFrame:
    """name, type, source_count: how often a name is an end of an edge (twice for a loop)."""
    ends = edges.select(F.explode(F.array("subject", "object")).alias("name"))
    return ends.groupBy("name").agg(F.lit("Entity").alias("type"), F.count("*").alias("source_count"))


def edges(unique: DataFrame, *more: str) -> DataFrame:
    return unique.select(F.col("subject").alias("src"), F.col("object").alias("dst"), "relation", "confidence", "source_url", "source_type", *more)
