"""Ontology literal, growth from triples, unions and differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions import text as T
from loomgraph.functions.ontology_data import CLASSES, RELATIONS


def names(spark: SparkSession, values: list[str]) -> DataFrame:
    return spark.createDataFrame([(v,) for v in values], "name string")


def classes(spark: SparkSession) -> DataFrame:
    return names(spark, CLASSES)


def relations(spark: SparkSession) -> DataFrame:
    return names(spark, RELATIONS)


def new_classes(triples: DataFrame, known: DataFrame, above: float = 0.6, least: float = 1.0) -> DataFrame:
    """name, weight: unknown entity names by summed confidence of confident triples, both ends counted."""
    strong = triples.where(F.col("confidence") > above)
    ends = strong.select(F.explode(F.array("subject", "object")).alias("raw"), "confidence")
    return _frequent(ends.select(T.growth_entity(F.col("raw")).alias("name"), "confidence"), known, least)


def new_relations(triples: DataFrame, known: DataFrame, above: float = 0.6, least: float = 1.0) -> DataFrame:
    strong = triples.where(F.col("confidence") > above)
    return _frequent(strong.select(T.growth_relation(F.col("relation")).alias("name"), "confidence"), known, least)


def _frequent(rows: DataFrame, known: DataFrame, least: float) -> DataFrame:
    """Aggregate first, then look only the distinct names up."""
    total = rows.where("name <> ''").groupBy("name").agg(F.sum("confidence").alias("weight"))
    return total.where(F.round("weight", 9) >= least).join(known.distinct(), "name", "left_anti")


def grown(known: DataFrame, new: DataFrame) -> DataFrame:
    """Known and new names once each (a repeat in the known list goes too)."""
    return known.select("name").union(new.select("name")).distinct()


def growth_counts(classes: DataFrame, relations: DataFrame, all_classes: DataFrame, all_relations: DataFrame) -> DataFrame:
    """One row: original, added and total numbers of classes and relations; original is total less added."""
    one = None
    for kind, known, all_ in (("classes", classes, all_classes), ("relations", relations, all_relations)):
        new = added(known, all_).agg(F.count("*").alias(f"added_{kind}"))
        total = all_.select("name").distinct().agg(F.count("*").alias(f"total_{kind}"))
        row = new.crossJoin(total).select((F.col(f"total_{kind}") - F.col(f"added_{kind}")).alias(f"original_{kind}"), f"added_{kind}", f"total_{kind}")
        one = row if one is None else one.crossJoin(row)  # one row each
    return one


def added(known: DataFrame, all_: DataFrame) -> DataFrame:
    return all_.select("name").subtract(known.select("name"))
