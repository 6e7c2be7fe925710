"""The whole graph build as one lazy plan: pages, triples, ontology growth, validation, graph."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.operators import extract, graph, ontology, quality, validate
from loomgraph.sources import html

STEPS = ("ontology", "pages", "triples", "growth", "validation", "graph")


@dataclass
class Build:
    """What each step of a build yields; nothing runs until a table is written or read."""

    classes: DataFrame
    relations: DataFrame
    pages: DataFrame
    triples: DataFrame
    grown_classes: DataFrame
    grown_relations: DataFrame
    flags: DataFrame
    nodes: DataFrame
    edges: DataFrame

    def step(self, number: int) -> DataFrame:
        """Output of step 1 to 6."""
        return (self.classes, self.pages, self.triples, self.grown_classes, self.flags, self.edges)[number - 1]

    def counts(self) -> DataFrame:
        """step, n of each step's main output."""
        out = None
        for i, name in enumerate(STEPS, 1):
            one = self.step(i).agg(F.lit(name).alias("step"), F.count("*").alias("n"))
            out = one if out is None else out.union(one)
        return out


def build(spark: SparkSession, raw_pages: DataFrame, container: tuple[str, str | None] = ("div", "main"), use_patterns: bool = True) -> Build:
    """raw_pages (page_id, url, html). Triples serve growth and validation; write them once for large inputs."""
    classes, relations = ontology.classes(spark), ontology.relations(spark)
    pages = html.scrape(raw_pages, container)
    triples = extract.dedup_any_case(extract.extract(pages, use_patterns))
    return from_triples(classes, relations, pages, triples)


def from_triples(classes: DataFrame, relations: DataFrame, pages: DataFrame, triples: DataFrame) -> Build:
    growing = triples.where(quality.band().isin("high", "medium"))
    c = ontology.grown(classes, ontology.new_classes(growing, classes))
    r = ontology.grown(relations, ontology.new_relations(growing, relations))
    flags = validate.flagged(triples, c, r)
    rows = validate.unique_valid(flags)
    edges = validate.edges(rows, "first_pos").withColumnRenamed("first_pos", "pos")
    nodes = validate.nodes(rows).withColumn("pos", F.lit(0))
    kept = graph.last_per(graph.clean_nodes(nodes), ["name"])
    linked = graph.with_both_ends(graph.last_per(graph.clean_edges(edges), graph.EDGE_KEY), kept)
    return Build(classes, relations, pages, triples, c, r, flags, kept, linked)
