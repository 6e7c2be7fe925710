"""Property graph tables: idempotent upserts and the shipped queries.

A relationship count is undirected as in the graph store's pattern language: every edge but a loop counts twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions import text as T

EDGE_KEY = ["src", "rel_type", "dst"]


def clean_nodes(rows: DataFrame) -> DataFrame:
    """name, type, source_count, pos with defaults; blank names go."""
    return rows.where(F.coalesce(T.strip(F.col("name")), F.lit("")) != "").select(
        T.strip(F.col("name")).alias("name"), F.coalesce("type", F.lit("Entity")).alias("type"),
        F.coalesce("source_count", F.lit(1)).cast("long").alias("source_count"), "pos",
    )


def clean_edges(rows: DataFrame) -> DataFrame:
    """src, rel_type, dst and properties with defaults; blank ends and loops go; urls keep 500 characters."""
    ends = [T.strip(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in ("src", "dst")]
    return rows.select(
        *ends, T.load_relation(F.col("relation")).alias("rel_type"), F.coalesce("confidence", F.lit(0.5)).alias("confidence"),
        F.substring(F.coalesce("source_url", F.lit("")), 1, 500).alias("source_url"), F.coalesce("source_type", F.lit("text")).alias("source_type"), "pos",
    ).where("src <> '' and dst <> '' and src <> dst")


def last_per(rows: DataFrame, key: list[str]) -> DataFrame:
    """The latest row of each key: the last write wins."""
    w = Window.partitionBy(*key).orderBy(F.col("pos").desc())
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "pos")


def merge(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of old whose key is not in new, and new; new has one row a key."""
    return old.join(new.select(*key), key, "left_anti").select(*old.columns).unionByName(new)


def with_both_ends(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose two ends exist; the others vanish silently."""
    names = nodes.select(F.col("name"))
    return edges.join(names.withColumnRenamed("name", "src"), "src", "left_semi").join(names.withColumnRenamed("name", "dst"), "dst", "left_semi")


def repeated_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys that break the uniqueness constraint; empty when it holds."""
    return rows.groupBy(*key).count().where("count > 1")


def both_ways(edges: DataFrame) -> DataFrame:
    """name, other, rel_type: each edge from both ends, a loop once."""
    back = edges.where("src <> dst").select(F.col("dst").alias("name"), F.col("src").alias("other"), "rel_type")
    return edges.select(F.col("src").alias("name"), F.col("dst").alias("other"), "rel_type").union(back)


def undirected():
    return 2 * F.count_if(F.col("src") != F.col("dst")) + F.count_if(F.col("src") == F.col("dst"))


def sample_nodes(nodes: DataFrame, most: int = 25) -> DataFrame:
    return nodes.orderBy("name").limit(most)


def labels_and_types(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    label = nodes.select(F.lit("Entity").alias("label")).distinct()
    return label.union(edges.select(F.col("rel_type").alias("label")).distinct()).distinct()


def totals(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """kind, n for nodes and (undirected) relationships."""
    n = nodes.agg(F.lit("nodes").alias("kind"), F.count("*").alias("n"))
    return n.union(edges.agg(F.lit("relationships").alias("kind"), undirected().alias("n")))


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """name, degree of every node, 0 where no edge meets it. Incidences are counted before the join."""
    met = both_ways(edges).groupBy("name").agg(F.count("*").alias("degree"))
    return nodes.select("name").join(met, "name", "left").select("name", F.coalesce("degree", F.lit(0)).alias("degree"))


def most_connected(nodes: DataFrame, edges: DataFrame, most: int = 10) -> DataFrame:
    return degrees(nodes, edges).orderBy(F.col("degree").desc(), "name").limit(most)


def relation_distribution(edges: DataFrame, most: int | None = None) -> DataFrame:
    out = edges.groupBy("rel_type").agg(undirected().alias("n"))
    return out if most is None else out.orderBy(F.col("n").desc(), "rel_type").limit(most)


def type_distribution(nodes: DataFrame, most: int = 10) -> DataFrame:
    return nodes.groupBy("type").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "type").limit(most)


def inheritance(edges: DataFrame, rel_type: str = "extends") -> DataFrame:
    return edges.where(F.col("rel_type") == rel_type).select(F.col("src").alias("child"), F.col("dst").alias("parent"))


def neighbours_of(edges: DataFrame, part: str, most: int | None = 20) -> DataFrame:
    """name, rel_type, other of nodes whose name contains `part`."""
    out = both_ways(edges).where(F.col("name").contains(part)).select("name", "rel_type", "other")
    return out if most is None else out.orderBy("name", "rel_type", "other").limit(most)


def triangles(edges: DataFrame, most: int | None = 5) -> DataFrame:
    """name, n: ordered triangles through each node, parallel edges of different types counted apart.

    Each unordered pair of ends carries its number of edges. Pairs point from the end of lower degree to the other, so a
    hub opens no wedge over its many leaves; each triangle is found once and counted for its three corners.
    """
    pair = edges.where("src <> dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
    pair = pair.groupBy("a", "b").agg(F.count("*").alias("m"))
    degree = pair.select(F.explode(F.array("a", "b")).alias("v")).groupBy("v").agg(F.count("*").alias("d"))
    ranked = pair.join(degree.select(F.col("v").alias("a"), F.col("d").alias("da")), "a").join(degree.select(F.col("v").alias("b"), F.col("d").alias("db")), "b")
    swap = F.struct("db", "b") < F.struct("da", "a")
    out = ranked.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("u"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("w"), "m")
    left = out.select("u", F.col("w").alias("x"), F.col("m").alias("mx"))
    right = out.select("u", F.col("w").alias("y"), F.col("m").alias("my"))
    wedge = left.join(right, "u").where("x < y")
    closing = pair.select(F.col("a").alias("x"), F.col("b").alias("y"), F.col("m").alias("mc"))
    found = wedge.join(closing, ["x", "y"]).select(F.explode(F.array("u", "x", "y")).alias("name"), (2 * F.col("mx") * F.col("my") * F.col("mc")).alias("n"))
    found = found.groupBy("name").agg(F.sum("n").alias("n"))
    return found if most is None else found.orderBy(F.col("n").desc(), "name").limit(most)


def statistics(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: totals and the three rankings as arrays, largest first."""
    n = nodes.agg(F.count("*").alias("total_nodes")).crossJoin(edges.agg(undirected().alias("total_relationships")))
    ranked = (("node_types", type_distribution(nodes)), ("relationship_types", relation_distribution(edges, 15)), ("top_connected_nodes", most_connected(nodes, edges)))
    for name, df in ranked:
        key, count = df.columns
        order = F.array_sort(F.collect_list(F.struct((-F.col(count)).alias("low"), F.col(key).alias("key"))))
        n = n.crossJoin(df.agg(F.transform(order, lambda x: F.struct(x["key"].alias("name"), (-x["low"]).alias("n"))).alias(name)))
    return n
