"""JSON documents of the stages, read with fixed schemas and written back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NAMES = "classes array<string>, relations array<string>"
ONTOLOGY = f"metadata map<string,string>, ontology struct<{NAMES.replace('classes ', 'classes:').replace('relations ', 'relations:')}>, {NAMES}"
PAGE = "struct<title:string,url:string,text_content:array<string>,code_examples:array<string>,error:string,scraped_at:string>"
TRIPLE = (
    "struct<subject:string,relation:string,object:string,confidence:double,extraction_method:string,pattern_category:string,"
    "source_text:string,source_url:string,source_type:string>"
)
NODE = "struct<name:string,type:string,source_count:bigint>"
EDGE = "struct<`from`:string,`to`:string,relation:string,confidence:double,source_url:string,source_type:string>"


def _document(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.text(paths, wholetext=True)


def corpus(spark: SparkSession, path: str) -> DataFrame:
    """Pages of a JSON object keyed by url, in file order."""
    rows = _document(spark, path).select(F.posexplode(F.map_entries(F.from_json("value", f"map<string,{PAGE}>"))).alias("page_pos", "e"))
    return rows.select(F.col("page_pos").cast("long").alias("page_pos"), F.col("e.key").alias("url"), *(F.col(f"e.value.{c}") for c in ("title", "text_content", "code_examples", "error", "scraped_at")))


def ontology(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(classes, relations) of an ontology file with or without its envelope."""
    one = spark.read.schema(ONTOLOGY).option("multiLine", True).json(path)
    pick = lambda c: one.select(F.explode(F.coalesce(F.col(f"ontology.{c}"), F.col(c))).alias("name"))
    return pick("classes"), pick("relations")


def triples(spark: SparkSession, path: str) -> DataFrame:
    """Triples of a triple file (the list `all` of its envelope) or of a bare list, with pos."""
    doc = _document(spark, path)
    bare = F.from_json("value", f"array<{TRIPLE}>")
    whole = F.from_json("value", f"struct<triples:struct<all:array<{TRIPLE}>>>")["triples"]["all"]
    all_ = F.when(F.ltrim("value").startswith("["), bare).otherwise(whole)
    return doc.select(F.posexplode(all_).alias("pos", "t")).select("pos", "t.*")


def graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of a validated document."""
    doc = _document(spark, path).select(F.from_json("value", f"struct<nodes:array<{NODE}>,edges:array<{EDGE}>>").alias("d"))
    return _graph_rows(doc, "d.nodes", "d.edges")


def split_graph(spark: SparkSession, nodes_path: str, edges_path: str) -> tuple[DataFrame, DataFrame]:
    """The same from two files that hold one list each."""
    n = _document(spark, nodes_path).select(F.from_json("value", f"array<{NODE}>").alias("x"))
    e = _document(spark, edges_path).select(F.from_json("value", f"array<{EDGE}>").alias("x"))
    return _graph_rows(n, "x", "x")[0], _graph_rows(e, "x", "x")[1]


def _graph_rows(doc: DataFrame, nodes: str, edges: str) -> tuple[DataFrame, DataFrame]:
    rows = lambda c: doc.select(F.posexplode(c).alias("pos", "r"))
    n = lambda: rows(nodes).select("r.*", "pos")
    e = lambda: rows(edges).select(F.col("r.from").alias("src"), F.col("r.to").alias("dst"), "r.relation", "r.confidence", "r.source_url", "r.source_type", "pos")
    if nodes == edges:  # a document that holds only one of the two
        kind = doc.schema["x"].dataType.elementType.fieldNames()[0]
        return (n(), None) if kind == "name" else (None, e())
    return n(), e()


def save_ontology(classes: DataFrame, relations: DataFrame, path: str, version: str = "1.1") -> None:
    """One document with counts and the names in code point order."""
    c = classes.agg(F.array_sort(F.collect_list("name")).alias("classes"))
    r = relations.agg(F.array_sort(F.collect_list("name")).alias("relations"))
    out = c.crossJoin(r).select(
        F.struct(F.current_timestamp().cast("string").alias("created_at"), F.lit(version).alias("version"), F.size("classes").alias("total_classes"), F.size("relations").alias("total_relations")).alias("metadata"),
        F.struct("classes", "relations").alias("ontology"),
    )
    out.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def save_triples(rows: DataFrame, path: str, high: float = 0.8, medium: float = 0.6) -> None:
    """Triples as Parquet, one folder a confidence band."""
    c = F.col("confidence")
    rows.withColumn("confidence_band", F.when(c > high, "high").when(c >= medium, "medium").otherwise("low")).write.mode("overwrite").partitionBy("confidence_band").parquet(path)


def save_rows(rows: DataFrame, path: str) -> None:
    """Any stage's rows as JSON lines."""
    rows.write.mode("overwrite").json(path)


# ---- whole documents -----------------------------------------------------------------------------------------------
#: A document is one JSON value, so it is written by one task; larger tables go to save_rows or save_triples.
MAX_DOCUMENT_ROWS = 1_000_000
PLAIN = ("subject", "relation", "object", "confidence", "extraction_method", "pattern_category", "source_text", "source_url", "source_type")


def _bounded(rows: DataFrame) -> DataFrame:
    n = rows.count()
    if n > MAX_DOCUMENT_ROWS:
        raise ValueError(f"{n} rows are too many for one JSON document")
    return rows


def _listed(rows: DataFrame, order: str, *columns) -> DataFrame:
    """One row: `l`, the rows as structs of the columns, in order."""
    ordered = rows.agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_at"), F.struct(*columns).alias("x")))).alias("s"))
    return ordered.select(F.transform("s", lambda e: e["x"]).alias("l"))


def _write(one: DataFrame, path: str) -> None:
    """One row as one JSON document; absent values stay absent."""
    one.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def _now():
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def save_corpus(pages: DataFrame, path: str) -> None:
    """Scraped pages (page_pos, url, title, text_content, code_examples, error) as an object keyed by url, last write wins."""
    last = pages.groupBy("url").agg(F.max_by(F.struct("title", "url", "text_content", "code_examples", "error"), "page_pos").alias("page"), F.max("page_pos").alias("at"))
    rows = _listed(_bounded(last), "at", F.col("url").alias("key"), F.struct("page.*", _now().alias("scraped_at")).alias("value"))
    rows.select(F.to_json(F.map_from_entries("l")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def save_triples_document(rows: DataFrame, path: str, with_model: bool = False) -> None:
    """Triples with pos: the three bands, the lists by method, all of them, and statistics."""
    from loomgraph.operators import quality

    rows = _bounded(rows.withColumns({c: F.lit(None).cast("string") for c in PLAIN if c not in rows.columns}))
    all_ = _listed(rows, "pos", *PLAIN)
    confidence = lambda t: F.coalesce(t["confidence"], F.lit(0.0))
    pick = lambda test: F.filter("l", test)
    method = lambda name: pick(lambda t: t["extraction_method"] == name)
    doc = all_.select(
        "l", pick(lambda t: confidence(t) > 0.8).alias("high"), pick(lambda t: (confidence(t) >= 0.6) & (confidence(t) <= 0.8)).alias("medium"),
        pick(lambda t: confidence(t) < 0.6).alias("low"), method("rebel").alias("rebel"), method("improved_patterns").alias("patterns"),
    )
    known = rows.withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))
    stats = quality.relation_stats(known).agg(F.map_from_entries(F.collect_list(F.struct("relation", F.struct(F.col("n").alias("count"), F.col("mean_confidence").alias("avg_confidence"))))).alias("stats"))
    metrics = F.struct(
        F.col("total").alias("total_triples"), F.size("high").alias("high_confidence"), F.size("medium").alias("medium_confidence"), F.size("low").alias("low_confidence"),
        F.col("mean_confidence").alias("avg_confidence"), F.size("stats").alias("unique_relations"), F.col("entities").alias("unique_entities"),
    )
    methods = F.struct(F.lit(with_model).alias("rebel_enabled"), F.lit(True).alias("improved_patterns_enabled"), F.size("rebel").alias("rebel_triples"), F.size("patterns").alias("pattern_triples"))
    one = doc.crossJoin(quality.summary(known)).crossJoin(stats)  # one row each
    _write(one.select(
        F.struct(_now().alias("created_at"), methods.alias("extraction_methods"), metrics.alias("quality_metrics"), F.col("stats").alias("relation_statistics")).alias("metadata"),
        F.struct(F.col("high").alias("high_confidence"), F.col("medium").alias("medium_confidence"), F.col("low").alias("low_confidence"), F.struct("rebel", "patterns").alias("by_method"), F.col("l").alias("all")).alias("triples"),
    ), path)


def save_updated_ontology(classes: DataFrame, relations: DataFrame, all_classes: DataFrame, all_relations: DataFrame, path: str, updated_from: str, triples_source: str) -> None:
    """The grown ontology with what was added and the counts; original counts are total less added."""
    from loomgraph.operators import ontology as O

    counts = O.growth_counts(classes, relations, all_classes, all_relations)
    names = lambda df, alias: df.agg(F.array_sort(F.collect_set("name")).alias(alias))
    one = counts.crossJoin(names(all_classes, "classes")).crossJoin(names(all_relations, "relations"))
    one = one.crossJoin(names(O.added(classes, all_classes), "new_classes")).crossJoin(names(O.added(relations, all_relations), "new_relations"))
    _write(one.select(
        F.struct(_now().alias("created_at"), F.lit(updated_from).alias("updated_from"), F.lit(triples_source).alias("triples_source"), *counts.columns, F.lit("2.0").alias("version")).alias("metadata"),
        F.struct("new_classes", "new_relations").alias("changes"), F.struct("classes", "relations").alias("ontology"),
    ), path)


def save_validated(nodes: DataFrame, edges: DataFrame, folder: str) -> None:
    """nodes (name, type, source_count) and edges (src, dst, relation, ...) as one document and as a list each."""
    n = _listed(_bounded(nodes), "name", "name", "type", "source_count").withColumnRenamed("l", "nodes")
    e = _listed(_bounded(edges), "src", F.col("src").alias("from"), F.col("dst").alias("to"), "relation", "confidence", "source_url", "source_type").withColumnRenamed("l", "edges")
    _write(n.crossJoin(e), f"{folder}/validated_data.json")
    for name, one in (("nodes", n), ("edges", e)):
        one.select(F.to_json(name).alias("value")).coalesce(1).write.mode("overwrite").text(f"{folder}/{name}.json")


def banded_triples(spark: SparkSession, path: str) -> DataFrame:
    """pos, band, triple: the bands as the file stores them; a bare list is cut above 0.7 (high) and from 0.5 (medium)."""
    doc = _document(spark, path)
    lists = ", ".join(f"{b}:array<{TRIPLE}>" for b in ("high_confidence", "medium_confidence", "low_confidence"))
    stored = F.from_json("value", f"struct<triples:struct<{lists}>>")["triples"]
    of = lambda name, band: F.transform(F.coalesce(stored[name], F.array().cast(f"array<{TRIPLE}>")), lambda t: F.struct(F.lit(band).alias("band"), t.alias("t")))
    kept = F.concat(of("high_confidence", "high"), of("medium_confidence", "medium"), of("low_confidence", "low"))
    c = lambda t: F.coalesce(t["confidence"], F.lit(0.0))
    bare = F.transform(F.from_json("value", f"array<{TRIPLE}>"), lambda t: F.struct(F.when(c(t) > 0.7, "high").when(c(t) >= 0.5, "medium").otherwise("low").alias("band"), t.alias("t")))
    rows = F.when(F.ltrim("value").startswith("["), bare).otherwise(kept)
    return doc.select(F.posexplode(rows).alias("pos", "r")).select("pos", "r.band", "r.t.*")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def first_ontology(spark: SparkSession, *paths: str) -> tuple[DataFrame, DataFrame] | None:
    """The ontology of the first of these files that exists, None if none does."""
    return next((ontology(spark, p) for p in paths if exists(spark, p)), None)
