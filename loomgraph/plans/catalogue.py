"""Registered queries over the library's own operators, with their SQL twins.

The driver's tables hold no tutorial pages, so events stand in for triples, customers and orders for a graph with
triangles, and a list of code snippets for the pattern categories that no document matches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions import text as T
from loomgraph.functions.ontology_data import CLASSES, RELATIONS
from loomgraph.functions.patterns import BY_NAME, CATALOGUE, ENTITY_WORDS
from loomgraph.operators import extract, graph, ontology, quality, validate
from loomgraph.plans import pipeline
from loomgraph.sources import html

SNIPPETS = (
    "class Dog extends Animal implements Runnable, Comparable { }",
    "List<String> cars = new ArrayList<String>(); cars.add(value);",
    "try { run(); } catch (ArithmeticException e) { }",
    "public static void main(String[] args) { }",
    "import java.util.ArrayList; @Override // uses REST here",
    "The class keyword is used; an interface Shape extends Form, Area is next.",
    "@RestController uses the Singleton and new Scanner(x) once",
    "@Service and @ServiceMesh are marked in this code sample",
    "throws IOError or catch later TimeoutException; int x; boolean y; Factory builder",
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def kg_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("subject"), F.col("event_type").alias("relation"),
        F.concat(F.lit("k_"), F.get_json_object("props", "$.k")).alias("object"),
        F.greatest(F.lit(0.0), F.lit(1.0) - F.col("value") / F.lit(200.0)).alias("confidence"),
        F.lit("improved_patterns").alias("extraction_method"), F.col("event_type").alias("source_url"), F.lit("text").alias("source_type"),
        F.col("event_id").alias("pos"),
    )


def kg_star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges between nations, market segments, order priorities and order states."""
    c = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "c_mktsegment")
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus")
    both = c.join(o, F.col("c_custkey") == F.col("o_custkey")).select("n_name", "c_mktsegment", "o_orderpriority", "o_orderstatus").distinct()
    pairs = (("n_name", "trades", "c_mktsegment"), ("n_name", "orders", "o_orderpriority"), ("c_mktsegment", "extends", "o_orderpriority"), ("o_orderpriority", "has state", "o_orderstatus"))
    e = both.select(F.explode(F.array(*(F.struct(F.col(a).alias("src"), F.lit(r).alias("relation"), F.col(b).alias("dst")) for a, r, b in pairs))).alias("e")).select("e.*").distinct()
    edges = e.select("src", T.load_relation(F.col("relation")).alias("rel_type"), "dst")
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("name")).distinct().withColumn("type", F.when(F.col("name").rlike("^[0-9]"), "Priority").otherwise("Entity"))
    return nodes, edges


def snippets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(SNIPPETS)), "id int, body string")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents -> triples -> dedup -> edges -> relation distribution."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    t = extract.triples_of(docs, "text", (BY_NAME["collection_usage"], BY_NAME["web_concepts"])).withColumn("pos", F.struct("doc_id", "at"))
    best = extract.dedup_any_case(t).select(F.col("subject").alias("src"), F.col("object").alias("dst"), T.load_relation(F.col("relation")).alias("rel_type"))
    return graph.relation_distribution(best)


# ---- SQL building blocks -------------------------------------------------------------------------------------------
KG = """kg AS (SELECT 'user_' || user_id AS subject, event_type AS relation, 'k_' || regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS object,
  greatest(CAST(0 AS DOUBLE), CAST(1 AS DOUBLE) - value / CAST(200 AS DOUBLE)) AS confidence, event_type AS source_url, event_id AS pos FROM events)"""
STAR = """b AS (SELECT DISTINCT n_name, c_mktsegment, o_orderpriority, o_orderstatus FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN orders ON c_custkey = o_custkey),
e AS (SELECT n_name AS src, 'trades' AS rel_type, c_mktsegment AS dst FROM b UNION SELECT n_name, 'orders', o_orderpriority FROM b
  UNION SELECT c_mktsegment, 'extends', o_orderpriority FROM b UNION SELECT o_orderpriority, 'has_state', o_orderstatus FROM b),
n AS (SELECT name, CASE WHEN regexp_matches(name, '^[0-9]') THEN 'Priority' ELSE 'Entity' END AS type FROM (SELECT src AS name FROM e UNION SELECT dst FROM e)),
i AS (SELECT src AS name, dst AS other, rel_type FROM e UNION ALL SELECT dst, src, rel_type FROM e WHERE src <> dst)"""


def _values(names) -> str:
    return "(VALUES " + ", ".join(f"('{x}')" for x in names) + ") v(name)"


def _sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _sql_case(x: str, names: dict[str, str], other: str) -> str:
    return f"CASE lower({x}) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + f" ELSE {other} END"


def _sql_cap(x: str) -> str:
    return f"(upper(substr({x}, 1, 1)) || lower(substr({x}, 2)))"


def _sql_camel(x: str) -> str:
    return f"(string_split({x}, '_')[1] || array_to_string(list_transform(string_split({x}, '_')[2:], lambda p: upper(substr(p, 1, 1)) || lower(substr(p, 2))), ''))"


def _sql_extract_entity(x: str) -> str:
    s = rf"regexp_replace({_sql_strip(x)}, '[^\p{{L}}\p{{N}}_.]', '', 'g')"
    return _sql_case(_sql_strip(x), T.EXTRACT_NAMES, f"(upper(substr({s}, 1, 1)) || substr({s}, 2))")


def _sql_extract_relation(x: str) -> str:
    s = f"lower({_sql_strip(x)})"
    return rf"CASE WHEN {s} = '' THEN 'relatedTo' WHEN {s} LIKE '%\_%' ESCAPE '\' THEN {_sql_camel(s)} ELSE regexp_replace({s}, '[^\p{{L}}\p{{N}}_]', '', 'g') END"


def _sql_validate_entity(x: str) -> str:
    return _sql_case(_sql_strip(x), T.VALIDATE_NAMES, _sql_cap(_sql_strip(x)))


def _sql_growth_entity(x: str) -> str:
    s = _sql_strip(x)
    types = ", ".join(f"'{t}'" for t in T.GROWTH_TYPES)
    return f"CASE WHEN lower({s}) IN ({types}) THEN 'DataType_' || {_sql_cap(s)} ELSE {_sql_case(s, T.GROWTH_NAMES, _sql_cap(s))} END"


def _sql_growth_relation(x: str) -> str:
    s = f"lower({_sql_strip(x)})"
    return rf"CASE WHEN {s} LIKE '%\_%' ESCAPE '\' THEN {_sql_camel(s)} ELSE {s} END"


def _sql_tuner_entity(x: str) -> str:
    return _sql_case(_sql_strip(x), T.TUNER_NAMES, x)


def _sql_load_relation(x: str) -> str:
    s = rf"regexp_replace(regexp_replace({x}, '[ .-]', '_', 'g'), '[^\p{{L}}\p{{N}}_]', '', 'g')"
    return rf"CASE WHEN {s} = '' THEN 'RELATED_TO' WHEN NOT regexp_matches({s}, '^\p{{L}}') THEN 'REL_' || {s} ELSE {s} END"


def _sql_preprocess(x: str) -> str:
    out = rf"regexp_replace(regexp_replace(coalesce({x}, ''), '&[a-zA-Z]+;', ' ', 'g'), '\s+', ' ', 'g')"
    for noise in T.NOISE:
        out = f"regexp_replace({out}, '(?is){noise}', ' ', 'g')"
    return _sql_strip(out)


def _sql_best(keys: list[str], where: str = "true") -> str:
    k = ", ".join(keys)
    return f"""SELECT subject, relation, object, confidence, pos, min(pos) OVER (PARTITION BY {k}) AS first_pos FROM kg WHERE {where}
      QUALIFY row_number() OVER (PARTITION BY {k} ORDER BY confidence DESC, pos) = 1"""


def _sql_java(category: str) -> str:
    """The catalogue's own rules over the snippets, in SQL."""
    p = BY_NAME[category]
    rows = ", ".join(f"({i}, '{s}')" for i, s in enumerate(SNIPPETS))
    groups = ", ".join(f"regexp_extract_all(body, '(?im){p.regex}', {k}) AS g{k}" for k in range(1, p.groups + 1))
    selects = []
    for s, r, o in p.emits:
        term = lambda x: f"g{x[1]}[i]" if x.startswith("$") else f"'{x}'"
        part = f"unnest(list_transform(string_split({term(o)}, ','), lambda x: {_sql_strip('x')}))" if o.endswith(",") else term(o)
        selects.append(f"SELECT id, {term(s)} AS s, '{r}' AS r, {part} AS o FROM (SELECT *, unnest(range(1, len(g1) + 1)) AS i FROM m)")
    union = " UNION ALL ".join(selects)
    return f"""WITH d AS (SELECT * FROM (VALUES {rows}) v(id, raw)), c AS (SELECT id, {_sql_preprocess('raw')} AS body FROM d), m AS (SELECT id, {groups} FROM c),
    t AS ({union}) SELECT id, {_sql_extract_entity('s')} AS subject, {_sql_extract_relation('r')} AS relation, {_sql_extract_entity('o')} AS object,
    CAST({p.confidence} AS DOUBLE) AS confidence FROM t WHERE s <> '' AND o <> ''"""


def _sql_tokens(category: str, words: tuple[str, ...]) -> str:
    p = BY_NAME[category]
    named = "upper(substr(tok, 1, 1)) || substr(tok, 2)"
    known = _sql_case("tok", T.EXTRACT_NAMES, named)
    union = " UNION ALL ".join(f"SELECT doc_id, {known} AS subject, '{r.lower()}' AS relation, '{o}' AS object FROM k" for _, r, o in p.emits)
    listed = ", ".join(f"'{w.lower()}'" for w in words)
    return rf"""WITH k AS (SELECT * FROM (SELECT doc_id, unnest(regexp_extract_all({_sql_preprocess('text')}, '[\p{{L}}\p{{N}}_]+')) AS tok FROM documents) WHERE lower(tok) IN ({listed})),
    t AS ({union}) SELECT doc_id, subject, relation, object, CAST({p.confidence} AS DOUBLE) AS confidence FROM t"""


WEB = ("REST", "HTTP", "JSON", "XML", "API", "GET", "POST", "PUT", "DELETE")
COLLECTIONS = ("ArrayList", "HashMap", "HashSet", "LinkedList", "TreeMap", "Vector", "Stack", "Queue")
_KEYS_CI = [f"lower({_sql_strip(c)})" for c in ("subject", "relation", "object")]
_LONG = " AND ".join(f"length({k}) >= 2" for k in _KEYS_CI)


def _sql_reasonable(x: str) -> str:
    return rf"(length({x}) >= 2 AND (regexp_matches(lower({x}), '{'|'.join(ENTITY_WORDS)}') OR regexp_matches({x}, '^\p{{L}}[\p{{L}}\p{{N}}_-]*$')))"


_FLAGS = f"""{KG}, cls AS (SELECT DISTINCT name FROM {_values(CLASSES)}), rel AS (SELECT DISTINCT name FROM {_values(list(RELATIONS) + ['click', 'view'])}),
f AS (SELECT kg.*, {_sql_validate_entity('subject')} AS n_subject, {_sql_strip('relation')} AS n_relation, {_sql_validate_entity('object')} AS n_object FROM kg),
g AS (SELECT *, n_relation NOT IN (SELECT name FROM rel) AS unknown_relation, n_subject NOT IN (SELECT name FROM cls) AS unknown_subject,
  n_object NOT IN (SELECT name FROM cls) AS unknown_object, confidence < CAST(0.3 AS DOUBLE) AS low_confidence FROM f),
h AS (SELECT *, unknown_subject AND NOT {_sql_reasonable('n_subject')} AS questionable_subject, unknown_object AND NOT {_sql_reasonable('n_object')} AS questionable_object FROM g),
v AS (SELECT *, NOT (unknown_relation OR questionable_subject OR questionable_object) AS is_valid FROM h),
u AS (SELECT n_subject AS subject, n_relation AS relation, n_object AS object, confidence, source_url FROM v WHERE is_valid
  QUALIFY row_number() OVER (PARTITION BY n_subject, n_relation, n_object ORDER BY confidence DESC, pos) = 1)"""
_FREQ = """SELECT name, round(sum(confidence), 6) AS weight FROM ({rows}) WHERE name <> '' GROUP BY name
  HAVING round(sum(confidence), 9) >= 1 AND name NOT IN (SELECT name FROM known)"""


def flags_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = ontology.names(spark, [*RELATIONS, "click", "view"])
    return validate.flagged(kg_events(spark, sf_dir), ontology.classes(spark), known)


def normalised_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").select("p_partkey", F.explode(F.array("p_name", "p_type", "p_brand", F.lower(F.translate("p_type", " ", "_")))).alias("raw"))
    odd = spark.createDataFrame([(-1, x) for x in ("", " ", "int", "STRING", "java.util", "hash-map", "_", "1020", "isTypeOf", "is_type_of", "--", "a b")], "p_partkey long, raw string")
    rows = p.withColumn("p_partkey", F.col("p_partkey").cast("long")).unionByName(odd)
    c = F.col("raw")
    return rows.select(
        "p_partkey", "raw", T.extract_entity(c).alias("extract_entity"), T.extract_relation(c).alias("extract_relation"), T.validate_entity(c).alias("validate_entity"),
        T.growth_entity(c).alias("growth_entity"), T.growth_relation(c).alias("growth_relation"), T.tuner_entity(c).alias("tuner_entity"), T.load_relation(c).alias("load_relation"),
    )


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Edges of two loads: the earlier and the later half of the events."""
    kg = kg_events(spark, sf_dir).select(F.col("subject").alias("src"), F.col("object").alias("dst"), "relation", "confidence", "source_url", "source_type", "pos")
    middle = kg.agg(F.floor(F.avg("pos")).alias("m"))
    rows = kg.crossJoin(F.broadcast(middle))
    return rows.where("pos <= m").drop("m"), rows.where("pos > m").drop("m")


def merged_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (graph.last_per(graph.clean_edges(x), graph.EDGE_KEY) for x in _halves(spark, sf_dir))
    return graph.merge(a, b, graph.EDGE_KEY)


def merged_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    def load(e: DataFrame) -> DataFrame:
        n = e.groupBy(F.col("src").alias("name")).agg(F.count("*").alias("source_count"), F.max("pos").alias("pos")).withColumn("type", F.lit(None).cast("string"))
        return graph.last_per(graph.clean_nodes(n), ["name"])

    a, b = _halves(spark, sf_dir)
    return graph.merge(load(a), load(b), ["name"])


def page_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.scrape(read(spark, sf_dir, "pages"), ("article", None))


def built(spark: SparkSession, sf_dir: str) -> pipeline.Build:
    """The pipeline over triples of events."""
    return pipeline.from_triples(ontology.classes(spark), ontology.relations(spark), page_corpus(spark, sf_dir), extract.dedup_any_case(kg_events(spark, sf_dir)))


def _documents(category: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = read(spark, sf_dir, "documents").select("doc_id", "text")
        return extract.triples_of(docs, "text", (BY_NAME[category],)).select("doc_id", "subject", "relation", "object", "confidence")

    return run


def _java(category: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return extract.triples_of(snippets(spark), "body", (BY_NAME[category],)).select("id", "subject", "relation", "object", "confidence")

    return run


def queries() -> dict:
    kg, star = kg_events, kg_star
    core = ["subject", "relation", "object", "confidence", "pos", "first_pos"]
    return {
        "flagship": flagship,
        "preprocess_documents": lambda s, d: read(s, d, "documents").select("doc_id", T.preprocess(F.col("text")).alias("clean")).select("doc_id", F.length("clean").alias("n"), F.md5("clean").alias("digest")),
        "extract_web": _documents("web_concepts"),
        "extract_collections": _documents("collection_usage"),
        "extract_annotations": _documents("annotations"),
        **{f"extract_java_{p.category}": _java(p.category) for p in CATALOGUE},
        "normalise_names": normalised_names,
        "dedup_best_ci": lambda s, d: extract.dedup_any_case(kg(s, d)).select(*core),
        "dedup_best_cs": lambda s, d: extract.best_per_key(kg(s, d), [F.col(c) for c in core[:3]]).select(*core),
        "confidence_bands": lambda s, d: quality.bands(kg(s, d)),
        "method_counts": lambda s, d: quality.methods(kg(s, d)),
        "relation_stats": lambda s, d: quality.relation_stats(kg(s, d)),
        "triple_summary": lambda s, d: quality.summary(kg(s, d)),
        "top_relations": lambda s, d: quality.top_relations(kg(s, d)),
        "top_entities": lambda s, d: quality.top_entities(kg(s, d)),
        "filter_low_quality": lambda s, d: quality.filter_low_quality(kg(s, d)).select(*core[:5]),
        "tuned_triples": lambda s, d: quality.tuned(kg(s, d)).select(*core[:5]),
        "ontology_new_classes": lambda s, d: ontology.new_classes(kg(s, d), ontology.classes(s)).select("name", F.round("weight", 6).alias("weight")),
        "ontology_new_relations": lambda s, d: ontology.new_relations(kg(s, d), ontology.relations(s)).select("name", F.round("weight", 6).alias("weight")),
        "ontology_union": lambda s, d: ontology.grown(ontology.relations(s), ontology.new_relations(kg(s, d), ontology.relations(s))),
        "ontology_added": lambda s, d: ontology.added(ontology.relations(s), ontology.grown(ontology.relations(s), ontology.new_relations(kg(s, d), ontology.relations(s)))),
        "validate_flags": lambda s, d: flags_of(s, d).select("pos", "n_subject", "n_relation", "n_object", "unknown_relation", "unknown_subject", "questionable_subject", "unknown_object", "questionable_object", "low_confidence", "is_valid", F.size("issues").cast("long").alias("n_issues")),
        "validation_counters": lambda s, d: validate.counters(flags_of(s, d)),
        "growth_counts": lambda s, d: ontology.growth_counts(ontology.classes(s), ontology.relations(s), ontology.grown(ontology.classes(s), ontology.new_classes(kg(s, d), ontology.classes(s))), ontology.grown(ontology.relations(s), ontology.new_relations(kg(s, d), ontology.relations(s)))),
        "top_edge_relations": lambda s, d: quality.most_common(validate.edges(validate.unique_valid(flags_of(s, d))), "relation"),
        "top_node_types": lambda s, d: quality.most_common(validate.nodes(validate.unique_valid(flags_of(s, d))), "type"),
        "validate_issues": lambda s, d: flags_of(s, d).select("pos", F.array_join("issues", "; ").alias("issues")),
        "validation_quality": lambda s, d: quality.validation_report(validate.counters(flags_of(s, d))),
        "nodes": lambda s, d: validate.nodes(validate.unique_valid(flags_of(s, d))),
        "edges": lambda s, d: validate.edges(validate.unique_valid(flags_of(s, d))).drop("source_type"),
        "merge_nodes": merged_nodes,
        "merge_edges": merged_edges,
        "graph_sample_nodes": lambda s, d: graph.sample_nodes(star(s, d)[0]),
        "graph_labels": lambda s, d: graph.labels_and_types(*star(s, d)),
        "graph_counts": lambda s, d: graph.totals(*star(s, d)),
        "graph_degrees": lambda s, d: graph.degrees(*star(s, d)),
        "graph_most_connected": lambda s, d: graph.most_connected(*star(s, d)),
        "graph_rel_distribution": lambda s, d: graph.relation_distribution(star(s, d)[1]),
        "graph_node_types": lambda s, d: graph.type_distribution(star(s, d)[0]),
        "graph_inheritance": lambda s, d: graph.inheritance(star(s, d)[1]),
        "graph_contains": lambda s, d: graph.neighbours_of(star(s, d)[1], "MACH"),
        "graph_triangles": lambda s, d: graph.triangles(star(s, d)[1], None),
        "graph_orphan_edges": lambda s, d: graph.with_both_ends(star(s, d)[1], star(s, d)[0].where("type = 'Entity'")),
        "graph_constraint": lambda s, d: graph.repeated_keys(star(s, d)[0], ["name"]),
        "graph_statistics": lambda s, d: graph.statistics(*star(s, d)),
        "page_links": lambda s, d: html.links(read(s, d, "pages"), starts="/", ends=""),
        "page_text": page_corpus,
        "page_triples": lambda s, d: extract.dedup_any_case(extract.extract(page_corpus(s, d))).select(*core[:4], "source_url", "source_type"),
        "scrape_rates": lambda s, d: quality.scrape_rates(page_corpus(s, d)),
        "scrape_quality": lambda s, d: quality.scrape_report(page_corpus(s, d)),
        "extraction_quality": lambda s, d: quality.extraction_report(kg(s, d)),
        "pipeline_counts": lambda s, d: built(s, d).counts(),
    }


def oracle_sql() -> dict[str, str]:
    kg, star = f"WITH {KG}", f"WITH {STAR}"
    band = "CASE WHEN confidence > CAST(0.8 AS DOUBLE) THEN 'high' WHEN confidence >= CAST(0.6 AS DOUBLE) THEN 'medium' ELSE 'low' END"
    strong = "FROM kg WHERE confidence > CAST(0.6 AS DOUBLE)"
    two_ends = f"SELECT {_sql_growth_entity('subject')} AS name, confidence {strong} UNION ALL SELECT {_sql_growth_entity('object')}, confidence {strong}"
    rel_rows = f"SELECT {_sql_growth_relation('relation')} AS name, confidence {strong}"
    known = lambda names: f"known AS (SELECT DISTINCT name FROM {_values(names)})"
    odd = ", ".join(f"(-1, '{x}')" for x in ("", " ", "int", "STRING", "java.util", "hash-map", "_", "1020", "isTypeOf", "is_type_of", "--", "a b"))
    low = "confidence >= CAST({0} AS DOUBLE) AND length(subject) >= 2 AND length(object) >= 2 AND lower(subject) <> lower(object)"
    und = "CAST(2 * count(*) FILTER (src <> dst) + count(*) FILTER (src = dst) AS BIGINT)"
    deg = "d AS (SELECT n.name, count(i.name) AS degree FROM n LEFT JOIN i ON n.name = i.name GROUP BY n.name)"
    halves = f"{KG}, m AS (SELECT floor(avg(pos)) AS m FROM kg), c AS (SELECT subject AS src, {_sql_load_relation('relation')} AS rel_type, object AS dst, confidence, source_url, 'text' AS source_type, pos, pos > m AS later FROM kg, m WHERE subject <> object)"
    counts = ", ".join(f"count(*) FILTER ({c}) AS {n}" for n, c in (
        ("unknown_relations", "unknown_relation"), ("unknown_subject_classes", "unknown_subject"), ("questionable_subjects", "questionable_subject"),
        ("unknown_object_classes", "unknown_object"), ("questionable_objects", "questionable_object"), ("low_confidence", "low_confidence"),
        ("valid_triples", "is_valid"), ("invalid_triples", "NOT is_valid"), ("unknown_but_reasonable_subjects", "unknown_subject AND NOT questionable_subject"),
        ("unknown_but_reasonable_objects", "unknown_object AND NOT questionable_object"), ("validation_errors", "n_relation IS NULL")))
    return {
        "preprocess_documents": f"SELECT doc_id, length(c) AS n, md5(c) AS digest FROM (SELECT doc_id, {_sql_preprocess('text')} AS c FROM documents)",
        "extract_web": _sql_tokens("web_concepts", WEB),
        "extract_collections": _sql_tokens("collection_usage", COLLECTIONS),
        "extract_annotations": rf"""WITH k AS (SELECT doc_id, {_sql_extract_entity('tok')} AS x FROM (SELECT doc_id, unnest(regexp_extract_all({_sql_preprocess('text')}, '@([\p{{L}}\p{{N}}_]+)', 1)) AS tok FROM documents))
          SELECT doc_id, x AS subject, 'istypeof' AS relation, 'Annotation' AS object, CAST(0.85 AS DOUBLE) AS confidence FROM k UNION ALL SELECT doc_id, 'Code', 'uses', x, CAST(0.85 AS DOUBLE) FROM k""",
        **{f"extract_java_{p.category}": _sql_java(p.category) for p in CATALOGUE},
        "normalise_names": f"""WITH r AS (SELECT CAST(p_partkey AS BIGINT) AS p_partkey, unnest([p_name, p_type, p_brand, lower(replace(p_type, ' ', '_'))]) AS raw FROM part UNION ALL SELECT * FROM (VALUES {odd}))
          SELECT p_partkey, raw, {_sql_extract_entity('raw')} AS extract_entity, {_sql_extract_relation('raw')} AS extract_relation, {_sql_validate_entity('raw')} AS validate_entity,
          {_sql_growth_entity('raw')} AS growth_entity, {_sql_growth_relation('raw')} AS growth_relation, {_sql_tuner_entity('raw')} AS tuner_entity, {_sql_load_relation('raw')} AS load_relation FROM r""",
        "dedup_best_ci": f"{kg} {_sql_best(_KEYS_CI, _LONG)}",
        "dedup_best_cs": f"{kg} {_sql_best(['subject', 'relation', 'object'])}",
        "confidence_bands": f"{kg} SELECT {band} AS band, count(*) AS n FROM kg GROUP BY 1",
        "method_counts": f"{kg} SELECT 'improved_patterns' AS method, count(*) AS n FROM kg",
        "relation_stats": f"{kg} SELECT relation, count(*) AS n, round(avg(confidence), 6) AS mean_confidence FROM kg GROUP BY 1",
        "triple_summary": f"{kg} SELECT count(*) AS total, round(avg(confidence), 6) AS mean_confidence, count(DISTINCT relation) AS relations, count(*) FILTER (confidence > CAST(0.8 AS DOUBLE)) AS high_confidence, (SELECT count(*) FROM (SELECT subject FROM kg UNION SELECT object FROM kg)) AS entities FROM kg",
        "top_relations": f"{kg} SELECT relation, count(*) AS n FROM kg GROUP BY 1 ORDER BY n DESC, min(pos) LIMIT 10",
        "top_entities": f"{kg} SELECT entity, count(*) AS n FROM (SELECT subject AS entity, 0 AS o, pos FROM kg UNION ALL SELECT object, 1, pos FROM kg) GROUP BY 1 ORDER BY n DESC, min(o * 1000000000000 + pos) LIMIT 10",
        "filter_low_quality": f"{kg} SELECT subject, relation, object, confidence, pos FROM kg WHERE {low.format('0.5')}",
        "tuned_triples": f"{kg}, t AS (SELECT {_sql_tuner_entity('subject')} AS subject, relation, {_sql_tuner_entity('object')} AS object, confidence, pos FROM kg WHERE {low.format('0.6')}) SELECT * FROM t WHERE length(trim(subject)) >= 2 AND length(trim(relation)) >= 2 AND length(trim(object)) >= 2 AND lower(trim(subject)) <> lower(trim(object))",
        "ontology_new_classes": f"{kg}, {known(CLASSES)} {_FREQ.format(rows=two_ends)}",
        "ontology_new_relations": f"{kg}, {known(RELATIONS)} {_FREQ.format(rows=rel_rows)}",
        "ontology_union": f"{kg}, {known(RELATIONS)} SELECT name FROM known UNION SELECT name FROM ({_FREQ.format(rows=rel_rows)})",
        "ontology_added": f"{kg}, {known(RELATIONS)} SELECT name FROM ({_FREQ.format(rows=rel_rows)}) EXCEPT SELECT name FROM known",
        "validate_flags": f"WITH {_FLAGS} SELECT pos, n_subject, n_relation, n_object, unknown_relation, unknown_subject, questionable_subject, unknown_object, questionable_object, low_confidence, is_valid, CAST(unknown_relation AS BIGINT) + CAST(questionable_subject AS BIGINT) + CAST(questionable_object AS BIGINT) + CAST(low_confidence AS BIGINT) AS n_issues FROM v",
        "validation_counters": f"WITH {_FLAGS} SELECT {counts}, (SELECT count(*) FROM u) AS unique_valid_triples FROM v",
        "growth_counts": f"{kg}, kc AS (SELECT DISTINCT name FROM {_values(CLASSES)}), kr AS (SELECT DISTINCT name FROM {_values(RELATIONS)}), c AS ({_FREQ.format(rows=two_ends).replace('FROM known', 'FROM kc')}), r AS ({_FREQ.format(rows=rel_rows).replace('FROM known', 'FROM kr')}) SELECT (SELECT count(*) FROM kc) AS original_classes, (SELECT count(*) FROM c) AS added_classes, (SELECT count(*) FROM kc) + (SELECT count(*) FROM c) AS total_classes, (SELECT count(*) FROM kr) AS original_relations, (SELECT count(*) FROM r) AS added_relations, (SELECT count(*) FROM kr) + (SELECT count(*) FROM r) AS total_relations",
        "top_edge_relations": f"WITH {_FLAGS} SELECT relation AS value, count(*) AS n FROM u GROUP BY 1 ORDER BY n DESC, value LIMIT 5",
        "top_node_types": f"WITH {_FLAGS} SELECT 'Entity' AS value, count(*) AS n FROM (SELECT subject FROM u UNION SELECT object FROM u) HAVING count(*) > 0",
        "validate_issues": f"WITH {_FLAGS} SELECT pos, concat_ws('; ', CASE WHEN unknown_relation THEN 'Unknown relation: ' || n_relation END, CASE WHEN questionable_subject THEN 'Questionable subject: ' || n_subject END, CASE WHEN questionable_object THEN 'Questionable object: ' || n_object END, CASE WHEN low_confidence THEN 'Low confidence: ' || CAST(confidence AS VARCHAR) END) AS issues FROM v",
        "flagship": f"WITH t AS (SELECT subject, relation, object FROM ({_sql_tokens('web_concepts', WEB)}) UNION ALL SELECT subject, relation, object FROM ({_sql_tokens('collection_usage', COLLECTIONS)})), k AS (SELECT DISTINCT lower(subject) AS s, lower(relation) AS r, lower(object) AS o FROM t) SELECT r AS rel_type, CAST(2 * count(*) FILTER (s <> o) + count(*) FILTER (s = o) AS BIGINT) AS n FROM k WHERE length(s) >= 2 AND length(r) >= 2 AND length(o) >= 2 GROUP BY 1",
        "validation_quality": f"WITH {_FLAGS} SELECT count(*) FILTER (is_valid) AS valid_triples, count(*) FILTER (NOT is_valid) AS invalid_triples, round(CAST(count(*) FILTER (is_valid) AS DOUBLE) / greatest(1, count(*)) * 100, 6) AS success_rate FROM v",
        "nodes": f"WITH {_FLAGS} SELECT name, 'Entity' AS type, count(*) AS source_count FROM (SELECT subject AS name FROM u UNION ALL SELECT object FROM u) GROUP BY name",
        "edges": f"WITH {_FLAGS} SELECT subject AS src, object AS dst, relation, confidence, source_url FROM u",
        "merge_edges": f"WITH {halves} SELECT src, rel_type, dst, confidence, source_url, source_type FROM c QUALIFY row_number() OVER (PARTITION BY src, rel_type, dst ORDER BY pos DESC) = 1",
        "merge_nodes": f"WITH {halves}, k AS (SELECT src AS name, later, count(*) AS source_count FROM c GROUP BY 1, 2) SELECT name, 'Entity' AS type, source_count FROM k QUALIFY row_number() OVER (PARTITION BY name ORDER BY later DESC) = 1",
        "graph_sample_nodes": f"{star} SELECT name, type FROM n ORDER BY name LIMIT 25",
        "graph_labels": f"{star} SELECT 'Entity' AS label UNION SELECT rel_type FROM e",
        "graph_counts": f"{star} SELECT 'nodes' AS kind, count(*) AS n FROM n UNION ALL SELECT 'relationships', {und} FROM e",
        "graph_degrees": f"{star}, {deg} SELECT * FROM d",
        "graph_most_connected": f"{star}, {deg} SELECT * FROM d ORDER BY degree DESC, name LIMIT 10",
        "graph_rel_distribution": f"{star} SELECT rel_type, {und} AS n FROM e GROUP BY 1",
        "graph_node_types": f"{star} SELECT type, count(*) AS n FROM n GROUP BY 1 ORDER BY n DESC, type LIMIT 10",
        "graph_inheritance": f"{star} SELECT src AS child, dst AS parent FROM e WHERE rel_type = 'extends'",
        "graph_contains": f"{star} SELECT name, rel_type, other FROM i WHERE name LIKE '%MACH%' ORDER BY 1, 2, 3 LIMIT 20",
        "graph_triangles": f"{star}, p AS (SELECT name, other, count(*) AS m FROM i WHERE name <> other GROUP BY 1, 2) SELECT a.name, CAST(sum(a.m * b.m * c.m) AS BIGINT) AS n FROM p a JOIN p b ON a.other = b.name JOIN p c ON b.other = c.name AND c.other = a.name WHERE b.other <> a.name GROUP BY 1",
        "graph_orphan_edges": f"{star} SELECT src, rel_type, dst FROM e WHERE src IN (SELECT name FROM n WHERE type = 'Entity') AND dst IN (SELECT name FROM n WHERE type = 'Entity')",
        "graph_constraint": f"{star} SELECT name, count(*) AS count FROM n GROUP BY 1 HAVING count(*) > 1",
        "extraction_quality": f"{kg}, t AS (SELECT count(*) AS total, count(*) FILTER (length(relation) > 2) AS relations_ok, count(*) FILTER (length(subject) > 1) + count(*) FILTER (length(object) > 1) AS entities_ok, count(*) FILTER (confidence > CAST(0.8 AS DOUBLE)) AS high FROM kg) SELECT *, round(CAST(relations_ok AS DOUBLE) / total * 50 + CAST(entities_ok AS DOUBLE) / (2 * total) * 30 + CAST(high AS DOUBLE) / total * 20, 6) AS score FROM t",
        "page_links": r"""WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1)) AS href, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 2)) AS label, unnest(range(0, len(regexp_extract_all(html, '(?is)<a\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1)))) AS k FROM pages)
          SELECT href AS url, regexp_replace(label, '^\s+|\s+$', '', 'g') AS title, href AS filename FROM a WHERE starts_with(href, '/') QUALIFY row_number() OVER (PARTITION BY href ORDER BY page_id, k) = 1""",
    }
