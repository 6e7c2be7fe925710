"""What is written as a stage document reads back as it was."""

import json

from loomgraph.operators import ontology as O
from loomgraph.operators import quality, validate
from loomgraph.sources import html, stages
from loomgraph.streaming.merge import GraphSink
from pyspark.sql import functions as F

TRIPLES = [
    (0, "Dog", "extends", "Animal", 0.9, "improved_patterns", "u1", "code"), (1, "Cat", "uses", "Milk", 0.7, "improved_patterns", "u2", "text"),
    (2, "Bird", "uses", "Wing", 0.3, "rebel", "u2", "text"), (3, "Fish", "uses", "Dog", None, None, "u3", "text"),
]
SCHEMA = "pos long, subject string, relation string, object string, confidence double, extraction_method string, source_url string, source_type string"


def test_triples_document(spark, tmp_path):
    rows = spark.createDataFrame(TRIPLES, SCHEMA)
    stages.save_triples_document(rows, str(tmp_path / "t"))
    back = stages.triples(spark, str(tmp_path / "t"))
    names = ["subject", "relation", "object", "confidence", "source_url"]
    assert sorted(map(str, back.select(*names).collect())) == sorted(map(str, rows.select(*names).collect()))
    bands = {r.subject: r.band for r in stages.banded_triples(spark, str(tmp_path / "t")).collect()}
    assert bands == {"Dog": "high", "Cat": "medium", "Bird": "low", "Fish": "low"}
    doc = json.loads("".join(r.value for r in spark.read.text(str(tmp_path / "t")).collect()))
    m = doc["metadata"]["quality_metrics"]
    assert (m["total_triples"], m["high_confidence"], m["unique_relations"], m["unique_entities"]) == (4, 1, 2, 7) and abs(m["avg_confidence"] - 0.475) < 1e-9
    assert len(doc["triples"]["by_method"]["rebel"]) == 1 and doc["metadata"]["relation_statistics"]["uses"]["count"] == 3
    (tmp_path / "bare.json").write_text(json.dumps([{"subject": s, "confidence": c} for s, c in (("a", 0.71), ("b", 0.7), ("c", 0.5), ("d", 0.4))]))
    assert [r.band for r in stages.banded_triples(spark, str(tmp_path / "bare.json")).orderBy("pos").collect()] == ["high", "medium", "medium", "low"]


def test_corpus_document_keeps_the_last_of_a_url(spark, tmp_path):
    body = "<div id='main'><p>text number {} that is long</p></div>"
    pages = spark.createDataFrame([(1, "u", body.format(1)), (2, "v", body.format(2)), (3, "u", body.format(3)), (4, "w", "none")], "page_id long, url string, html string")
    scraped = html.scrape(pages)
    assert sorted((r.url, r.page_pos) for r in html.last_per_url(scraped).collect()) == [("u", 3), ("v", 2), ("w", 4)]
    stages.save_corpus(scraped, str(tmp_path / "c"))
    back = {r.url: r for r in stages.corpus(spark, str(tmp_path / "c")).collect()}
    assert set(back) == {"u", "v", "w"} and back["w"].error
    rates = quality.scrape_rates(html.last_per_url(scraped)).first()
    assert rates.pages == 3 and rates.scraped + rates.failed == 3


def test_ontology_documents(spark, tmp_path):
    c, r = O.names(spark, ["A", "B"]), O.names(spark, ["x"])
    all_c, all_r = O.names(spark, ["A", "B", "C"]), O.names(spark, ["x", "y"])
    stages.save_updated_ontology(c, r, all_c, all_r, str(tmp_path / "new"), "old.json", "t.json")
    assert O.growth_counts(c, r, all_c, all_r).first().asDict() == {"original_classes": 2, "added_classes": 1, "total_classes": 3, "original_relations": 1, "added_relations": 1, "total_relations": 2}
    got = stages.first_ontology(spark, str(tmp_path / "missing"), str(tmp_path / "new"))
    assert sorted(x.name for x in got[0].collect()) == ["A", "B", "C"] and stages.first_ontology(spark, str(tmp_path / "missing")) is None


def test_validated_documents(spark, tmp_path):
    flags = validate.flagged(spark.createDataFrame(TRIPLES, SCHEMA), O.names(spark, ["Dog"]), O.names(spark, ["uses", "extends"]))
    rows = validate.unique_valid(flags)
    stages.save_validated(validate.nodes(rows), validate.edges(rows), str(tmp_path))
    n, e = stages.graph(spark, str(tmp_path / "validated_data.json"))
    n2, e2 = stages.split_graph(spark, str(tmp_path / "nodes.json"), str(tmp_path / "edges.json"))
    assert n.count() == n2.count() == 7 and e.count() == e2.count() == 4
    assert {(x.src, x.dst) for x in e.collect()} == {("Dog", "Animal"), ("Cat", "Milk"), ("Bird", "Wing"), ("Fish", "Dog")}
    assert quality.most_common(validate.edges(rows), "relation").collect()[0].asDict() == {"value": "uses", "n": 3}


def test_sink_removes_what_no_reader_needs(spark, tmp_path):
    sink = GraphSink(spark, str(tmp_path / "g"))
    for k in range(4):
        batch = spark.createDataFrame([(f"s{k}", "d", "r", 1.0, "u", "text", k)], "src string, dst string, relation string, confidence double, source_url string, source_type string, pos long")
        sink(batch, k)
        sink(batch, k)
    assert sink.current()[0] == 3 and sink.current()[1].count() == 4
    assert sorted(p.name for p in (tmp_path / "g").glob("edges-*")) == ["edges-2", "edges-3"]


def test_dedup_in_one_aggregate(spark):
    from loomgraph.operators import extract

    rows = spark.createDataFrame([(0, "k", 0.5), (1, "k", None), (2, "k", 0.9), (3, "k", 0.9), (4, "m", None)], "pos long, subject string, confidence double")
    got = {r.subject: (r.pos, r.first_pos) for r in extract.best_per_key(rows, [F.col("subject")]).collect()}
    assert got == {"k": (2, 0), "m": (4, 4)}
