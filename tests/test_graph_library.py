"""Golden snippets, names, dedup order, upserts and invariants."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomgraph.functions import text as T
from loomgraph.operators import extract, graph, quality, validate
from loomgraph.plans import catalogue, pipeline
from loomgraph.sources import html, stages
from loomgraph.streaming.merge import GraphSink

GOLDEN = {
    ("code", "class Dog extends Animal implements Runnable, Comparable { }"): {
        ("Dog", "istypeof", "Class", 1.0), ("Dog", "extends", "Animal", 1.0), ("Dog", "implements", "Runnable", 1.0), ("Dog", "implements", "Comparable", 1.0)},
    ("code", 'List<String> cars = new ArrayList<String>(); cars.add("Volvo");'): {
        ("Cars", "hasmethod", "Add", 0.7999999999999999), ("ArrayList", "istypeof", "Collection", 0.95), ("ArrayList", "belongsto", "JavaCollections", 0.95),
        ("String", "istypeof", "DataType", 1.0), ("String", "belongsto", "JavaPrimitives", 1.0)},
    ("code", "try { run(); } catch (ArithmeticException e) { }"): {
        ("ArithmeticException", "istypeof", "Exception", 0.9), ("Code", "handles", "ArithmeticException", 0.9)},
    ("code", "public static void main(String[] args) { }"): {
        ("Main", "hasreturntype", "Void", 0.9), ("Main", "istypeof", "Method", 0.9), ("String", "istypeof", "DataType", 1.0), ("String", "belongsto", "JavaPrimitives", 1.0)},
    ("code", "import java.util.ArrayList; @Override // uses REST here"): {
        ("ArrayList", "istypeof", "Collection", 0.95), ("ArrayList", "belongsto", "JavaCollections", 0.95), ("Override", "istypeof", "Annotation", 0.95),
        ("Code", "uses", "Override", 0.95), ("ArrayList", "belongsto", "Java.util", 0.85), ("Code", "imports", "ArrayList", 0.85),
        ("REST", "istypeof", "WebConcept", 0.7999999999999999), ("REST", "belongsto", "WebDevelopment", 0.7999999999999999)},
    ("text", "The class keyword is used; an interface Shape extends Form, Area is next."): {
        ("Keyword", "istypeof", "Class", 0.9), ("Shape", "istypeof", "Interface", 0.9), ("Shape", "extends", "Form", 0.9), ("Shape", "extends", "Areaisnext", 0.9)},
    ("text", "@RestController uses the Singleton and new Scanner(x) once"): {
        ("Scanner", "hasreturntype", "New", 0.8), ("Scanner", "istypeof", "Method", 0.8), ("Code", "instantiates", "Scanner", 0.75),
        ("RestController", "istypeof", "Annotation", 0.85), ("Code", "uses", "RestController", 0.85), ("RestController", "istypeof", "SpringAnnotation", 0.8),
        ("RestController", "belongsto", "SpringFramework", 0.8), ("Singleton", "istypeof", "DesignPattern", 0.75), ("Singleton", "belongsto", "SoftwareDesign", 0.75)},
    ("text", "@Service and @ServiceMesh are marked in this code sample"): {
        ("Service", "istypeof", "Annotation", 0.85), ("Code", "uses", "Service", 0.85), ("ServiceMesh", "istypeof", "Annotation", 0.85), ("Code", "uses", "ServiceMesh", 0.85),
        ("Service", "istypeof", "SpringAnnotation", 0.8), ("Service", "belongsto", "SpringFramework", 0.8)},
}
PAGES = "page_pos long, url string, title string, text_content array<string>, code_examples array<string>, error string"


def test_golden_snippets(spark):
    pages = spark.createDataFrame(
        [(i, f"u{i}", None, [s] if k == "text" else [], [s] if k == "code" else [], None) for i, (k, s) in enumerate(GOLDEN)], PAGES
    )
    raw = extract.extract(pages)
    for i, want in enumerate(GOLDEN.values()):
        got = extract.dedup_any_case(raw.where(F.col("source_url") == f"u{i}")).collect()
        assert {(r.subject, r.relation, r.object, r.confidence) for r in got} == want


def test_error_pages_and_short_snippets_give_nothing(spark):
    pages = spark.createDataFrame([(0, "a", None, ["class Dog extends Cat here"], [], "bad"), (1, "b", None, ["class A"], [], None), (2, None, None, None, None, None)], PAGES)
    assert extract.extract(pages).count() == 0


NAMES = [
    ("", "", "relatedTo", "", "", "", "RELATED_TO"), ("int", "Int", "int", "Integer", "DataType_Int", "int", "int"),
    ("STRING", "String", "string", "String", "DataType_String", "String", "STRING"), ("java.util", "Java.util", "javautil", "Java.util", "Java.util", "java.util", "java_util"),
    ("isTypeOf", "IsTypeOf", "istypeof", "Istypeof", "Istypeof", "isTypeOf", "isTypeOf"), ("is_type_of", "Is_type_of", "isTypeOf", "Is_type_of", "Is_type_of", "is_type_of", "is_type_of"),
    ("1x", "1x", "1x", "1x", "1x", "1x", "REL_1x"), ("--", "", "", "--", "--", "--", "REL___"), ("été", "Été", "été", "Été", "Été", "été", "été"),
]


@pytest.mark.parametrize("row", NAMES, ids=[r[0] or "empty" for r in NAMES])
def test_names(spark, row):
    c = F.col("x")
    fs = (T.extract_entity, T.extract_relation, T.validate_entity, T.growth_entity, T.tuner_entity, T.load_relation)
    got = spark.createDataFrame([(row[0],)], "x string").select(*(f(c).alias(f.__name__) for f in fs)).first()
    assert tuple(got) == row[1:]


def test_preprocess(spark):
    texts = ["a &amp; b", "x \n y", "Try it Yourself now » rest", None, "&#39;"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "x string").select(T.preprocess(F.col("x"))).collect()]
    assert got == ["a   b".replace("   ", " "), "x y", "rest", "", "&#39;"]


TRIPLE = "subject string, relation string, object string, confidence double, source_url string, source_type string, pos long"


def test_dedup_ties_keep_the_earliest_value_and_first_position(spark):
    rows = [("a1", "rr", "b1", 0.5, "u", "text", 1), ("A1 ", "RR", "b1", 0.5, "u", "text", 2), ("a1", "rr", "b1", 0.9, "v", "text", 3), ("x", "rr", "b1", 0.9, "v", "text", 4)]
    got = extract.dedup_any_case(spark.createDataFrame(rows, TRIPLE)).collect()
    assert [(r.confidence, r.pos, r.first_pos) for r in got] == [(0.9, 3, 1)]
    assert extract.best_per_key(spark.createDataFrame(rows[:2], TRIPLE), [F.col("object")]).first().pos == 1


def test_bands_at_their_edges(spark):
    rows = spark.createDataFrame([(0.6,), (0.8,), (0.7 + 0.1,), (0.80001,), (0.59,)], "confidence double")
    assert [r[0] for r in rows.select(quality.band()).collect()] == ["medium", "medium", "medium", "high", "low"]


def test_linearised_model_output(spark):
    reply = "<triplet> instance of <subj> Dog <obj> Animal <triplet> x <subj> a <obj> b"
    got = spark.createDataFrame([(reply,)], "x string").select(extract.linearised(F.col("x")).alias("t")).first().t
    assert [(t.subject, t.relation, t.object) for t in got] == [("Dog", "instanceof", "Animal")]


def test_issues_write_confidence_as_python_does(spark):
    r = np.random.default_rng(3)
    least = [0.0, -0.0, 1.4999999999998348e-4, 9.99e-5, 1e-5, 1e-4, 0.001, 5e-324, 2e-323, 1.25e-10, -1e7, -12345678.5, -1.5e15, -1e16, -2e23, float("-inf"), *r.random(200) * 0.3, *10 ** r.uniform(-12, -1, 200), *-(10 ** r.uniform(-5, 20, 200))]
    rows = [("Dog", "uses", "Dog", None, "u", "t", -1)] + [("Dog", "uses", "Dog", float(x), "u", "t", i) for i, x in enumerate(least)]
    t = spark.createDataFrame(rows, "subject string, relation string, object string, confidence double, source_url string, source_type string, pos long")
    names = [spark.createDataFrame([(x,)], "name string") for x in ("Dog", "uses")]
    got = {x.pos: x.issues for x in validate.flagged(t, *names).select("pos", "issues").collect()}
    assert got == {x[-1]: [f"Low confidence: {0.0 if x[3] is None else x[3]}"] for x in rows}


def test_merge_is_idempotent_and_last_wins(spark):
    e = spark.createDataFrame([("a", "b", "x y", 0.1, "u", "t", 1), ("a", "b", "x-y", 0.2, "u", "t", 2), ("a", "a", "x", 0.2, "u", "t", 3), ("", "b", "x", 0.2, "u", "t", 4)],
                              "src string, dst string, relation string, confidence double, source_url string, source_type string, pos long")
    new = graph.last_per(graph.clean_edges(e), graph.EDGE_KEY)
    assert [(r.rel_type, r.confidence) for r in new.collect()] == [("x_y", 0.2)]
    once = graph.merge(new, new, graph.EDGE_KEY)
    assert sorted(once.collect()) == sorted(new.collect())


def test_graph_invariants(spark, sf_dir):
    nodes, edges = catalogue.kg_star(spark, sf_dir)
    assert graph.repeated_keys(nodes, ["name"]).isEmpty()
    assert graph.degrees(nodes, edges).agg({"degree": "sum"}).first()[0] == 2 * edges.count()
    flags = catalogue.flags_of(spark, sf_dir)
    unique = validate.unique_valid(flags)
    assert validate.nodes(unique).agg({"source_count": "sum"}).first()[0] == 2 * unique.count()
    assert quality.bands(catalogue.kg_events(spark, sf_dir)).agg({"n": "sum"}).first()[0] == flags.count()


def test_triangles_against_brute_force(spark):
    import itertools

    edges = [("a", "r", "b"), ("b", "r", "c"), ("c", "r", "a"), ("a", "q", "b"), ("c", "r", "d"), ("d", "r", "a"), ("a", "r", "a")]
    want = {}
    for x, y, z in itertools.permutations(enumerate(edges), 3):
        for flips in itertools.product((0, 1), repeat=3):
            ends = [(e[1][0], e[1][2])[::-1] if f else (e[1][0], e[1][2]) for e, f in zip((x, y, z), flips)]
            if ends[0][1] == ends[1][0] and ends[1][1] == ends[2][0] and ends[2][1] == ends[0][0] and len({e[0] for e in ends}) == 3:
                want[ends[0][0]] = want.get(ends[0][0], 0) + 1
    got = graph.triangles(spark.createDataFrame(edges, "src string, rel_type string, dst string"), None).collect()
    assert {r.name: r.n for r in got} == want


def test_html_sections():
    page = "<div id=main><h1>A long heading</h1><div class=tryit>skipped text here</div><p>some paragraph <b>bold</b></p><pre><code>int x = compute(1, 2, 3);</code></pre></div><p>outside of it all</p>"
    texts, codes, error = html.sections(page)
    assert texts == ["A long heading", "some paragraph bold"] and len(codes) == 2 and error is None
    assert html.sections("<p>no container</p>")[2] == "No main content found" and html.sections(None)[2]


def test_stage_documents(spark, tmp_path):
    p = tmp_path / "corpus.json"
    p.write_text('{"u1": {"title": "t", "url": "u1", "text_content": ["abc"], "code_examples": []}, "u2": {"url": "u2", "error": "x"}}')
    assert [(r.url, r.error) for r in stages.corpus(spark, str(p)).orderBy("page_pos").collect()] == [("u1", None), ("u2", "x")]
    for text in ('{"classes": ["A"], "relations": ["r"]}', '{"metadata": {"version": "1"}, "ontology": {"classes": ["A"], "relations": ["r"]}}'):
        p.write_text(text)
        c, r = stages.ontology(spark, str(p))
        assert (c.first().name, r.first().name) == ("A", "r")
    one = '{"subject": "s", "relation": "r", "object": "o", "confidence": 0.5}'
    for text in (f"[{one}]", '{"metadata": {}, "triples": {"all": [%s]}}' % one):
        p.write_text(text)
        assert stages.triples(spark, str(p)).first().subject == "s"
    p.write_text('{"nodes": [{"name": "n"}], "edges": [{"from": "a", "to": "b", "relation": "r"}]}')
    nodes, edges = stages.graph(spark, str(p))
    assert nodes.first().name == "n" and edges.first().dst == "b"
    n, e = tmp_path / "nodes.json", tmp_path / "edges.json"
    n.write_text('[{"name": "n"}]')
    e.write_text('[{"from": "a", "to": "b"}]')
    nodes, edges = stages.split_graph(spark, str(n), str(e))
    assert nodes.first().name == "n" and edges.first().src == "a"


def test_scraped_batches_are_bounded_by_their_texts():
    page = "<article>" + "<p>some words of a paragraph" * 150 + "</article>"  # unclosed, so texts are many times the page
    html_of = [page] * 40 + [None, "<p>no container</p>"]
    batch = pa.RecordBatch.from_pydict({"page_pos": list(range(42)), "url": [f"u{i}" for i in range(42)], "title": [None] * 42, "html": html_of})
    out = list(html.scraped([batch.slice(0, 0), batch], ("article", None)))
    of_page = sum(map(len, html.sections(page, ("article", None))[0]))
    sizes = [sum(len(t) for texts in b.column(3).to_pylist() for t in texts) for b in out]
    assert of_page > 50 * len(page) and len(out) > 5 and max(sizes) < html.BATCH_CHARS + of_page
    rows = pa.Table.from_batches(out).to_pylist()
    assert [r["page_pos"] for r in rows] == list(range(42)) and [r["url"] for r in rows] == [f"u{i}" for i in range(42)]
    assert [(r["text_content"], r["code_examples"], r["error"]) for r in rows] == [html.sections(h, ("article", None)) for h in html_of]


def test_pipeline_from_pages(spark):
    page = "<div id='main'><p>class Dog extends Animal in this text, class Dog again</p><pre>class Dog extends Animal implements Pet { run(); }</pre></div>"
    b = pipeline.build(spark, spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string"))
    assert {r.rel_type for r in b.edges.collect()} >= {"extends"}
    assert b.counts().count() == 6


def test_stream_upserts_once(spark, tmp_path):
    schema = "src string, dst string, relation string, confidence double, source_url string, source_type string, pos long"
    src, out = str(tmp_path / "in"), str(tmp_path / "graph")
    spark.createDataFrame([("a", "b", "r", 0.1, "u", "t", 1), ("a", "b", "r", 0.7, "u", "t", 2)], schema).write.parquet(src)
    sink = GraphSink(spark, out)
    for _ in range(2):
        q = spark.readStream.schema(schema).parquet(src).writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "cp")).start()
        q.processAllAvailable()
        q.stop()
    last, edges = sink.current()
    sink(spark.createDataFrame([("x", "y", "r", 0.1, "u", "t", 9)], schema), last)  # a batch seen before changes nothing
    assert [r.confidence for r in sink.current()[1].collect()] == [0.7]
