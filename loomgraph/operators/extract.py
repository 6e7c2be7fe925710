"""Texts to triples. Every pattern becomes array expressions over one scan of the text; one explode yields the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions import text as T
from loomgraph.functions.patterns import CATALOGUE, Pattern

TRIPLE = "struct<method:int,category:int,match:int,emit:int,part:int,name:string,s:string,r:string,o:string,conf:double>"


def matches(body: Column, p: Pattern, number: int) -> Column:
    """array of raw triples of one pattern, in match order."""
    groups = [F.regexp_extract_all(body, F.lit(f"(?imU){p.regex}"), F.lit(k)) for k in range(1, p.groups + 1)]
    zipped = F.arrays_zip(*(g.alias(f"g{k}") for k, g in enumerate(groups, 1)))

    def term(m: Column, x: str) -> Column:
        return m[f"g{x[1]}"] if x.startswith("$") else F.lit(x)

    def emitted(m: Column, i: Column) -> Column:
        rows = []
        for e, (s, r, o) in enumerate(p.emits):
            parts = F.transform(F.split(m[f"g{o[1]}"], ","), T.strip) if o.endswith(",") else F.array(term(m, o))
            rows.append(F.transform(parts, lambda part, k: _raw(number, p, i, e, k, term(m, s), r, part)))  # noqa: B023
        return F.concat(*rows)

    all_ = F.flatten(F.transform(zipped, emitted))
    return F.filter(all_, lambda t: (t["s"] != "") & (t["r"] != "") & (t["o"] != ""))


def _raw(number, p, i, e, k, s, r, o) -> Column:
    return F.struct(
        F.lit(1).alias("method"), F.lit(number).alias("category"), i.cast("int").alias("match"), F.lit(e).alias("emit"),
        k.cast("int").alias("part"), F.lit(p.category).alias("name"), s.alias("s"), F.lit(r).alias("r"), o.alias("o"),
        F.lit(float(p.confidence)).alias("conf"),
    ).cast(TRIPLE)


def triples_of(df: DataFrame, body: str, patterns: tuple[Pattern, ...] = CATALOGUE) -> DataFrame:
    """df's columns, `at` (position within the text) and subject, relation, object, confidence, pattern_category."""
    clean = df.withColumn("_clean", T.preprocess(F.col(body)))
    order = {p.category: i for i, p in enumerate(CATALOGUE)}
    every = F.concat(*(matches(F.col("_clean"), p, order[p.category]) for p in patterns))
    rows = clean.withColumn("_t", F.explode(every)).drop("_clean")
    return rows.select(
        *df.columns, F.struct(*(F.col(f"_t.{x}").alias(x) for x in ("method", "category", "match", "emit", "part"))).alias("at"),
        T.extract_entity(F.col("_t.s")).alias("subject"), T.extract_relation(F.col("_t.r")).alias("relation"),
        T.extract_entity(F.col("_t.o")).alias("object"), F.col("_t.conf").alias("confidence"), F.col("_t.name").alias("pattern_category"),
    )


def snippets(pages: DataFrame, use_patterns: bool = True) -> DataFrame:
    """pages (page_pos, url, text_content, code_examples, error) -> page_pos, url, kind, snippet, source_type, body.

    Pages with an error are left out; texts of up to 20 and codes of up to 30 characters too.
    """
    ok = pages.where("error is null")
    parts = []
    for kind, (column, source_type, least) in enumerate((("text_content", "text", 20), ("code_examples", "code", 30))):
        if kind or use_patterns:
            rows = ok.select("page_pos", F.coalesce("url", F.lit("unknown")).alias("url"), F.posexplode(column).alias("snippet", "body"))
            rows = rows.where(F.length(T.strip(F.col("body"))) > least)
            parts.append(rows.select("page_pos", "url", F.lit(kind).alias("kind"), "snippet", F.lit(source_type).alias("source_type"), "body"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def extract(pages: DataFrame, use_patterns: bool = True) -> DataFrame:
    """Raw triples of a corpus with provenance; pos orders them as emitted."""
    rows = triples_of(snippets(pages, use_patterns), "body")
    code = F.col("kind") == 1
    shown = F.when(code, F.concat(F.lit("Code: "), T.ellipsis(F.col("body"), 80))).otherwise(T.ellipsis(F.col("body"), 100))
    return rows.select(
        "subject", "relation", "object",
        F.when(code, F.least(F.lit(1.0), F.col("confidence") + F.lit(0.1))).otherwise(F.col("confidence")).alias("confidence"),
        F.lit("improved_patterns").alias("extraction_method"), "pattern_category", shown.alias("source_text"),
        F.col("url").alias("source_url"), "source_type", F.struct("page_pos", "kind", "snippet", "at").alias("pos"),
    )


def best_per_key(triples: DataFrame, keys: list[Column], valid: Column | None = None) -> DataFrame:
    """The row of highest confidence of each key, the earliest of equals; first_pos is the key's first position.

    One aggregate, so that tasks send one row a key; a null confidence counts as the lowest.
    """
    named = triples.select("*", *(k.alias(f"_k{i}") for i, k in enumerate(keys)))
    if valid is not None:
        named = named.where(valid)
    by = [f"_k{i}" for i in range(len(keys))]
    place = F.struct(F.col("confidence").isNull().alias("unknown"), (-F.col("confidence")).alias("low"), F.col("pos").alias("pos"))
    best = named.groupBy(*by).agg(F.min_by(F.struct(*triples.columns), place).alias("_best"), F.min("pos").alias("first_pos"))
    return best.select("_best.*", "first_pos")


def dedup_any_case(triples: DataFrame) -> DataFrame:
    """Best triple of each lower-cased, stripped key whose parts have two characters at least."""
    keys = [F.lower(T.strip(F.col(c))) for c in ("subject", "relation", "object")]
    long_enough = (F.length("_k0") >= 2) & (F.length("_k1") >= 2) & (F.length("_k2") >= 2)
    return best_per_key(triples, keys, long_enough)


def linearised(reply: Column) -> Column:
    """Triples of a sequence model's linearised output; the groups are read as relation, subject, object."""
    regex = r"(?s)<triplet>\s*(.*?)\s*<subj>\s*(.*?)\s*<obj>\s*(.*?)(?=<triplet>|$)"
    g = [F.regexp_extract_all(reply, F.lit(regex), F.lit(k)) for k in (1, 2, 3)]
    all_ = F.transform(F.arrays_zip(*(x.alias(f"g{i}") for i, x in enumerate(g))), lambda m: F.struct(
        T.extract_entity(m["g1"]).alias("subject"), T.extract_relation(m["g0"]).alias("relation"),
        T.extract_entity(m["g2"]).alias("object"), F.lit(0.8).alias("confidence"),
    ))
    return F.filter(all_, lambda t: (t["relation"] != "") & (F.length(t["subject"]) > 1) & (F.length(t["object"]) > 1))
