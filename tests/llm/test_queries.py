"""Registered queries with an SQL twin give the twin's rows."""

import pytest

from loomgraph.llm import catalogue
from tests.test_oracles import same


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_matches_sql(spark, sf_dir, name):
    same(spark, sf_dir, catalogue.queries()[name], catalogue.oracle_sql()[name])


def test_names():
    q = catalogue.queries()
    assert "pipeline" in q and [n for n in range(1, 11) if not any(k.startswith(f"op{n}_") for k in q)] == []


#: Column names and types that the contracts of the registered queries fix.
CONTRACT = {
    "op2_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op3_mix": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op4_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op5_pieces": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op6_ngram_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op7_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8_langid": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op9_ann": "query_id bigint, rank int, vec_id bigint, score double",
    "op10_media": "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string",
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract_columns(spark, name):
    out = catalogue.queries()[name](spark, "/root/testdata/sf0.001")
    kinds = {f.name: f.dataType.simpleString() for f in out.schema}
    assert {k: kinds.get(k) for k in (c.split()[0] for c in CONTRACT[name].split(", "))} == dict(c.split() for c in CONTRACT[name].split(", "))
