"""Every query with an SQL twin gives the twin's rows."""

import duckdb
import pytest

from loomgraph.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def rows(names, records):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(repr([plain(r[i]) for i in order]) for r in records)


def same(spark, sf_dir, query, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    df = query(spark, sf_dir)
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, got.fetchall())


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_matches_sql(spark, sf_dir, name):
    same(spark, sf_dir, catalogue.queries()[name], catalogue.oracle_sql()[name])


def test_every_twin_has_a_query():
    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())


def test_entry_and_rows_only_queries(spark, sf_dir):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["rel_type", "n"]
    for name in ("graph_statistics", "scrape_quality", "page_text", "pipeline_counts"):
        assert e.queries()[name](spark, sf_dir).count() > 0
