"""The registered queries of this package against their SQL, and the pipeline against its parts."""

import os

import duckdb
import pytest

import corpus_pipeline
from earshot.llm import hosts, packing, pseudonyms, queries, simhash


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, sf_dir, duck, name):
    got = queries.QUERIES[name](spark, sf_dir).toPandas()
    want = duck.execute(queries.ORACLE[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    got, want = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
    assert len(got) == len(want)
    # A column with nulls loses its kind on the way to pandas.
    whole = [c for c in columns if not want[c].isna().any()]
    assert [got[c].dtype.kind for c in whole] == [want[c].dtype.kind for c in whole]
    assert (((got == want) | (got.isna() & want.isna())).all()).all()


def test_pipeline_is_its_stages(spark, sf_dir, docs):
    good = hosts.judge(docs).filter("kept").select("row.*")
    assert good.columns == docs.columns and 0 < good.count() < docs.count()
    first = simhash.first_of_each(good)
    classes = simhash.near_duplicates(good)
    assert {r.doc_id for r in first.collect()} == {r.component_id for r in classes.collect()}
    clean = pseudonyms.replaced(first, queries.KEY)
    want = packing.packed_documents(clean)
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, want.collect()))


def test_stages_take_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "")
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), out.schema)
        corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()


def test_pipeline_gives_the_rewritten_text(spark, sf_dir, docs):
    first = simhash.first_of_each(hosts.judge(docs).filter("kept").select("row.*"))
    want = {r.doc_id: r.text for r in pseudonyms.replaced(first, queries.KEY).collect()}
    assert any(want[r.doc_id] != r.text for r in first.collect())
    got = {}
    for r in sorted(corpus_pipeline.run(spark, sf_dir).collect(), key=lambda r: (r.doc_id, r.piece)):
        got[r.doc_id] = got.get(r.doc_id, "") + r.text
    assert got == want
