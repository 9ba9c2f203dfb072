import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from starloom.llm.registry import ORACLES, QUERIES
from starloom.session import intermediates
from tools.check_queries import rows

FOLDER = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    assert {k.split("_")[0] for k in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    cur = con.execute(ORACLES[name])
    assert rows(df.columns, df.collect()) == rows([d[0] for d in cur.description], cur.fetchall())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = intermediates()
    out = corpus_pipeline.run(spark, FOLDER)
    assert intermediates() == before + 1  # the result alone is left
    assert out.columns == [*docs.columns, "ids"]
    ids = [r.doc_id for r in out.collect()]
    assert len(ids) == len(set(ids)) and 0 < len(ids) < docs.count()


def test_stages_take_odd_rows(spark, docs, no_docs):
    for start in (docs, no_docs, docs.withColumn("n_chars", docs.doc_id)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, start, FOLDER).columns == start.columns
        assert corpus_pipeline.tokens(spark, start, FOLDER).count() == start.count()
