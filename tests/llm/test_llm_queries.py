"""Registered queries: SQL twins, whole tables, and the pipeline."""

import duckdb
import pytest

import __spark_entry__ as ent
import corpus_pipeline
from llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_all_registered():
    qs = ent.queries()
    assert set(QUERIES) <= set(qs) and "pipeline" in qs
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted((tuple(r) for r in df.select(*cols).collect()), key=key) == sorted(cur.fetchall(), key=key)


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        rows = out.collect()
        ids = {r["doc_id"] for r in rows}
        assert ids <= seen and rows, name
        if name != "byte_bpe":
            assert out.columns == docs.columns
            docs, seen = spark.createDataFrame(rows, docs.schema), ids
    assert {"token_ids", "n_tokens"} <= set(out.columns) and "text" not in out.columns
    assert all(r["n_tokens"] == len(r["token_ids"]) > 0 for r in rows)
