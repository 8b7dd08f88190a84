"""Every registered query against its DuckDB twin on sf0.001 (the driver's
gate runs the same pairs at sf0.01)."""

import math
import os

import pytest

import __spark_entry__ as ent

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def _key(row):
    return tuple((x is None, type(x).__name__, x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_a_callable():
    assert set(ent.oracle_sql()) <= set(ent.queries())
    assert len(ent.oracle_sql()) >= 35


@pytest.mark.parametrize("name", sorted(ent.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = ent.queries()[name](spark, SF)
    got = sorted((tuple(_norm(v) for v in r) for r in df.collect()), key=_key)
    cur = duck.execute(ent.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    order = [cols.index(c) for c in df.columns]
    exp = sorted((tuple(_norm(r[i]) for i in order) for r in cur.fetchall()), key=_key)
    assert got == exp


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.columns == ["customer_id", "customer_name", "karen_score_total", "rebuttal_text", "rebuttal_model",
                          "generated_timestamp", "trigger_message_count", "recent_messages"]
    assert df.count() == 36
