"""Data preparation, codecs, user lookup, required-field report."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from moodwire import schemas
from moodwire.operators.lookup import user_lookup
from moodwire.operators.quality import required_field_report
from moodwire.plans import dataprep
from moodwire.sources import codec, fixtures, pools

SF = "/root/testdata/sf0.001"


def test_expand_counts_in_range(spark):
    pool = pools.user_pool_from_customers(spark, SF)
    e = dataprep.expand_users(pool).groupBy("customer_id", "is_karen").agg(F.count("*").alias("n")).collect()
    assert len(e) == 150
    for r in e:
        lo, hi = (30, 40) if r.is_karen else (5, 12)
        assert lo <= r.n <= hi
    again = dataprep.expand_users(pool).count()
    assert again == sum(r.n for r in e)  # stable across recomputation


def test_pick_templates_and_unknown_type(spark):
    pool = pools.user_pool_from_customers(spark, SF)
    rows = dataprep.expand_users(pool)
    tpl = pools.templates_from_conversations(spark, SF)
    picked = dataprep.pick_templates(rows, tpl)
    assert picked.count() == rows.count()
    bad = rows.withColumn("sentiment_types", F.array(F.lit("no_such_type")))
    with pytest.raises(Exception, match="No template found"):
        dataprep.pick_templates(bad, tpl).collect()


def test_upsample_exact_count_and_new_ids(spark):
    m = fixtures.messages(spark, SF).drop("kafka_timestamp", "kafka_partition", "kafka_offset")
    n = m.count()
    up = dataprep.upsample(m, n + 123)
    assert up.count() == n + 123
    assert up.select("message_id").distinct().count() == n + 123
    assert dataprep.upsample(m, n - 5).count() == n


def test_build_messages_schema(spark):
    pool = pools.user_pool_from_customers(spark, SF)
    msgs = dataprep.generate_messages(pool, pools.templates_from_conversations(spark, SF), at_ms=F.lit(1))
    assert [(f.name, f.dataType.simpleString()) for f in msgs.schema] == \
        [(f.name, f.dataType.simpleString()) for f in schemas.MESSAGE_PAYLOAD]
    r = msgs.first()
    assert r.metadata.session_id.startswith("sess_") and len(r.metadata.session_id) == 13
    assert len(r.message_id) == 36


def test_codec_tolerant_and_strict(spark):
    lines = [json.dumps({"message_id": "a", "message_timestamp": 1, "message_text": "x"}), "{bad",
             json.dumps({"message_id": "b", "message_timestamp": "oops"})]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = {r.message_id: r for r in codec.decode_messages(df).collect()}
    assert set(got) == {"a", "b"} and got["a"].metadata is None and got["b"].message_timestamp is None
    assert [r.raw for r in codec.quarantine(df, schemas.MESSAGE_PAYLOAD).collect()] == ["{bad"]
    with pytest.raises(Exception):
        codec.decode_sentiments(df.filter(F.col("value") == "{bad"), strict=True).collect()


def test_user_lookup_default_record(spark):
    msgs = spark.createDataFrame([("m1", "cust_99999"), ("m2", "cust_00001")], "message_id string, customer_id string")
    pool = spark.createDataFrame([("cust_00001", "Karen P.", "USA", ["karen"], True),
                                  ("cust_00001", "Dup", "X", ["normal"], False)], schemas.USER_POOL)
    got = {r.message_id: r for r in user_lookup(msgs, pool).collect()}
    d = got["m1"]
    assert (d.name, d.country, d.sentiment_types, d.is_karen) == ("Customer_99999", "US", ["normal"], False)
    assert got["m2"].customer_id == "cust_00001" and len(got) == 2


def test_required_field_report_keeps_rows(spark):
    df = spark.createDataFrame([("a", "n"), ("", "n"), (None, None)], "message_id string, customer_name string")
    r = required_field_report(df).first()
    assert (r.total, r.missing_message_id, r.missing_customer_name) == (3, 2, 1)


def test_jsonl_sink_roundtrip(spark):
    from moodwire.sources.sinks import write_jsonl
    d = tempfile.mkdtemp(prefix="mw-jsonl-", dir="/tmp")
    m = fixtures.messages(spark, SF).select("message_id", "customer_name", "metadata")
    write_jsonl(m, os.path.join(d, "out"))
    back = spark.read.schema(m.schema).json(os.path.join(d, "out"))
    assert back.count() == m.count()


def test_serving_table_partitioned_and_pruned(spark):
    from moodwire.plans import registry, serving
    from moodwire.plans.sentiment import to_serving
    from moodwire.sources.sinks import DATE_COL, recreate_table, write_serving
    d = tempfile.mkdtemp(prefix="mw-serving-", dir="/tmp")
    path = os.path.join(d, "sentiments_rt")
    s = to_serving(registry.sentiments(spark, SF)).drop("message_date")
    write_serving(s, path, "message_timestamp", mode="overwrite")
    recreate_table(spark, "sentiments_rt_test", path, recreate=True)
    recreate_table(spark, "sentiments_rt_test", path)          # already there: not an error
    t = spark.table("sentiments_rt_test")
    assert t.count() == s.count()
    day = t.filter(F.col(DATE_COL) == "2024-01-02")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and day.count() > 0
    exact = serving.metrics(t, serving.SENTIMENT_METRICS, by=["ip_country"]).orderBy("ip_country").collect()
    approx = serving.metrics(t, serving.SENTIMENT_METRICS, by=["ip_country"], approx_distinct=True) \
        .orderBy("ip_country").collect()
    for a, b in zip(exact, approx):
        assert abs(a.unique_customers - b.unique_customers) <= max(1, 0.05 * a.unique_customers)


def test_broadcast_only_after_bounded_count(spark):
    from moodwire.operators.joins import broadcast_if_bounded
    na = fixtures.table(spark, SF, "nation")
    hinted = broadcast_if_bounded(na, 1000)
    assert "broadcast" in hinted._jdf.queryExecution().logical().toString().lower()
    ev = fixtures.table(spark, SF, "events")
    plain = broadcast_if_bounded(ev, 100)
    assert "broadcast" not in plain._jdf.queryExecution().logical().toString().lower()
    m = fixtures.messages(spark, SF)
    assert "BroadcastHashJoin" in m._jdf.queryExecution().executedPlan().toString()


def test_read_user_pool_and_templates(spark, scratch):
    from moodwire.sources.pools import TEMPLATE_TYPES, read_templates, read_user_pool
    pool = os.path.join(scratch, "user_pool.jsonl")
    with open(pool, "w", encoding="utf-8") as f:
        f.write('{"customer_id": "cust_1", "name": "Zoë", "country": "DEU", '
                '"sentiment_types": ["karen", "normal"], "is_karen": true}\n\n')
        f.write('{"customer_id": "cust_2", "name": "Bo", "country": "USA", '
                '"sentiment_types": ["funny"], "is_karen": false}\n')
    rows = sorted(read_user_pool(spark, pool).collect())
    assert [(r.customer_id, r.name, r.sentiment_types, r.is_karen) for r in rows] == [
        ("cust_1", "Zoë", ["karen", "normal"], True), ("cust_2", "Bo", ["funny"], False)]
    tpl = os.path.join(scratch, "templates.json")
    with open(tpl, "w", encoding="utf-8") as f:
        f.write(json.dumps({t: [f"{t} one", f"{t} two"] for t in TEMPLATE_TYPES}, indent=2))
    got = read_templates(spark, tpl).groupBy("type").count().collect()
    assert {r["type"]: r["count"] for r in got} == {t: 2 for t in TEMPLATE_TYPES}


def test_serving_ingest_stream_from_earliest(spark, scratch):
    """Scored rows arriving as a JSON file stream are ingested from the start
    into the date-partitioned serving table; a restart adds only new files."""
    from moodwire import schemas
    from moodwire.plans import registry
    from moodwire.sources.codec import encode_json
    from moodwire.sources.sinks import DATE_COL, recreate_table, stream_serving
    from moodwire.streaming.jobs import read_sentiment_stream
    src, out, ck = (os.path.join(scratch, d) for d in ("topic", "sentiments_rt", "ckpt"))
    s = registry.sentiments(spark, SF)
    first, second = s.filter(F.col("source_partition") < 2), s.filter(F.col("source_partition") >= 2)
    encode_json(first).select("value").write.text(os.path.join(src, "a"))
    stream = read_sentiment_stream(spark, "text", os.path.join(src, "*"))
    stream_serving(stream, out, "message_timestamp", ck, "ingest_a", trigger=None).awaitTermination()
    encode_json(second).select("value").write.text(os.path.join(src, "b"))
    stream = read_sentiment_stream(spark, "text", os.path.join(src, "*"))
    stream_serving(stream, out, "message_timestamp", ck, "ingest_b", trigger=None).awaitTermination()
    recreate_table(spark, "sentiments_rt_ingest", out, recreate=True)
    t = spark.table("sentiments_rt_ingest")
    assert DATE_COL in t.columns and set(schemas.MESSAGE_SENTIMENTS.names) <= set(t.columns)
    assert t.count() == s.count()
    assert t.select("message_id").distinct().count() == s.count()


def test_model_compare_counts_repeated_messages_once(spark):
    from moodwire.operators.compare import compare_models
    cols = "message_id string, sentiment_category string, sentiment_score double"
    a = spark.createDataFrame([("m1", "F", -0.8)] * 3 + [("m2", "C", 0.0)], cols)
    b = spark.createDataFrame([("m1", "F", -0.7)] * 2 + [("m2", "B", 0.4)], cols)
    got = {r.category_a: (r.msgs, r.agree, round(r.mean_abs_diff, 9)) for r in compare_models(a, b).collect()}
    assert got == {"F": (1, 1, 0.1), "C": (1, 0, 0.4)}


def test_dense_index_counts_all_rows_without_a_constant_key(spark):
    from moodwire.plans.dataprep import dense_index
    df = spark.range(1000).repartition(7)
    out = dense_index(df, "n")
    assert sorted(r["n"] for r in out.collect()) == list(range(1000)) and out.columns == ["id", "n"]
    assert dense_index(df.limit(0), "n").count() == 0


def test_upsample_copies_without_metadata_get_a_session(spark):
    from moodwire.plans.dataprep import upsample
    df = spark.createDataFrame([("m1", "c", "n", 1, "t", None)], "message_id string, customer_id string, customer_name string, "
                               "message_timestamp long, message_text string, metadata struct<session_id:string,user_agent:string,ip_country:string>")
    rows = upsample(df, 3).collect()
    assert len({r["message_id"] for r in rows}) == 3
    assert sum(r["metadata"] is not None and r["metadata"]["session_id"].startswith("sess_") for r in rows) == 2
