"""Batch == stream for the escalation matcher and the burst rule, including a
restart from the checkpoint midway; J1 over a tolerant JSON file stream."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from moodwire.plans import registry
from moodwire.sources import codec, fixtures
from moodwire.streaming import jobs

SF = "/root/testdata/sf0.001"


def _slices(spark, d, n_slices):
    """Scored messages as JSON text files, one per time slice."""
    s = registry.sentiments(spark, SF)
    rows = [r.value for r in codec.encode_json(s.orderBy("message_timestamp")).collect()]
    step = (len(rows) + n_slices - 1) // n_slices
    parts = [rows[i:i + step] for i in range(0, len(rows), step)]
    return s, parts


def _write(d, i, lines):
    """Slice files get strictly increasing modification times: the file
    source feeds files in that order, which is the arrival order."""
    p = os.path.join(d, f"part-{i:04d}.json")
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    t = 1_700_000_000 + i * 10
    os.utime(p, (t, t))


def _key(r):
    return (r.customer_id, r.customer_name, round(r.karen_score_total, 9), r.trigger_message_count,
            r.recent_messages)


def _run_available(spark, src, out, ckpt, name):
    q = jobs.start(jobs.escalation_stream(jobs.read_sentiment_stream(spark, "text", src,
                                                                    {"maxFilesPerTrigger": "1"})),
                   "parquet", ckpt, name, path=out, trigger=None)
    q.processAllAvailable()
    q.stop()


def test_escalation_stream_equals_batch_with_restart(spark):
    base = tempfile.mkdtemp(prefix="mw-stream-", dir="/tmp")
    src, out, ckpt = (os.path.join(base, x) for x in ("src", "out", "ckpt"))
    os.makedirs(src)
    s, parts = _slices(spark, src, 6)
    for i, p in enumerate(parts[:3]):
        _write(src, i, p)
    _run_available(spark, src, out, ckpt, "esc_a")
    for i, p in enumerate(parts[3:], start=3):
        _write(src, i, p)
    _run_available(spark, src, out, ckpt, "esc_b")
    got = sorted(_key(r) for r in spark.read.parquet(out).collect())
    exp = sorted(_key(r) for r in registry.escalation_matches(spark, SF).collect())
    assert len(exp) == 36 and got == exp


def test_burst_stream_equals_batch(spark):
    from moodwire.operators.burst import burst_rule
    base = tempfile.mkdtemp(prefix="mw-burst-", dir="/tmp")
    src, ckpt = os.path.join(base, "src"), os.path.join(base, "ckpt")
    os.makedirs(src)
    s, parts = _slices(spark, src, 4)
    for i, p in enumerate(parts):
        _write(src, i, p)
    k, w = 3, 24 * 3_600_000
    end = dict(json.loads(parts[-1][0]), customer_id="end of stream", message_timestamp=4_000_000_000_000,
               sentiment_category="F - Very Negative")
    _write(src, 9, [json.dumps(end)])            # moves the watermark past all rows
    stream = jobs.burst_stream(jobs.read_sentiment_stream(spark, "text", src, {"maxFilesPerTrigger": "1"}), k, w)
    q = stream.writeStream.format("memory").queryName("burst_mem").option("checkpointLocation", ckpt).start()
    q.processAllAvailable()
    q.stop()
    got = sorted(tuple(r) for r in spark.sql("SELECT message_id, burst_count FROM burst_mem").collect())
    exp = sorted(tuple(r) for r in burst_rule(s, k=k, window_ms=w).select("message_id", "burst_count").collect())
    assert len(exp) == 15 and got == exp


def test_sentiment_stream_tolerant_json(spark):
    base = tempfile.mkdtemp(prefix="mw-j1-", dir="/tmp")
    src, ckpt = os.path.join(base, "src"), os.path.join(base, "ckpt")
    os.makedirs(src)
    good = {"message_id": "m1", "customer_id": "cust_00001", "customer_name": "Ann",
            "message_timestamp": 1703692215123, "message_text": "error happened",
            "metadata": {"session_id": "sess_1", "user_agent": "x", "ip_country": "US"},
            "kafka_partition": 1, "kafka_offset": 7}
    no_meta = {"message_id": "m2", "customer_id": "cust_00002", "customer_name": "Bo",
               "message_timestamp": 1703692215124, "message_text": "purchase"}
    blank = dict(no_meta, message_id="m3", message_text="   ")
    tab = dict(no_meta, message_id="m4", message_text="\t\n")
    lines = [json.dumps(good), "{bad", json.dumps(no_meta), json.dumps(blank), json.dumps(tab)]
    _write(src, 0, lines)
    st = jobs.sentiment_stream(jobs.read_message_stream(spark, "text", src))
    q = st.writeStream.format("memory").queryName("j1_mem").option("checkpointLocation", ckpt).start()
    q.processAllAvailable()
    q.stop()
    rows = {r.message_id: r for r in spark.sql("SELECT * FROM j1_mem").collect()}
    assert set(rows) == {"m1", "m2", "m4"}
    assert rows["m1"].ip_country == "US" and rows["m1"].source_partition == 1 and rows["m1"].source_offset == 7
    assert rows["m2"].ip_country is None
    assert rows["m1"].sentiment_score == -0.8 and rows["m1"].sentiment_category == "F - Very Negative"
    assert rows["m4"].sentiment_score == 0.0


def test_kafka_options_are_plain_dicts():
    o = jobs.kafka_source_options("b:9092", "customer_messages", client={"request.timeout.ms": 60000})
    assert o["subscribe"] == "customer_messages" and o["startingOffsets"] == "latest"
    assert o["kafka.request.timeout.ms"] == "60000"
    assert jobs.kafka_sink_options("b:9092", "t")["topic"] == "t"
    d = jobs.kafka_source_options("b:9092", jobs.TOPIC_SENTIMENTS, starting="earliest")
    assert d["kafka.metadata.max.age.ms"] == "30000" and d["startingOffsets"] == "earliest"
    p = jobs.kafka_sink_options("b:9092", jobs.TOPIC_MESSAGES, client=jobs.PRODUCER_CLIENT)
    assert p["kafka.acks"] == "all" and p["kafka.compression.type"] == "snappy" and p["kafka.retries"] == "3"


def test_chained_streams_j1_to_j2(spark):
    """J1 writes scored messages as JSON to a path; J2 reads that path as its
    source (the topic between them), giving the batch escalations."""
    base = tempfile.mkdtemp(prefix="mw-chain-", dir="/tmp")
    src, mid, out = (os.path.join(base, x) for x in ("src", "mid", "out"))
    os.makedirs(src)
    m = fixtures.messages(spark, SF)
    payload = m.select(*[c for c in m.columns if c != "kafka_timestamp"])
    lines = [r.value for r in codec.encode_json(payload.orderBy("message_timestamp")).collect()]
    _write(src, 0, lines)
    q1 = jobs.start(jobs.sentiment_stream(jobs.read_message_stream(spark, "text", src)), "text",
                    os.path.join(base, "c1"), "j1_chain", path=mid, trigger=None, json_value=True)
    q1.processAllAvailable()
    q1.stop()
    q2 = jobs.start(jobs.escalation_stream(jobs.read_sentiment_stream(spark, "text", mid)), "parquet",
                    os.path.join(base, "c2"), "j2_chain", path=out, trigger=None)
    q2.processAllAvailable()
    q2.stop()
    got = sorted((r.customer_id, r.trigger_message_count, round(r.karen_score_total, 9))
                 for r in spark.read.parquet(out).collect())
    exp = sorted((r.customer_id, r.trigger_message_count, round(r.karen_score_total, 9))
                 for r in registry.escalation_matches(spark, SF).collect())
    assert got == exp and len(got) == 36


def test_read_jsonl_quarantine(spark):
    d = tempfile.mkdtemp(prefix="mw-jsonl-in-", dir="/tmp")
    p = os.path.join(d, "chats.jsonl")
    with open(p, "w") as f:
        f.write(json.dumps({"message_id": "a", "customer_name": "X"}) + "\t\n\n   \n\t \u3000\n{oops\n")
    good, bad = codec.read_jsonl(spark, p)
    assert [r.message_id for r in good.collect()] == ["a"]
    assert [r.raw for r in bad.collect()] == ["{oops"]


def test_trend_stream_equals_batch_after_sentinel(spark):
    """Append-mode windows close when the watermark passes; a far-future
    sentinel row closes the last ones, then the stream equals the batch panel."""
    from moodwire.plans import serving
    base = tempfile.mkdtemp(prefix="mw-trend-", dir="/tmp")
    src, ckpt = os.path.join(base, "src"), os.path.join(base, "ckpt")
    os.makedirs(src)
    s, parts = _slices(spark, src, 3)
    for i, p in enumerate(parts):
        _write(src, i, p)
    sentinel = json.loads(parts[-1][-1])
    sentinel.update(message_id="sentinel", message_timestamp=4_102_444_800_000, sentiment_score=0.0)
    _write(src, len(parts), [json.dumps(sentinel)])
    hour = 3_600_000
    st = jobs.trend_stream(jobs.read_sentiment_stream(spark, "text", src, {"maxFilesPerTrigger": "1"}), "1 hour")
    q = st.writeStream.format("memory").queryName("trend_mem").outputMode("append") \
        .option("checkpointLocation", ckpt).start()
    q.processAllAvailable()
    q.stop()
    got = sorted((r.bucket_start_ms, r.msgs, round(r.avg_sentiment, 9))
                 for r in spark.sql("SELECT * FROM trend_mem").collect())
    exp = sorted((r.bucket_start_ms, r.msgs, round(r.avg_sentiment, 9))
                 for r in serving.ts_sentiment_trend(s, hour).collect())
    assert got == exp


def test_dedup_stream_drops_repeats(spark):
    base = tempfile.mkdtemp(prefix="mw-dedup-", dir="/tmp")
    src, ckpt = os.path.join(base, "src"), os.path.join(base, "ckpt")
    os.makedirs(src)
    s, parts = _slices(spark, src, 2)
    _write(src, 0, parts[0])
    _write(src, 1, parts[0][:50] + parts[1])     # at-least-once repeats
    old = dict(json.loads(parts[0][0]), message_id="from long ago", message_timestamp=1_000)
    _write(src, 2, [json.dumps(old)] * 2)        # late by years, and repeated
    st = jobs.dedup_stream(jobs.read_sentiment_stream(spark, "text", src, {"maxFilesPerTrigger": "1"}))
    q = st.writeStream.format("memory").queryName("dedup_mem").option("checkpointLocation", ckpt).start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("SELECT count(*) FROM dedup_mem").first()[0] == s.count() + 1


def _burst_brute(rows, k, w):
    """Plain definition: per row, rows of its customer with ts in [t - w, t]."""
    out = []
    for c, name, mid, t in rows:
        n = sum(1 for c2, _, _, t2 in rows if c2 == c and t - w <= t2 <= t)
        if n >= k:
            out.append((c, name, mid, t, n))
    return sorted(out, key=_nulls_first)


def _nulls_first(row):
    return tuple((x is not None, x if x is not None else 0) for x in row)


def test_burst_rule_equals_brute_force_with_hot_key_ties_and_duplicates(spark):
    import random
    from moodwire.operators.burst import VERY_NEGATIVE, burst_rule
    rnd = random.Random(5)
    rows = []
    for i in range(3000):                                   # one hot customer, dense in time
        rows.append(("hot", "H", f"h{i}", 1_000 + rnd.randint(0, 4000)))
    for c in range(40):
        for i in range(rnd.randint(1, 30)):
            rows.append((f"c{c}", f"N{c}", f"c{c}m{i}", rnd.randint(0, 50_000)))
    rows += rows[:5]                                        # exact duplicates
    rows.append((None, "nobody", "x1", 10))                 # NULL key is one customer
    rows.append((None, "nobody", "x2", 12))
    df = spark.createDataFrame([(c, n, m, t, VERY_NEGATIVE) for c, n, m, t in rows],
                               "customer_id string, customer_name string, message_id string, "
                               "message_timestamp long, sentiment_category string")
    got = sorted((tuple(r) for r in burst_rule(df, k=2, window_ms=300, partitions=8).collect()),
                 key=_nulls_first)
    assert got == _burst_brute(rows, 2, 300)


def test_burst_ranks_split_a_hot_customer(spark):
    from pyspark.sql import functions as F
    from moodwire.operators.burst import VERY_NEGATIVE
    df = spark.range(20_000).select(F.lit("hot").alias("_c"), F.col("id").alias("_ts"), F.lit(1).alias("_k"))
    parts = df.repartitionByRange(8, "_c", "_ts", "_k").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts >= 6 and VERY_NEGATIVE


def test_launch_three_jobs_over_folder_topics(spark, scratch):
    """J1 -> J2 -> J3 started by topic name over folder topics; the serving
    tables then answer the dashboard queries like the batch plan."""
    from moodwire.plans import serving
    from moodwire.streaming import launch
    topics = launch.Topics(root=os.path.join(scratch, "topics"))
    m = fixtures.messages(spark, SF)
    payload = m.select(*[c for c in m.columns if c != "kafka_timestamp"])
    lines = [r.value for r in codec.encode_json(payload.orderBy("message_timestamp")).collect()]
    os.makedirs(os.path.join(scratch, "topics", jobs.TOPIC_MESSAGES))
    _write(os.path.join(scratch, "topics", jobs.TOPIC_MESSAGES), 0, lines)
    for start, ck in ((launch.start_sentiment_job, "c1"), (launch.start_escalation_job, "c2")):
        q = start(spark, topics, os.path.join(scratch, ck), trigger=None)
        q.processAllAvailable()
        q.stop()
    tables = os.path.join(scratch, "tables")
    for q in launch.start_serving_ingest(spark, topics, tables, os.path.join(scratch, "c3"), trigger=None):
        q.awaitTermination()
    launch.register_serving_tables(spark, tables, recreate=True)
    s, r = spark.table("sentiments_rt"), spark.table("karen_rebuttals_rt")
    batch = registry.sentiments(spark, SF)
    assert s.count() == batch.count() and r.count() == 36
    got = sorted(tuple(x) for x in serving.q_geographic(s, digits=6).collect())
    exp = sorted(tuple(x) for x in serving.q_geographic(batch, digits=6).collect())
    assert got == exp
    assert serving.q_top_escalators(r, digits=6).count() == 10


def test_burst_stream_counts_peers_like_the_batch_frame(spark):
    """Rows sharing a timestamp are peers: the stream counts them together,
    as the batch RANGE frame does (here all within one micro-batch)."""
    from moodwire.operators.burst import VERY_NEGATIVE, burst_rule
    from moodwire.streaming import replay
    rows = [("c1", "A", f"m{i}", t, VERY_NEGATIVE, 0, i) for i, t in enumerate([100, 100, 100, 150, 400, 400, 900])]
    rows += [("c2", "B", f"n{i}", t, VERY_NEGATIVE, 1, i) for i, t in enumerate([10, 20, 20, 20])]
    df = spark.createDataFrame(rows, "customer_id string, customer_name string, message_id string, "
                                     "message_timestamp long, sentiment_category string, source_partition int, "
                                     "source_offset long")
    batch = sorted(tuple(r) for r in burst_rule(df, k=3, window_ms=300).collect())
    stream = replay.replay(df, lambda st: jobs.burst_stream(st, k=3, window_ms=300), "burst_peers", slices=1, end_ms=60_000)
    assert sorted(tuple(r) for r in stream.collect()) == batch
    assert len(batch) == 9


def test_escalation_stream_decides_decimal_ties_like_the_fold(spark):
    """One-decimal scores hit the threshold exactly and often; the stream
    processor decides by the in-order double sum, across batches."""
    import random

    from moodwire.operators.escalation import fold_reference
    from moodwire.streaming import replay
    from moodwire.streaming.state import MATCH_OUTPUT, EscalationProcessor
    rnd = random.Random(9)
    vals = [-0.7, -0.3, -0.5, -0.1, 0.1, 0.3, 0.8, -1.0]
    seqs = {f"c{i}": [rnd.choice(vals) for _ in range(rnd.randint(20, 300))] for i in range(6)}
    rows = [(c, "N", 1_000 + 10 * i, 0, i, x, f"{c}-{i}") for c, xs in seqs.items() for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "customer_id string, customer_name string, message_timestamp long, "
                                     "source_partition int, source_offset long, sentiment_score double, "
                                     "message_text string")

    def build(st):
        return (st.groupBy("customer_id", "customer_name")
                .transformWithStateInPandas(EscalationProcessor(), MATCH_OUTPUT, "Append", "None"))
    out = replay.replay(df, build, "ties_stream", key_cols=("customer_id", "customer_name"), slices=3)
    got = sorted((r.customer_id, r.trigger_order, r.trigger_message_count, r.karen_score_total)
                 for r in out.collect())
    exp = sorted((c, 1_000 + 10 * b, n, t) for c, xs in seqs.items() for _, b, t, n in fold_reference(xs))
    assert got == exp and len(exp) > 20


def test_j1_has_no_sink_shuffle_unless_asked(spark):
    m = fixtures.messages(spark, SF)
    plain = jobs.sentiment_stream(m)
    assert "RoundRobinPartitioning" not in plain._jdf.queryExecution().executedPlan().toString()
    spread = jobs.sentiment_stream(m, sink_partitions=jobs.SENTIMENT_SINK_PARALLELISM)
    assert spread.rdd.getNumPartitions() == 4
    assert sorted(r.message_id for r in spread.collect()) == sorted(r.message_id for r in plain.collect())


def test_serving_ingest_removes_repeats(spark, scratch):
    """A topic that repeats every record gives each message once, unless told otherwise."""
    from moodwire.streaming import launch
    topics = launch.Topics(root=os.path.join(scratch, "topics"))
    batch = registry.sentiments(spark, SF).limit(200)
    lines = [r.value for r in codec.encode_json(batch).collect()]
    for topic, content in ((jobs.TOPIC_SENTIMENTS, lines + lines), (jobs.TOPIC_RESPONSES, [])):
        os.makedirs(os.path.join(scratch, "topics", topic))
        _write(os.path.join(scratch, "topics", topic), 0, content)
    for name, more, want in (("twice", {"repeat_ttl": None}, 2 * len(lines)), ("once", {}, len(lines))):
        tables = os.path.join(scratch, name)
        for q in launch.start_serving_ingest(spark, topics, tables, os.path.join(scratch, f"c-{name}"), trigger=None, **more):
            q.awaitTermination()
        launch.register_serving_tables(spark, tables, recreate=True)
        assert spark.table("sentiments_rt").count() == want
