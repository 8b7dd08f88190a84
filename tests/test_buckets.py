"""Streams of many customers: one group and a handful of state calls for a bucket of them, results per customer."""

import random

import pandas as pd
from pyspark.sql import functions as F

from moodwire.operators.escalation import fold_reference
from moodwire.streaming import jobs, state
from moodwire.streaming.state import BucketProcessor, BurstProcessor, EscalationProcessor, WithinProcessor


class _State:
    """One state variable of one group, in the forms value, list and map; counts calls."""

    calls = 0

    def __init__(self):
        self.rows, self.map = [], {}

    def get(self):
        _State.calls += 1
        return iter(self.rows) if self.is_list else (self.rows[0] if self.rows else None)

    def exists(self):
        _State.calls += 1
        return bool(self.rows)

    def put(self, rows):
        _State.calls += 1
        self.rows = list(rows)

    def update(self, row):
        self.put([row])

    def appendList(self, rows):
        _State.calls += 1
        self.rows = self.rows + list(rows)

    def clear(self):
        self.put([])

    def getValue(self, key):
        _State.calls += 1
        return self.map.get(key)

    def updateValue(self, key, value):
        _State.calls += 1
        self.map[key] = value

    def removeKey(self, key):
        _State.calls += 1
        del self.map[key]


class _Handle:
    def __init__(self):
        self.vars, self.timers, self.watermark = {}, set(), 0

    def _var(self, name, is_list):
        v = self.vars.setdefault(name, _State())
        v.is_list = is_list
        return v

    def getValueState(self, name, schema):
        return self._var(name, False)

    def getListState(self, name, schema):
        return self._var(name, True)

    def getMapState(self, name, key, value):
        return self._var(name, False)

    def registerTimer(self, ms):
        _State.calls += 1
        self.timers.add(ms)

    def getCurrentWatermarkInMs(self):
        return self.watermark

    def pass_time(self, processor, key, watermark):
        self.watermark, out = watermark, []
        for t in sorted(t for t in self.timers if t <= watermark):
            self.timers.discard(t)
            out += [tuple(r) for f in processor.handleExpiredTimer(key, self, None) for r in f.itertuples(index=False)]
        return out

    def left(self):
        return any(v.rows or v.map for v in self.vars.values())


def _frame(rows):
    return pd.DataFrame(rows, columns=["customer_id", "customer_name", "message_timestamp", "source_partition", "source_offset",
                                       "sentiment_score", "message_text", "message_id"])


def _rows(rnd, customers, n):
    rows = []
    for k in range(n):
        c = rnd.randrange(customers)
        x = None if rnd.random() < 0.05 else rnd.randrange(-40, 36) / 10
        rows.append((f"c{c}", None if c == 0 else f"N{c}", rnd.randrange(3000), 0, k, x, f"t{k}", f"m{k}"))
    return rows


def test_one_group_folds_many_customers_with_few_state_calls():
    rnd = random.Random(3)
    rows = sorted(_rows(rnd, 200, 6000), key=lambda r: r[2])
    p, h = EscalationProcessor(), _Handle()
    p.init(h)
    _State.calls, got = 0, []
    for at in range(0, 6000, 1500):
        part = rows[at:at + 1500]
        rnd.shuffle(part)
        frames = [_frame(part[:700]), _frame(part[700:])]
        got += [tuple(r) for f in p.handleInputRows((7,), iter(frames), None) for r in f.itertuples(index=False)]
    assert _State.calls <= 2 * 4
    want = []
    for c in range(200):
        mine = sorted((r for r in rows if r[0] == f"c{c}"), key=lambda r: r[2:5])
        want += [(f"c{c}", mine[b][2], n, t) for _, b, t, n in fold_reference([r[5] for r in mine])]
    assert sorted((r[0], r[5], r[3], r[2]) for r in got) == sorted(want) and len(want) > 200


def test_texts_of_long_matches_leave_the_value_and_come_back_whole():
    p, h = EscalationProcessor(), _Handle()
    p.init(h)
    n, t = 3 * EscalationProcessor.PART_TEXTS, 0
    for _ in range(6):
        rows = [("long", None, t + i, 0, t + i, 0.1, f"a{t + i}", "") for i in range(n // 4)] + [("short", "S", t, 0, t, 1.0, "s", "")]
        t += n // 4
        assert not list(p.handleInputRows((7,), iter([_frame(rows)]), None))
    assert len(h.vars["parts"].map) >= 3 and len(h.vars["open"].rows[0][0]) < 20_000
    end = [("long", None, t, 0, t, -1000.0, "end", ""), ("short", "S", t, 0, t, -1000.0, "end", "")]
    got = {r.customer_id: r for f in p.handleInputRows((7,), iter([_frame(end)]), None) for r in f.itertuples(index=False)}
    assert got["long"].recent_messages == p.sep.join([*(f"a{i}" for i in range(t)), "end"])
    assert got["long"].trigger_message_count == t + 1 and got["short"].recent_messages == p.sep.join(["s"] * 6 + ["end"])
    assert not h.left()


def _drain(p, h, key, parts, wait):
    got, mark = [], 0
    for part in parts:
        list(p.handleInputRows(key, iter([_frame(part)]), None))
        mark = max(mark, max(r[2] for r in part) - wait)
        got += h.pass_time(p, key, mark)
    while h.timers:
        mark = max(mark + 1, min(h.timers))
        got += h.pass_time(p, key, mark)
    assert not h.left()
    return got


def test_bucketed_event_time_results_are_those_of_single_customers():
    """Rows out of order; the bucket's results equal those of a group per customer, with fewer state calls; no state stays."""
    for seed in range(12):
        for make in (lambda: BurstProcessor(3, 150), lambda: WithinProcessor(400)):
            rnd = random.Random(seed)
            rows = sorted(_rows(rnd, 25, 1200), key=lambda r: r[2] + rnd.randrange(200))
            parts = [rows[i:i + 300] for i in range(0, 1200, 300)]
            p, h = BucketProcessor(make()), _Handle()
            p.init(h)
            _State.calls = 0
            got = _drain(p, h, (3,), parts, 200)
            bucket_calls, want = _State.calls, []
            _State.calls = 0
            for who in {r[:2] for r in rows}:
                p, h = make(), _Handle()
                p.init(h)
                want += _drain(p, h, who, [s for s in ([r for r in part if r[:2] == who] for part in parts) if s], 200)
            assert sorted(map(str, got)) == sorted(map(str, want)) and want, seed
            if isinstance(p, WithinProcessor):
                assert bucket_calls < _State.calls


def test_stream_groups_do_not_grow_with_customers(spark):
    """However many customers, at most CUSTOMER_BUCKETS groups; a customer's rows share one (nulls too)."""
    many = spark.range(50_000).select(
        F.when(F.col("id") > 0, F.concat(F.lit("c"), F.expr("id div 2"))).alias("customer_id"), F.lit(None).cast("string").alias("customer_name"),
        F.col("id").alias("message_timestamp"), F.lit("more").alias("unused"))
    grouped = state.in_buckets(many, ["customer_id", "customer_name"], ["message_timestamp"])
    counts = grouped.agg(F.count("*").alias("n"), F.countDistinct("customer_id").alias("c")).agg(F.count("*"), F.sum("n"), F.sum("c")).first()
    assert counts[0] <= state.CUSTOMER_BUCKETS and counts[1] == 50_000 and counts[2] == 25_000
    plan = jobs.escalation_stream(spark.readStream.format("rate").load().select(
        F.col("value").cast("string").alias("customer_id"), F.lit("n").alias("customer_name"), F.col("value").alias("message_timestamp"),
        F.lit(0).alias("source_partition"), F.col("value").alias("source_offset"), F.lit(1.0).alias("sentiment_score"), F.lit("t").alias("message_text")))
    assert "customer_bucket" in plan._jdf.queryExecution().analyzed().toString()
