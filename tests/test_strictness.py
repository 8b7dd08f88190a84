"""Edges that must fail or be kept: out-of-range scores, late burst rows, JSON with trailing text, absent values."""

import json

import numpy as np
import pandas as pd
import pytest

from moodwire.operators import escalation as E


@pytest.mark.parametrize("bad", [float("inf"), float("-inf"), 20000.0, -1e300])
def test_out_of_range_scores_fail_on_every_path(bad):
    with pytest.raises(ValueError):
        E.quantize_one(bad)
    for n in (1, 128, 129):
        x = np.zeros(n)
        x[-1] = bad
        with pytest.raises(ValueError):
            E.quantize(x)
    assert E.quantize(np.array([np.nan, 0.1])).tolist() == [0, 100_000_000]


def test_json_objects_only(spark):
    from pyspark.sql import functions as F
    from moodwire.sources.codec import is_json_object
    good = ['{"a":1}', '  {"a":"x"} ', '{"a":1,"a":2}']
    bad = ['{"a":1} trailing', "{'a':1}", '{"a":1}{"b":2}', '{"a":1},{"b":2}', "[1]", "{bad", "", "3", None]
    df = spark.createDataFrame([(x,) for x in good + bad], "v string")
    got = {r["v"]: r["ok"] for r in df.select("v", is_json_object(F.col("v")).alias("ok")).collect()}
    assert all(got[x] for x in good) and not any(got[x] for x in bad), got


def test_keyed_records_keep_absent_values(spark):
    from moodwire.plans.dataprep import keyed_records
    df = spark.createDataFrame([("m1", None)], "message_id string, message_text string")
    assert json.loads(keyed_records(df).first()["value"]) == {"message_id": "m1", "message_text": None}


class _List:
    def __init__(self):
        self.rows = []

    def exists(self):
        return bool(self.rows)

    def get(self):
        return iter(self.rows)

    def put(self, rows):
        self.rows = list(rows)

    def appendList(self, rows):
        self.rows = self.rows + list(rows)

    def clear(self):
        self.rows = []


class _Handle:
    """One key's state and timers."""

    def __init__(self):
        self.lists, self.timers = {}, set()

    def getListState(self, name, schema):
        return self.lists.setdefault(name, _List())

    def registerTimer(self, ms):
        self.timers.add(ms)

    def getCurrentWatermarkInMs(self):
        return self.watermark

    def pass_time(self, processor, key, watermark):
        """Fire what is due; a timer set meanwhile waits for the next call, as in a micro-batch."""
        self.watermark, out = watermark, []
        for t in sorted(t for t in self.timers if t <= watermark):
            self.timers.discard(t)
            out += [tuple(r) for f in processor.handleExpiredTimer(key, self, None) for r in f.itertuples(index=False)]
        return out


def _burst(k, window):
    from moodwire.streaming.state import BurstProcessor
    p, h = BurstProcessor(k, window), _Handle()
    p.init(h)

    def feed(*times):
        cols = {"message_id": [f"m{t}" for t in times], "customer_name": ["n"] * len(times), "message_timestamp": list(times),
                "source_partition": [0] * len(times), "source_offset": list(range(len(times)))}
        assert not list(p.handleInputRows(("c",), iter([pd.DataFrame(cols)]), None))
    return p, h, feed


def test_late_burst_rows_count_everywhere():
    """A row that comes late is counted in its own window and in those of the rows behind it."""
    p, h, feed = _burst(3, 100)
    feed(100, 180)
    assert h.pass_time(p, ("c",), 90) == []
    feed(150)
    feed(1000)
    feed(160, 170)
    assert [r[3:] for r in h.pass_time(p, ("c",), 500)] == [(160, 3), (170, 4), (180, 5)]
    assert [r[0] for r in h.lists["pending"].rows] == [1000]
    assert h.pass_time(p, ("c",), 1000) == [] and h.lists["times"].rows == [(1000,)]


def test_idle_burst_customers_are_freed():
    p, h, feed = _burst(2, 100)
    feed(10, 20)
    assert [r[3:] for r in h.pass_time(p, ("c",), 50)] == [(20, 2)]
    assert h.lists["times"].rows and h.timers
    assert h.pass_time(p, ("c",), 121) == []
    assert not any(x.rows for x in h.lists.values()) and not h.timers


def test_within_stream_state_equals_batch_at_any_arrival():
    """Rows in any order, the watermark in steps: matches as defined, once each, and no state left behind."""
    import random
    from moodwire.operators.within import within_reference
    from moodwire.streaming.state import WithinProcessor
    for seed in range(60):
        rnd = random.Random(seed)
        times = sorted(rnd.randrange(3000) for _ in range(80))
        scores = [None if rnd.random() < 0.1 else rnd.randrange(-40, 36) / 10 for _ in times]
        within = rnd.choice([50, 400, 10_000])
        p, h = WithinProcessor(within), _Handle()
        p.init(h)
        rows = sorted(range(80), key=lambda i: times[i] + rnd.randrange(200))
        got, mark = [], 0
        for at in range(0, 80, 20):
            part = rows[at:at + 20]
            cols = {"message_timestamp": [times[i] for i in part], "source_partition": [0] * 20, "source_offset": part,
                    "sentiment_score": [scores[i] for i in part], "message_text": [f"t{i}" for i in part]}
            list(p.handleInputRows(("c", "n"), iter([pd.DataFrame(cols)]), None))
            mark = max(mark, max(times[i] for i in part) - 200)
            got += h.pass_time(p, ("c", "n"), mark)
        while h.timers:
            mark = max(mark + 1, min(h.timers))
            got += h.pass_time(p, ("c", "n"), mark)
        want = within_reference(scores, times, within)
        assert [(r[3], r[5]) for r in got] == [(b - a + 1, times[b]) for a, b in want], seed
        assert not any(x.rows for x in h.lists.values())


def test_kafka_source_fails_on_lost_offsets():
    from moodwire.streaming.jobs import kafka_source_options
    opts = kafka_source_options("b:1", "t", max_offsets_per_trigger=500)
    assert "failOnDataLoss" not in opts and opts["maxOffsetsPerTrigger"] == "500"
