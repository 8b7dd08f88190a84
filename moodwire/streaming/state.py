"""Keyed stateful processors for Structured Streaming.

All run under ``groupBy(...).transformWithStateInPandas`` on the RocksDB
state store, so state spills to disk and is checkpointed with the
query. Customers are grouped in buckets (:func:`in_buckets`): state is called for per bucket, results are per customer. The unbounded matcher takes a key's rows of a micro-batch in (timestamp,
partition, offset) order and batches in arrival order; processors derived from
:class:`EventTimeProcessor` take all rows in that order, by the watermark.
"""

from __future__ import annotations

import bisect
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from moodwire.functions.text import MESSAGE_SEPARATOR
from moodwire.operators.escalation import ROW_LIMIT_UNITS, SCORE_SCALE, quantize, quantize_one
from moodwire.operators.within import closes

ORDER = ["message_timestamp", "source_partition", "source_offset"]


def _ordered(rows: Iterator[pd.DataFrame], cols: list[str]) -> list[list] | None:
    """A key's rows of this micro-batch as column lists (``cols``), in
    (timestamp, partition, offset) order. Rows usually arrive in time order;
    the full three-key sort runs only when timestamps do not strictly rise."""
    frames = [f for f in rows if len(f)]
    if not frames:
        return None
    pdf = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
    arrays = {c: pdf[c].to_numpy() for c in dict.fromkeys(cols + ORDER[:1])}
    ts = arrays[ORDER[0]]
    if len(ts) > 1 and not (ts[1:] > ts[:-1]).all():
        idx = np.lexsort([pdf[c].to_numpy() for c in reversed(ORDER)])
        return [arrays[c][idx].tolist() for c in cols]
    return [arrays[c].tolist() for c in cols]


MATCH_OUTPUT = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("karen_score_total", T.DoubleType()),
    T.StructField("trigger_message_count", T.LongType()),
    T.StructField("recent_messages", T.StringType()),
    T.StructField("trigger_order", T.LongType()),
])


def _by_customer(rows: Iterator[pd.DataFrame], names: list[str], cols: list[str]) -> dict[tuple, list[tuple]]:
    """The rows of a group's micro-batch as tuples of ``cols``, by customer (``names``), in order of arrival."""
    out: dict[tuple, list[tuple]] = {}
    for pdf in rows:
        who = zip(*(pdf[c].tolist() for c in names))
        for k, r in zip(who, zip(*(pdf[c].tolist() for c in cols))):
            out.setdefault(tuple(v if isinstance(v, str) else None for v in k), []).append(r)
    return out


def _in_order(row: tuple) -> tuple:
    """Sort key: (timestamp, partition, offset), nulls last."""
    return tuple((1, 0) if v is None or v != v else (0, v) for v in row[:3])


class EscalationProcessor(StatefulProcessor):
    """Row-pattern fold per (customer_id, customer_name), for groups of one customer or of many (:func:`in_buckets`).

    State: one value with each open match's running double sum, row count and non-NULL texts, read and written once
    per group and micro-batch. The texts of a long match leave it for a map, in parts of PART_TEXTS, which are
    read again only when the match closes, so neither its own rows nor other customers rewrite them. The texts are
    kept whole; nothing is truncated. The in-order double sum decides and is reported, as in the batch matcher;
    scores out of its range fail alike.
    """

    PART_TEXTS = 256

    def __init__(self, threshold: float = -5.0, separator: str = MESSAGE_SEPARATOR):
        self.threshold = threshold
        self.sep = separator

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "matches binary")
        self.parts = handle.getMapState("parts", "customer_id string, customer_name string, part long", "texts binary")

    def _stored(self, who: tuple, parts: int) -> list[str]:
        """The texts of a match's parts, which are freed."""
        texts = []
        for i in range(parts):
            texts += pickle.loads(self.parts.getValue((*who, i))[0])
            self.parts.removeKey((*who, i))
        return texts

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        thr, limit = self.threshold, (ROW_LIMIT_UNITS + 0.5) / SCORE_SCALE
        came = _by_customer(rows, ["customer_id", "customer_name"], [*ORDER, "sentiment_score", "message_text"])
        if not came:
            return
        state = self.open.get()
        matches: dict[tuple, tuple] = pickle.loads(state[0]) if state is not None else {}
        out = []
        for who, theirs in came.items():
            s, n, parts, pre = matches.pop(who, (0.0, 0, 0, []))
            for ts, _, _, x, txt in sorted(theirs, key=_in_order):
                x = None if x is None or x != x else float(x)
                if x is not None and not abs(x) <= limit:
                    raise ValueError(f"score out of range: {x}")
                txt = txt if isinstance(txt, str) else None
                if n == 0:
                    if x is not None and x > thr:
                        s, n, pre = x, 1, [txt] if txt is not None else []
                    continue
                if x is not None and s + x <= thr:
                    pre = self._stored(who, parts) + pre
                    recent = self.sep.join([*pre, txt]) if (pre and txt is not None) else None
                    out.append((*who, s + x, n + 1, recent, int(ts)))
                    s, n, parts, pre = 0.0, 0, 0, []
                else:
                    s, n = s + (x or 0.0), n + 1
                    if txt is not None:
                        pre.append(txt)
            if len(pre) >= self.PART_TEXTS:
                self.parts.updateValue((*who, parts), (pickle.dumps(pre),))
                parts, pre = parts + 1, []
            if n > 0:
                matches[who] = (s, n, parts, pre)
        if matches:
            self.open.update((pickle.dumps(matches),))
        elif state is not None:
            self.open.clear()
        if out:
            yield pd.DataFrame(out, columns=[f.name for f in MATCH_OUTPUT.fields])

    def close(self) -> None:
        pass


BURST_OUTPUT = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("message_id", T.StringType()),
    T.StructField("message_timestamp", T.LongType()),
    T.StructField("burst_count", T.LongType()),
])


class EventTimeProcessor(StatefulProcessor):
    """Rows of a key in event-time order, whatever order they arrive in.

    Arriving rows are appended to a reorder buffer. When the watermark has passed rows, no earlier ones can follow: a timer
    releases them in (timestamp, partition, offset) order to :meth:`advance`, so results are those of the batch operator over the
    same rows. Rows behind the watermark are late by the stream's own definition and are dropped by the engine before they
    get here; the delay of the watermark says how long rows are waited for. Runs under ``timeMode="EventTime"``.
    """

    #: Columns kept of each row, the first three being :data:`ORDER`, with their DDL types.
    columns: dict[str, str] = {}
    #: Columns that name a customer.
    names = ["customer_id", "customer_name"]
    #: Name and DDL type of the list of what is held of released rows.
    held: tuple[str, str] = ("", "")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", ", ".join(f"c{i} {t}" for i, t in enumerate(self.columns.values())))
        self.kept = handle.getListState(*self.held)

    def step(self, key, held: list[tuple], rows: list[tuple], now: int) -> tuple[list[tuple], list[tuple], int | None]:
        """Take released ``rows`` (all up to time ``now``, in order) after those ``held``: results, what is held from now on (an end
        of held and released rows), and when to be called again (None: never)."""
        raise NotImplementedError

    def advance(self, key, rows: list[tuple], now: int) -> tuple[list[tuple], int | None]:
        """One step with the list state: appended to, cut when rows leave it."""
        before = [tuple(r) for r in self.kept.get()] if self.kept.exists() else []
        out, after, again = self.step(key, before, rows, now)
        if not after:
            if before:
                self.kept.clear()
        elif len(after) < len(before) + len(rows):
            self.kept.put(after)
        elif rows:
            self.kept.appendList(after[len(before):])
        return out, again

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        cols = _ordered(rows, list(self.columns))
        if cols is None:
            return
        came = [tuple(None if v is None or v != v else v for v in r) for r in zip(*cols)]
        self.pending.appendList(came)
        self.handle.registerTimer(int(came[0][0]))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        held = [tuple(r) for r in self.pending.get()]
        due = sorted((r for r in held if r[0] <= now), key=lambda r: tuple((v is None, v or 0) for v in r[:3]))
        if due:
            rest = [r for r in held if r[0] > now]
            if rest:
                self.pending.put(rest)
                self.handle.registerTimer(int(min(r[0] for r in rest)))
            else:
                self.pending.clear()
        out, again = self.advance(key, due, now)
        if again is not None:
            self.handle.registerTimer(int(max(again, now + 1)))
        if out:
            yield pd.DataFrame(out, columns=self.output_columns)

    def close(self) -> None:
        pass


class BurstProcessor(EventTimeProcessor):
    """k matching messages within ``window_ms`` per customer, counted like the batch frame: a row's window ends at its own
    time and holds its peers.

    What is held is the ordered timestamps of one window; a timer
    frees a customer who has been quiet for a window.
    """

    columns = {"message_timestamp": "long", "source_partition": "int", "source_offset": "long", "message_id": "string",
               "customer_name": "string"}
    names = ["customer_id"]
    held = ("times", "ts long")
    output_columns = [f.name for f in BURST_OUTPUT.fields]

    def __init__(self, k: int = 5, window_ms: int = 5 * 60_000):
        self.k = k
        self.window_ms = window_ms

    def step(self, key, held, rows, now):
        times, out, i = [int(r[0]) for r in held], [], 0
        while i < len(rows):
            ts, j = int(rows[i][0]), i
            while j < len(rows) and rows[j][0] == ts:
                times.append(ts)
                j += 1
            count = len(times) - bisect.bisect_left(times, ts - self.window_ms)
            if count >= self.k:
                out.extend((key[0], r[4], r[3], ts, count) for r in rows[i:j])
            i = j
        # A row that is still to come is later than ``now``.
        left = times[bisect.bisect_left(times, now + 1 - self.window_ms):]
        return out, [(t,) for t in left], left[-1] + self.window_ms if left else None


class WithinProcessor(EventTimeProcessor):
    """Time-bounded row-pattern matches per (customer_id, customer_name): the stream form of
    :func:`moodwire.operators.within.match_escalations_within`.

    What is held is the rows from the first start on that has neither closed nor expired. Its expiry is a
    timer, so a later start that has closed meanwhile is reported even if the customer never writes again.
    """

    columns = {"message_timestamp": "long", "source_partition": "int", "source_offset": "long", "sentiment_score": "double",
               "message_text": "string"}
    held = ("rows", "ts long, x double, t string")
    output_columns = [f.name for f in MATCH_OUTPUT.fields]

    def __init__(self, within_ms: int, threshold: float = -5.0, separator: str = MESSAGE_SEPARATOR):
        self.within_ms = within_ms
        self.threshold = threshold
        self.sep = separator

    def step(self, key, held, rows, now):
        held = held + [(int(r[0]), r[3], r[4]) for r in rows]
        if not held:
            return [], [], None
        x = np.array([np.nan if r[1] is None else r[1] for r in held], dtype="float64")
        thr, units = quantize_one(self.threshold), quantize(x)
        p, starts, ends = closes(units, ~np.isnan(x) & (units > thr), thr)
        out, at, again, keep = [], 0, None, len(held)
        for s, e in zip(starts.tolist(), ends.tolist()):
            if s < at:
                continue
            if e < len(held):
                if held[e][0] - held[s][0] < self.within_ms:
                    pre, last = [r[2] for r in held[s:e] if r[2] is not None], held[e][2]
                    text = self.sep.join([*pre, last]) if pre and last is not None else None
                    out.append((key[0], key[1], float(p[e + 1] - p[s]) / SCORE_SCALE, e - s + 1, text, held[e][0]))
                    at = e + 1
            elif now + 1 - held[s][0] < self.within_ms:
                again, keep = held[s][0] + self.within_ms, s
                break
        return out, held[keep:], again


class BucketProcessor(StatefulProcessor):
    """An :class:`EventTimeProcessor`'s results for groups of many customers (:func:`in_buckets`).

    A call into the state store costs about as much as many rows, and a stream calls several times per group and
    micro-batch. So arriving rows of a group are buffered as one packed part, and what the processor holds of all its
    customers is one packed value. When the watermark passes rows, one timer releases them for all; the processor then takes
    the step of each customer who has released rows or whose time has come.
    """

    def __init__(self, processor: EventTimeProcessor):
        self.processor = processor

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "part binary")
        self.kept = handle.getValueState("kept", "customers binary")
        self.fired: set[tuple] = set()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        came = _by_customer(rows, self.processor.names, list(self.processor.columns))
        if came:
            came = {k: [tuple(None if v is None or v != v else v for v in r) for r in theirs] for k, theirs in came.items()}
            self.pending.appendList([(pickle.dumps(came),)])
            self.handle.registerTimer(int(min(r[0] for theirs in came.values() for r in theirs)))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        if (key, now) in self.fired:  # another timer of this group; the first one released everything
            return
        self.fired.add((key, now))
        due: dict[tuple, list[tuple]] = {}
        rest: dict[tuple, list[tuple]] = {}
        for part in self.pending.get():
            for who, theirs in pickle.loads(part[0]).items():
                for r in theirs:
                    (due if r[0] <= now else rest).setdefault(who, []).append(r)
        state = self.kept.get()
        kept: dict[tuple, tuple] = pickle.loads(state[0]) if state is not None else {}
        out = []
        for who in due.keys() | {k for k, (_, again) in kept.items() if again <= now}:
            held, _ = kept.pop(who, ([], None))
            some, held, again = self.processor.step(who, held, sorted(due.get(who, []), key=_in_order), now)
            out += some
            if again is not None:
                kept[who] = (held, int(max(again, now + 1)))
        if due:
            if rest:
                self.pending.put([(pickle.dumps(rest),)])
            else:
                self.pending.clear()
        if kept:
            self.kept.update((pickle.dumps(kept),))
        elif state is not None:
            self.kept.clear()
        times = [r[0] for theirs in rest.values() for r in theirs] + [again for _, again in kept.values()]
        if times:
            self.handle.registerTimer(int(min(times)))
        if out:
            yield pd.DataFrame(out, columns=self.processor.output_columns)

    def close(self) -> None:
        pass


#: Groups that customers are dealt over. Fixed for the life of a checkpoint; raise it for many millions of customers.
CUSTOMER_BUCKETS = 4096


def in_buckets(stream: DataFrame, names: list[str], columns: list[str], buckets: int = CUSTOMER_BUCKETS) -> GroupedData:
    """``stream`` cut to ``names`` and ``columns``, grouped by a hash of ``names``: all rows of a customer are in one group."""
    bucket = F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int").alias("customer_bucket")
    return stream.select(bucket, *dict.fromkeys([*names, *columns])).groupBy("customer_bucket")


def match_stream(sentiments: DataFrame, threshold: float = -5.0) -> DataFrame:
    """Escalations of a stream of scored messages, folded per customer in order of arrival."""
    grouped = in_buckets(sentiments, ["customer_id", "customer_name"], [*ORDER, "sentiment_score", "message_text"])
    return grouped.transformWithStateInPandas(EscalationProcessor(threshold), MATCH_OUTPUT, "Append", "None")


def event_time_stream(stream: DataFrame, processor: EventTimeProcessor, output: T.StructType, time_col: str) -> DataFrame:
    """Results of ``processor`` over ``stream``, whose watermark is on ``time_col``."""
    grouped = in_buckets(stream, processor.names, [*processor.columns, time_col])
    return grouped.transformWithStateInPandas(BucketProcessor(processor), output, "Append", "EventTime")
