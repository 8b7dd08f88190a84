"""Time-bounded row-pattern matcher (batch): escalations that close within a time of their first message.

Per key and in order: a match starts at a row whose score is above ``threshold`` and closes at the first later row that
takes the running sum to ``<= threshold``; it counts if that row comes less than ``within_ms`` after the first one. Of
several starts the earliest that closes in time is taken: a start that does not expires, and the next one takes over,
which may have closed meanwhile. After a match, matching goes on behind its last row. The end of the table is the end
of time: starts still open there have expired. (Without a time bound no start ever expires, and one that never closes
holds its key for good: that is :func:`moodwire.operators.escalation.match_escalations`, whose matches are the first ones here.)

Sums are exact decimals: scores rounded to nine decimals, as whole units, so no result hangs on the order of additions,
on chunks or on partitions. NULL scores add nothing and start nothing; texts are joined as in the unbounded matcher.

A start's close depends on the rows of its time window alone, so it is found for all starts at once:

1. Rows are range-partitioned and numbered as in the unbounded matcher, so a hot key spreads over partitions and chunks.
2. Inside a chunk, prefix sums give each start's close. Starts neither closed nor expired at the chunk's end go to the
   key's next chunk, as (level to fall to, time), where only the record lows of the running sum matter, and so on;
   a round costs two arrays a chunk, and there are as many as chunks fit into the time bound.
3. Which starts are taken is a walk from close to next start: per chunk a step function from the position it is
   entered at to the one it is left at. :func:`moodwire.operators.scan.scan` composes them, no task reading a whole key.
4. Each chunk walks from its entry and emits its matches; a match over several chunks comes in parts and is joined.

Keys that lie inside one chunk (nearly all) skip 2's rounds and 3.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodwire.functions.text import MESSAGE_SEPARATOR
from moodwire.operators.escalation import (DEFAULT_CHUNK_ROWS, DEFAULT_THRESHOLD, SCORE_SCALE, _chunk_frames, _first_leq, _is_set,
                                           _join_texts, ordered_rows, quantize, quantize_one, spanning)
from moodwire.operators.scan import PARTITION_BITS, Steps, _frame, merge_steps, same, scan
from moodwire.session import materialize

_NONE = -1


def closes(units: np.ndarray, valid: np.ndarray, thr: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix sums (with a leading 0), the rows that may start a match, and the row that closes each (len(units): none)."""
    p = np.concatenate([[0], np.cumsum(units)]).astype(np.int64)
    starts = np.flatnonzero(valid).astype(np.int64)
    return p, starts, _first_leq(p[1:], starts + 1, p[starts] + thr)


def taken(starts: np.ndarray, ends: np.ndarray, at: int = 0) -> list[int]:
    """Indices of the matches taken, going from position ``at``: each the first start from there on."""
    out, first = [], starts.tolist()
    k = bisect_left(first, at)
    while k < len(first):
        out.append(k)
        k = bisect_left(first, int(ends[k]) + 1, lo=k + 1)
    return out


class _Rows:
    """One chunk in order: numbers, times, units and the matches that close inside it in time."""

    def __init__(self, pdf: pd.DataFrame, thr: int, within_ms: int):
        self.gid = pdf["_gid"].to_numpy(dtype="int64")
        self.ts = pdf["_order0"].to_numpy(dtype="int64")
        score = pdf["_score"].to_numpy(dtype="float64", na_value=np.nan)
        self.units = quantize(score)
        self.p, starts, end = closes(self.units, ~np.isnan(score) & (self.units > thr), thr)
        m = len(self.gid)
        closed = end < m
        in_time = closed & (self.ts[np.minimum(end, m - 1)] - self.ts[starts] < within_ms)
        self.starts, self.ends = starts[in_time], end[in_time]
        self.open = starts[~closed & (self.ts[-1] - self.ts[starts] < within_ms)]


def _tables(keys: list[str], thr: int, within_ms: int):
    """For chunks of keys that span several: matches inside, starts still open at the end, record lows of the sum."""
    def run(batches):
        for pdf in spanning(batches, keys):
            c = _Rows(pdf, thr, within_ms)
            q = c.p[1:]
            low = np.flatnonzero(q < np.concatenate([[np.iinfo(np.int64).max], np.minimum.accumulate(q)[:-1]]))
            yield _frame([(*(pdf[k].iloc[0] for k in keys), int(pdf["_cb"].iloc[0]), c.gid[c.starts].tolist(), c.gid[c.ends].tolist(),
                           c.gid[c.open].tolist(), (c.p[c.open] + thr - c.p[-1]).tolist(), c.ts[c.open].tolist(),
                           q[low].tolist(), c.gid[low].tolist(), c.ts[low].tolist(), int(c.p[-1]), int(c.ts[-1]))],
                         [*keys, "_cb", *(f.name for f in _TABLE)])
    return run


_LONGS, _LONG = T.ArrayType(T.LongType()), T.LongType()
_TABLE = [T.StructField(c, _LONGS) for c in ("s", "e", "o_gid", "o_level", "o_ts", "low_q", "low_gid", "low_ts")] + [
    T.StructField("psum", _LONG), T.StructField("last_ts", _LONG)]
_OPEN = ["o_gid", "o_level", "o_ts"]


def _pass_on(keys: list[str], within_ms: int):
    """Open starts against the record lows of the chunk they come to: matches closed there, and what stays open."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                gid, level, ts, q, at, when = (np.asarray(r[c], dtype="int64") for c in [*_OPEN, "low_q", "low_gid", "low_ts"])
                k = np.searchsorted(-q, -level, side="left")     # first record low at or below the level
                closed = k < len(q)
                k = np.minimum(k, max(0, len(q) - 1))
                hit = closed & (when[k] - ts < within_ms)
                stay = ~closed & (r["last_ts"] - ts < within_ms)
                rows.append((*(r[c] for c in keys), r["home"], r["seq"] + 1, gid[hit].tolist(), at[k][hit].tolist(),
                             gid[stay].tolist(), (level[stay] - r["psum"]).tolist(), ts[stay].tolist()))
            yield _frame(rows, [*keys, "home", "seq", "s", "e", *_OPEN])
    return run


def _steps(keys: list[str]):
    """A chunk's matches by start to the step function of the walk over it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                pairs = sorted((a, b) for ss, es in zip(r["ss"], r["es"]) for a, b in zip(ss, es))
                first, outs = [a for a, _ in pairs], [0] * len(pairs)
                for k in range(len(pairs) - 1, -1, -1):
                    nxt = bisect_left(first, pairs[k][1] + 1)
                    outs[k] = outs[nxt] if nxt < len(pairs) else int(pairs[k][1]) + 1
                ends, outs = merge_steps(first, outs)
                rows.append((*(r[c] for c in keys), r["_cb"], ends, outs))
            yield _frame(rows, [*keys, "_cb", "ends", "outs"])
    return run


def _leaving(keys: list[str], span: int):
    """The match that a walk from ``in_at`` takes last in its chunk, if it closes behind the chunk: out_s, out_e."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                pairs = np.array(sorted((a, b) for ss, es in zip(r["ss"], r["es"]) for a, b in zip(ss, es)), dtype="int64").reshape(-1, 2)
                path = taken(pairs[:, 0], pairs[:, 1], int(r["in_at"]))
                a, b = pairs[path[-1]].tolist() if path else (_NONE, _NONE)
                if a >= 0 and b // span == r["_cb"]:
                    a = b = _NONE
                rows.append((*(r[c] for c in keys), r["_cb"], int(r["in_at"]), a, b))
            yield _frame(rows, [*keys, "_cb", "in_at", "out_s", "out_e"])
    return run


def _entries(tagged: DataFrame, keys: list[str], thr: int, within_ms: int, shift: int) -> DataFrame | None:
    """Per chunk of keys that span several: where its walk starts (in_at), the match over its end (out_s, out_e) and the
    one that is open before its first row (in_s, in_e); None if no key spans several."""
    ids, kinds = [*keys, "_cb"], [tagged.schema[c] for c in keys]
    cb = T.StructField("_cb", T.LongType())
    tables = materialize(tagged.select(*ids, "_gid", "_score", "_order0").sortWithinPartitions(*ids, "_gid")
                         .mapInPandas(_tables(keys, thr, within_ms), T.StructType([*kinds, cb, *_TABLE])))
    several = tables.groupBy(*keys).count().where("count > 1").drop("count")
    tables = (same(tables, several, keys, "left_semi")
              .withColumn("seq", F.row_number().over(Window.partitionBy(*keys).orderBy("_cb"))))
    if tables.isEmpty():
        return None
    lows = tables.select(*keys, "seq", "low_q", "low_gid", "low_ts", "psum", "last_ts")
    still = tables.where(F.size("o_gid") > 0).select(*keys, F.col("_cb").alias("home"), (F.col("seq") + 1).alias("seq"), *_OPEN)
    passed = T.StructType([*kinds, T.StructField("home", T.LongType()), T.StructField("seq", T.IntegerType()), *_TABLE[:5]])
    found = tables.select(*ids, "s", "e")
    while True:
        now = materialize(same(still, lows, [*keys, "seq"]).mapInPandas(_pass_on(keys, within_ms), passed))
        found = found.unionByName(now.where(F.size("s") > 0).select(*keys, F.col("home").alias("_cb"), "s", "e"))
        still = now.where(F.size("o_gid") > 0).select(*keys, "home", "seq", *_OPEN)
        if still.isEmpty():
            break
    found = materialize(found.groupBy(*ids).agg(F.collect_list("s").alias("ss"), F.collect_list("e").alias("es")))
    steps = found.mapInPandas(_steps(keys), T.StructType([*kinds, cb, *T.StructType.fromDDL(Steps.fields)]))
    entry = scan(steps, keys, "_cb", Steps(), PARTITION_BITS - shift)
    walked = materialize(same(found, entry, ids).mapInPandas(
        _leaving(keys, 1 << shift), T.StructType([*kinds, cb, *T.StructType.fromDDL("in_at bigint, out_s bigint, out_e bigint")])))
    # A boundary between two chunks lies in at most one match, so a chunk has at most one that is open before it.
    over = walked.where("out_s >= 0").select(*keys, F.col("_cb").alias("_from"), F.col("out_s").alias("in_s"), F.col("out_e").alias("in_e"))
    inside = (same(walked, over, keys).where((F.col("_cb") > F.col("_from")) & (F.col("_cb") <= F.shiftright("in_e", shift)))
              .select(*ids, "in_s", "in_e"))
    return same(walked, inside, ids, "left").fillna(_NONE, ["in_s", "in_e"])


_PART = [T.StructField(c, _LONG) for c in ("match_gid", "_cb", "rows", "units")] + [
    T.StructField("texts", T.StringType()), T.StructField("is_close", T.BooleanType()), T.StructField("t_text", T.StringType())]


def _emit(keys: list[str], thr: int, within_ms: int, sep: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, bounds in _chunk_frames(batches, [*keys, "_cb"]):
            rows = []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                chunk = pdf.iloc[a:b]
                head = chunk.iloc[0]
                c = _Rows(chunk, thr, within_ms)
                texts = chunk["_text"].tolist()
                at = int(np.searchsorted(c.gid, head["in_at"]))
                spans = [(int(c.starts[k]), int(c.ends[k]), int(c.gid[c.starts[k]])) for k in taken(c.starts, c.ends, at)]
                if head["out_s"] >= 0:
                    first = int(np.searchsorted(c.gid, head["out_s"]))
                    spans = [s for s in spans if s[1] < first] + [(first, b - a, int(head["out_s"]))]
                if head["in_s"] >= 0:
                    spans.insert(0, (0, int(np.searchsorted(c.gid, head["in_e"])), int(head["in_s"])))
                for lo, hi, gid in spans:
                    close = hi < b - a
                    rows.append((*(head[k] for k in keys), gid, int(head["_cb"]), hi - lo + close, int(c.p[hi + close] - c.p[lo]),
                                 _join_texts(texts[lo:hi], sep), close, texts[hi] if close and _is_set(texts[hi]) else None,
                                 int(c.ts[hi]) if close else None))
            if rows:
                yield _frame(rows, [*keys, *(f.name for f in _PART), "t_order"])
    return run


def match_escalations_within(df: DataFrame, within_ms: int, keys: Sequence[str] = ("customer_id", "customer_name"),
                             order: Sequence[str] = ("message_timestamp", "source_partition", "source_offset"),
                             score: str = "sentiment_score", text: str = "message_text", threshold: float = DEFAULT_THRESHOLD,
                             separator: str = MESSAGE_SEPARATOR, chunk_rows: int = DEFAULT_CHUNK_ROWS,
                             partitions: int | None = None) -> DataFrame:
    """One row per match, columns as :func:`match_escalations`; ``order[0]`` is the time in ms and must not be null.

    ``chunk_rows`` bounds the rows that a single call works on.
    """
    keys, order = list(keys), list(order)
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shift, thr = max(0, int(chunk_rows - 1).bit_length()), quantize_one(threshold)
    df = df.withColumn(order[0], F.col(order[0]).cast("long"))
    tagged = ordered_rows(df, keys, order, score, text, partitions).withColumn("_cb", F.shiftright("_gid", shift))
    entries = _entries(tagged, keys, thr, within_ms, shift)
    fresh = {c: _NONE for c in ("in_at", "out_s", "out_e", "in_s", "in_e")}
    ids = [*keys, "_cb"]
    if entries is None:
        rows = tagged.withColumns({c: F.lit(v).cast("long") for c, v in fresh.items()})
    else:
        rows = same(tagged, entries, ids, "left").fillna(fresh)
    parts = rows.sortWithinPartitions(*ids, "_gid").mapInPandas(
        _emit(keys, thr, within_ms, separator),
        T.StructType([*(tagged.schema[c] for c in keys), *_PART, T.StructField("t_order", T.LongType())]))
    whole = parts.groupBy(*keys, "match_gid").agg(
        F.array_sort(F.collect_list(F.struct("_cb", "texts"))).alias("pre"), F.sum("rows").alias("trigger_message_count"),
        F.sum(F.col("units").cast("decimal(38,0)")).alias("units"), F.max(F.when(F.col("is_close"), F.struct("t_order", "t_text"))).alias("t"))
    texts = F.filter(F.transform("pre", lambda x: x["texts"]), lambda x: x.isNotNull())
    return whole.select(*keys, (F.col("units").cast("double") / F.lit(float(SCORE_SCALE))).alias("karen_score_total"), "trigger_message_count",
                        F.when(F.size(texts) > 0, F.concat(F.array_join(texts, separator), F.lit(separator), F.col("t.t_text"))).alias("recent_messages"),
                        F.col("t.t_order").alias("trigger_order"))


def within_reference(scores: Sequence[float | None], times: Sequence[int], within_ms: int,
                     threshold: float = DEFAULT_THRESHOLD) -> list[tuple[int, int]]:
    """Plain definition, used by tests: (first, last) of each match."""
    thr, out, at = quantize_one(threshold), [], 0
    units = [None if x is None else quantize_one(x) for x in scores]
    while at < len(scores):
        if units[at] is not None and units[at] > thr:
            total = units[at]
            for j in range(at + 1, len(scores)):
                total += units[j] or 0
                if units[j] is not None and total <= thr:
                    break
            else:
                j = None
            if j is not None and times[j] - times[at] < within_ms:
                out.append((at, j))
                at = j
        at += 1
    return out
