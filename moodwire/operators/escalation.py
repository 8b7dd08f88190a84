"""Keyed row-pattern matcher for escalations (batch).

Semantics, per key and in order: a match is one or more ``pre`` rows then one
``t`` row, where ``pre`` holds while the running score sum of the match stays
above ``threshold`` and ``t`` is the first row that takes it to ``<=
threshold``. One row per match; after a match, matching restarts after its
last row. A row whose score is NULL (or not above the threshold) cannot start
a match; inside a match a NULL score adds nothing. Measures: the sum (an
in-order double fold), the row count, and the texts joined with the
separator (NULL texts skipped among ``pre`` rows, as LISTAGG does; a NULL
``t`` text makes the whole string NULL, as CONCAT does).

Execution is built for one key holding a large share of all rows:

1. ``repartitionByRange(keys, order)`` spreads a hot key over many partitions;
   ``monotonically_increasing_id`` then numbers rows in order, and rows are cut
   into chunks of at most ``chunk_rows`` rows of one key.
2. Per chunk of a key that spans several, the prefix sums give, vectorised, the
   trajectory from a fresh start and, for every place where an incoming open
   match could close, the state that follows. Only the break points of that
   transition function are kept, where the state changes.
3. A distributed scan (:mod:`moodwire.operators.scan`) composes these functions
   within and then across partitions, yielding a first state each chunk
   starts in; no task reads all chunks of a key.
4. These states are settled (:func:`settled`): the chunks of keys that span
   several are folded row by row from them, and where what a chunk leaves
   differs from what the next one started in, the next one is folded anew,
   until all agree.
5. Chunks are joined with their start state and emit match fragments; a
   match that never closes emits nothing, so an endless run of one hot key
   never reaches a group. Fragments of one match (one per chunk it spans)
   are assembled with an ordered concatenation and an ordered fold of the
   scores.

Decisions (can a row start a match, does it close one) compare the strict
left-to-right double sum of the match's scores with the threshold, and that
sum is the reported total. Double sums depend on the order of additions: near
a tie such as ``-0.7 * 5 - 0.3 * 5`` a re-associated sum decides otherwise, and
every later match of that key shifts. So the summaries of steps 2 and 3, which
use sums of integers (scores rounded to ``SCORE_DECIMALS`` decimals), only
propose states; steps 4 and 5 decide.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodwire.functions.text import MESSAGE_SEPARATOR
from moodwire.operators.scan import PARTITION_BITS, Transition, same, scan
from moodwire.session import materialize

DEFAULT_THRESHOLD = -5.0
DEFAULT_CHUNK_ROWS = 1 << 18
#: Fewest rows of a chunk that states are settled for and matches emitted from.
SETTLE_ROWS = 1 << 12
_RESET, _OPEN = 0, 1

# Arithmetic of the summaries: scores in units of 10^-SCORE_DECIMALS, rounded
# half to even, as int64. A row beyond +-2^44 units (about +-17,592 score units) or a
# non-finite one fails the job, alike on every path, so a chunk of up to 2^18
# rows sums without overflow and nothing is bent.
SCORE_DECIMALS = 9
SCORE_SCALE = 10 ** SCORE_DECIMALS
ROW_LIMIT_UNITS = 1 << 44
_SUM_LIMIT = 1 << 62


def quantize(x: np.ndarray) -> np.ndarray:
    """Scores -> integer decision units (NaN, i.e. NULL, -> 0)."""
    x = np.asarray(x, dtype="float64")
    v = np.rint(np.where(np.isnan(x), 0.0, x) * SCORE_SCALE)
    if (np.abs(v) > ROW_LIMIT_UNITS).any():
        raise ValueError(f"score out of range: {x[np.abs(v) > ROW_LIMIT_UNITS][0]}")
    return v.astype(np.int64)


def quantize_one(x: float) -> int:
    """Scalar twin of :func:`quantize` (Python ``round`` is half to even too)."""
    if not abs(x) * SCORE_SCALE <= ROW_LIMIT_UNITS + 0.5:
        raise ValueError(f"score out of range: {x}")
    return round(x * SCORE_SCALE)


def clamp_units(v: int) -> int:
    """Bound an exact (Python int) sum for int64 comparisons; a sum beyond the
    bound cannot reach the threshold inside one chunk either way."""
    return max(-_SUM_LIMIT, min(_SUM_LIMIT, v))


def walk(scores: list, threshold: float, s: float = 0.0, n: int = 0) -> tuple[list[tuple[int, int]], tuple[int, float, int]]:
    """The fold itself, in order and in doubles, from an open match of ``n`` rows with sum ``s`` (0 rows: none).

    NaN stands for NULL. Returns the closed matches as (first, last) row, first -1 if it came in open, and what
    stays open: (first row or -1, sum, rows).
    """
    closed, lo = [], -1
    for i, x in enumerate(scores):
        if n == 0:
            if x > threshold:
                s, n, lo = x, 1, i
        elif x == x and s + x <= threshold:
            closed.append((lo, i))
            s, n, lo = 0.0, 0, -1
        else:
            s, n = (s + x if x == x else s), n + 1
    return closed, (lo, s, n)


def doubtful(scores: list, threshold: float, s: float, n: int, top: float) -> bool:
    """Whether the match that came in open passes so near the threshold that ``s`` must be its very double sum.

    ``s`` may differ from it by half a decision unit a row and by the rounding of ``n`` additions of at most ``top``.
    """
    for x in scores:
        s, n = (s + x if x == x else s), n + 1
        if abs(s - threshold) <= 1e-6 + n * (1.0 / SCORE_SCALE + 2.3e-16 * n * top):
            return True
        if s <= threshold:
            return False
    return False


# ----------------------------------------------------------------- numpy core

def _first_leq(q: np.ndarray, start: np.ndarray, thr: np.ndarray) -> np.ndarray:
    """For each i: first j >= start[i] with q[j] <= thr[i], else len(q).

    Sparse table of block minima + descending binary lifting: O(m log m).
    """
    m = len(q)
    pos = start.astype(np.int64).copy()
    if m == 0 or len(pos) == 0:
        return np.full(len(pos), m, dtype=np.int64)
    levels = [q]
    k = 1
    while (1 << k) <= m:
        prev, half = levels[-1], 1 << (k - 1)
        levels.append(np.minimum(prev[:-half], prev[half:]))
        k += 1
    for k in range(len(levels) - 1, -1, -1):
        lv, size = levels[k], 1 << k
        fits = pos + size <= m
        at = np.where(fits, pos, 0)
        skip = fits & (lv[np.minimum(at, len(lv) - 1)] > thr)
        pos = np.where(skip, pos + size, pos)
    return np.minimum(pos, m)


class _Chunk:
    """Vectorised view of one chunk's rows in order."""

    def __init__(self, x: np.ndarray, threshold: float):
        x = np.asarray(x, dtype="float64")
        self.m = m = len(x)
        self.null = np.isnan(x)
        self.z = np.where(self.null, 0.0, x)                  # doubles, for the reported totals
        zq = quantize(x)                                      # integer decision units
        self.thr = thr = quantize_one(threshold)
        self.valid = ~self.null & (zq > thr)
        self.p = np.concatenate([[0], np.cumsum(zq)]).astype(np.int64)  # p[i] = sum zq[:i]
        self.q = self.p[1:]                                   # q[j] = sum zq[:j+1]
        nv = np.full(m + 1, m, dtype=np.int64)
        idx = np.where(self.valid, np.arange(m), m)
        nv[:m] = np.minimum.accumulate(idx[::-1])[::-1]
        self.nv = nv                                          # next valid >= p
        starts = np.arange(m, dtype=np.int64)
        # end[s]: first j > s closing a match started at s (m if none)
        self.end = _first_leq(self.q, starts + 1, self.p[:m] + thr)

    def trajectories(self):
        """For every restart position p in [0, m]: the start of the match left
        open at the chunk end (or m when the chunk ends reset)."""
        m = self.m
        p = np.arange(m + 1, dtype=np.int64)
        s = self.nv
        has = s < m
        e = np.where(has, self.end[np.minimum(s, m - 1)] if m else 0, m)
        terminal = ~has | (e >= m)
        jump = np.where(terminal, p, e + 1)
        for _ in range(max(1, int(np.ceil(np.log2(m + 2)))) + 1):
            jump = jump[jump]
        t = jump
        return np.where(self.nv[t] < m, self.nv[t], m)

    def close_in(self, s_in: int) -> int:
        """First j where an incoming open sum ``s_in`` (decision units) reaches
        the threshold."""
        hit = np.nonzero(self.q <= clamp_units(self.thr - int(s_in)))[0]
        return int(hit[0]) if len(hit) else self.m


# ------------------------------------------------------------ pandas stages

def _frame(cols: dict) -> pd.DataFrame:
    """Object-typed columns, so empty outputs keep list/str columns convertible."""
    return pd.DataFrame({k: pd.Series(v, dtype="object") for k, v in cols.items()})


class _Seq:
    """Pure-Python twin of :class:`_Chunk` for short chunks (most keys).

    The same sequential prefix sums and the same comparisons, so both paths
    make identical close decisions; it only avoids numpy's fixed per-call
    cost, which dominates when a chunk holds a handful of rows.
    """

    def __init__(self, scores: list, threshold: float):
        self.m = m = len(scores)
        self.thr = thr = quantize_one(threshold)
        self.z = [0.0 if x != x else x for x in scores]       # NULL arrives as NaN
        zq = [0 if x != x else quantize_one(x) for x in scores]
        q, acc = [], 0
        for v in zq:
            acc += v
            q.append(acc)
        self.q, self.p = q, [0] + q
        nv, nxt = [m] * (m + 1), m
        for i in range(m - 1, -1, -1):
            if scores[i] == scores[i] and zq[i] > thr:
                nxt = i
            nv[i] = nxt
        self.nv = nv
        self._end: dict[int, int] = {}

    def end(self, s: int) -> int:
        """First j > s closing a match started at s (m if none)."""
        e = self._end.get(s)
        if e is None:
            lim, q, e = self.p[s] + self.thr, self.q, self.m
            for j in range(s + 1, self.m):
                if q[j] <= lim:
                    e = j
                    break
            self._end[s] = e
        return e

    def open_start(self, p: int) -> int:
        """After a fresh start at p: start of the match open at the chunk end, or m."""
        m = self.m
        while True:
            s = self.nv[p]
            if s >= m:
                return m
            e = self.end(s)
            if e >= m:
                return s
            p = e + 1

    def close_in(self, s_in: int) -> int:
        lim = self.thr - int(s_in)
        for j, v in enumerate(self.q):
            if v <= lim:
                return j
        return self.m


SMALL_CHUNK = 128


def _chunk_frames(batches: Iterator[pd.DataFrame], keycols: list[str]):
    """Regroup a partition's sorted batch stream into frames of whole chunks
    (runs of equal ``keycols``). Yields ``(frame, bounds)``: chunk start
    offsets followed by the frame length. A chunk cut by a batch boundary is
    carried over; chunks are bounded by ``chunk_rows``, so the carry is too."""
    carry: list[pd.DataFrame] = []
    carry_hash = None
    for pdf in batches:
        if len(pdf) == 0:
            continue
        pdf = pdf.reset_index(drop=True)
        h = pd.util.hash_pandas_object(pdf[keycols], index=False).to_numpy()
        cuts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        if carry:
            if h[0] == carry_hash:
                if len(cuts) == 1:
                    carry.append(pdf)
                    continue
                c1 = int(cuts[1])
                carry.append(pdf.iloc[:c1])
                pdf, h, cuts = pdf.iloc[c1:].reset_index(drop=True), h[c1:], cuts[1:] - c1
            done = pd.concat(carry, ignore_index=True)
            yield done, np.array([0, len(done)])
            carry = []
        last = int(cuts[-1])
        if last > 0:
            yield pdf.iloc[:last], np.r_[cuts[:-1], last]
        carry, carry_hash = [pdf.iloc[last:]], h[last]
    if carry:
        done = pd.concat(carry, ignore_index=True)
        yield done, np.array([0, len(done)])


def _per_chunk_stream(keycols: list[str], big_fn, small_fn, in_cols: list[str], out_cols: list[str],
                      flush_rows: int = 4096, small_rows: int = SMALL_CHUNK):
    """mapInPandas driver. Chunks of at most ``small_rows`` rows go through
    ``small_fn(cols, a, b, out)`` on plain column lists of the whole batch;
    larger ones through the vectorised ``big_fn(chunk) -> DataFrame``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = {c: [] for c in out_cols}
        frames, n = [], 0

        def flush():
            parts = ([_frame(out)] if out[out_cols[0]] else []) + frames
            return pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0]

        for pdf, bounds in _chunk_frames(batches, keycols):
            cols = None
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if b - a <= small_rows:
                    if cols is None:
                        cols = {c: pdf[c].tolist() for c in in_cols}
                    n += small_fn(cols, a, b, out)
                else:
                    r = big_fn(pdf.iloc[a:b])
                    if len(r):
                        frames.append(r[out_cols])
                        n += len(r)
            if n >= flush_rows:
                yield flush()
                out, frames, n = {c: [] for c in out_cols}, [], 0
        if n:
            yield flush()
    return run


def _is_set(v) -> bool:
    return v is not None and not (isinstance(v, float) and v != v) and v is not pd.NA


def _summary_fn(keys: Sequence[str], threshold: float):
    def summarize(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_gid", kind="stable")
        gid = pdf["_gid"].to_numpy(dtype="int64")
        ch = _Chunk(pdf["_score"].to_numpy(dtype="float64", na_value=np.nan), threshold)
        m = ch.m
        open_start = ch.trajectories()              # per restart position
        # record lows of q below 0: the only places an incoming open match can close
        run_min = np.minimum.accumulate(ch.q)
        prev_min = np.concatenate([[np.iinfo(np.int64).max], run_min[:-1]])
        rl = np.nonzero((ch.q < prev_min) & (ch.q < 0))[0]
        # Of neighbouring lows that leave the same state only the lowest is kept: between the break points nothing changes.
        after = open_start[rl + 1]
        last = np.concatenate([after[1:] != after[:-1], [True]]) if len(rl) else np.empty(0, dtype=bool)
        rl, after = rl[last], after[last]

        def state(os_):
            is_open = os_ < m
            kind = np.where(is_open, _OPEN, _RESET)
            sm = np.where(is_open, ch.p[m] - ch.p[np.minimum(os_, m)], 0)
            cnt = np.where(is_open, m - os_, 0)
            st = np.where(is_open, gid[np.minimum(os_, m - 1)], -1)
            return kind, sm, cnt, st

        k0, s0, c0, st0 = state(np.array([open_start[0]]))
        rk, rs, rc, rst = state(after)
        row = {c: [pdf[c].iloc[0]] for c in keys}
        row.update({
            "_cb": [int(pdf["_cb"].iloc[0])], "m": [m], "psum": [int(ch.p[m])],
            "f_kind": [int(k0[0])], "f_sum": [int(s0[0])], "f_cnt": [int(c0[0])], "f_start": [int(st0[0])],
            "rl_q": [ch.q[rl].tolist()], "rl_kind": [rk.tolist()], "rl_sum": [rs.astype("int64").tolist()],
            "rl_cnt": [rc.astype("int64").tolist()], "rl_start": [rst.astype("int64").tolist()],
        })
        return pd.DataFrame(row)

    return summarize


SUMMARY_COLS = ["_cb", "m", "psum", "f_kind", "f_sum", "f_cnt", "f_start",
                "rl_q", "rl_kind", "rl_sum", "rl_cnt", "rl_start"]


def _summary_small_fn(keys: Sequence[str], threshold: float):
    """Row-list twin of :func:`_summary_fn` for short chunks."""
    keys = list(keys)

    def summarize(cols: dict, a: int, b: int, out: dict) -> int:
        gid = cols["_gid"][a:b]
        sq = _Seq(cols["_score"][a:b], threshold)
        m, pm = sq.m, sq.p[sq.m]

        def state(os_):
            if os_ < m:
                return _OPEN, pm - sq.p[os_], m - os_, gid[os_]
            return _RESET, 0, 0, -1

        f = state(sq.open_start(0))
        rl_q, rl = [], []
        low = float("inf")
        for j, v in enumerate(sq.q):
            if v < low and v < 0:
                after = state(sq.open_start(j + 1))
                if rl and rl[-1] == after:
                    rl_q[-1] = v
                else:
                    rl_q.append(v)
                    rl.append(after)
            low = min(low, v)
        for c in keys:
            out[c].append(cols[c][a])
        for c, v in zip(SUMMARY_COLS, [cols["_cb"][a], m, pm, *f, rl_q, [r[0] for r in rl],
                                       [r[1] for r in rl], [r[2] for r in rl], [r[3] for r in rl]]):
            out[c].append(v)
        return 1

    return summarize


FRAG_COLS = ["match_gid", "_sb", "frag_count", "frag_texts", "frag_scores", "is_close", "t_text", "t_order"]


def _join_texts(texts, sep: str) -> str | None:
    vals = [t for t in texts if _is_set(t)]
    return sep.join(vals) if vals else None


def _emit_fn(keys: Sequence[str], threshold: float, sep: str):
    """Match fragments of one chunk, from its settled start state."""
    keys = list(keys)

    def emit(cols: dict, a: int, b: int, out: dict) -> int:
        gid, texts, order0, scores = cols["_gid"][a:b], cols["_text"][a:b], cols["_order0"][a:b], cols["_score"][a:b]
        kvals, sb, start = [cols[c][a] for c in keys], cols["_sb"][a], int(cols["in_start"][a])

        def frag(first, hi, close):
            """Rows from ``first`` (-1: the match came in open) to hi-1 are pre rows; row hi is the t row when close."""
            lo, last = max(first, 0), hi + 1 if close else hi
            for c, v in zip(keys, kvals):
                out[c].append(v)
            for c, v in zip(FRAG_COLS, [start if first < 0 else gid[first], sb, last - lo, _join_texts(texts[lo:hi], sep),
                                        [x if x == x else 0.0 for x in scores[lo:last]], close,
                                        texts[hi] if close else None, order0[hi] if close else None]):
                out[c].append(v)

        closed, (lo, _, rows) = walk(scores, threshold, float(cols["in_sum"][a]), int(cols["in_cnt"][a]))
        for first, hi in closed:
            frag(first, hi, True)
        # The match left open at the chunk end is emitted only when a later
        # chunk closes it: a run that never reaches the threshold builds no
        # texts and reaches no per-match group.
        left = bool(rows) and bool(cols["out_closes"][a])
        if left:
            frag(lo, len(scores), False)
        return len(closed) + left

    return emit


class Folds(Transition):
    """What a stretch of rows makes of the match that comes in open (its sum, in decision units, and rows), or of none.

    ``rl_q`` holds, descending, the sums from the stretch's first row at which an incoming match may close, break points
    only; ``rl_*`` the state then left at the end, ``f_*`` the state left if none comes in. Sums are clamped: they
    propose states, which :func:`settled` decides.
    """

    fields = ("m bigint, psum bigint, f_kind int, f_sum bigint, f_cnt bigint, f_start bigint, rl_q array<bigint>, "
              "rl_kind array<int>, rl_sum array<bigint>, rl_cnt array<bigint>, rl_start array<bigint>")
    state = "in_kind int, in_sum bigint, in_cnt bigint, in_start bigint"
    start = (_RESET, 0, 0, -1)

    def __init__(self, threshold: float):
        self.thr = quantize_one(threshold)

    def apply(self, state, fn):
        kind, s, n, start = state
        if kind == _RESET:
            return tuple(fn[2:6])
        k = bisect_left(fn[6], -clamp_units(self.thr - s), key=lambda q: -q)
        if k < len(fn[6]):
            return fn[7][k], fn[8][k], fn[9][k], fn[10][k]
        return kind, clamp_units(s + fn[1]), n + fn[0], start

    def then(self, first, second):
        shift, lowest = first[1], first[6][-1] if len(first[6]) else 0
        pieces = [(q, self.apply(st, second)) for q, st in zip(first[6], zip(*first[7:11]))]
        pieces += [(q + shift, st) for q, st in zip(second[6], zip(*second[7:11])) if q + shift < lowest]
        pieces = [p for k, p in enumerate(pieces) if k + 1 == len(pieces) or pieces[k + 1][1] != p[1]]
        lists = [[clamp_units(q) for q, _ in pieces], *([st[i] for _, st in pieces] for i in range(4))]
        return (first[0] + second[0], clamp_units(shift + second[1]), *self.apply(tuple(first[2:6]), second), *lists)


def spanning(batches: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Those chunks (runs of equal keys and ``_cb``) of a sorted partition whose key may go on in another chunk: the
    partition's first and last key, and keys of several chunks. Frames hold one chunk each."""
    held, held_first, count = None, False, 0
    for pdf, bounds in _chunk_frames(batches, [*keys, "_cb"]):
        ids = [pdf[c].tolist() for c in keys]
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            who = tuple("" if not _is_set(c[a]) else c[a] for c in ids), tuple(_is_set(c[a]) for c in ids)
            again = held is not None and held[0] == who
            if held is not None and (held_first or again):
                yield held[1].iloc[held[2]:held[3]]
            held_first, held, count = again or count == 0, (who, pdf, a, b), count + 1
    if held is not None:
        yield held[1].iloc[held[2]:held[3]]


STATE_COLS = ["seq", "in_start", "in_sum", "in_cnt"]
LEFT_COLS = ["near", "in_hit", "o_start", "o_sum", "o_cnt"]


def _settle_fn(keys: Sequence[str], threshold: float, top: float):
    """Fold of chunks in order of (keys, chain, seq), each from its given state; a chunk that goes on with the match of
    the one before it (same chain, next ``seq``) starts in the very state that one left."""
    keys = list(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        who, seq, left = None, -1, (-1, 0.0, 0)
        for pdf, bounds in _chunk_frames(batches, [*keys, "_sb"]):
            cols = {c: pdf[c].tolist() for c in [*keys, "_sb", "chain", *STATE_COLS, "_gid", "_score"]}
            out = {c: [] for c in [*keys, "_sb", *STATE_COLS, *LEFT_COLS]}
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                me, at = tuple(cols[c][a] for c in [*keys, "chain"]), cols["seq"][a]
                state = (cols["in_start"][a], cols["in_sum"][a], cols["in_cnt"][a])
                if me == who and at == seq + 1 and left[0] == state[0]:
                    state = left
                start, s, n = state
                scores = cols["_score"][a:b]
                closed, (lo, o_sum, rows) = walk(scores, threshold, s, n)
                o_start = -1 if rows == 0 else start if lo < 0 else cols["_gid"][a + lo]
                who, seq, left = me, at, (o_start, o_sum if rows else 0.0, rows)
                near = n > 0 and doubtful(scores, threshold, s, n, top)
                for c, v in zip(out, [*me[:-1], cols["_sb"][a], at, *state, near, bool(closed) and closed[0][0] < 0, *left]):
                    out[c].append(v)
            yield _frame(out)
    return run


def settled(tagged: DataFrame, states: DataFrame, keys: Sequence[str], threshold: float) -> DataFrame:
    """Start states as the in-order double fold has them, and what each chunk leaves, for the chunks of keys that span several.

    All chunks are folded at once from the proposed states. A chunk whose state names another match than the chunk before
    it leaves open is folded again from that; so are all chunks of a match that comes near the threshold in some chunk,
    in order, until its sums agree to the bit. (A match far from the threshold needs no exact sum.) Proposals are nearly
    always right, so this ends after two or three rounds; each round settles at least one more chunk of every key.
    A near match is walked by one task, as the order of its additions asks, holding one chunk at a time.
    """
    ids = [*keys, "_sb"]
    rows = tagged.select(*ids, "_gid", "_score")
    top = tagged.agg(F.max(F.abs("_score"))).first()[0] or 0.0
    schema = T.StructType([tagged.schema[c] for c in ids] + [
        T.StructField("seq", T.IntegerType()), T.StructField("in_start", T.LongType()), T.StructField("in_sum", T.DoubleType()),
        T.StructField("in_cnt", T.LongType()), T.StructField("near", T.BooleanType()), T.StructField("in_hit", T.BooleanType()),
        T.StructField("o_start", T.LongType()), T.StructField("o_sum", T.DoubleType()), T.StructField("o_cnt", T.LongType())])

    def match(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        other = right.select(*(F.col(c).alias(f"_s_{c}") for c in ids), *(c for c in right.columns if c not in ids and how == "inner"))
        joined = left.join(other, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in ids], how)
        return joined.drop(*(f"_s_{c}" for c in ids))

    def fold(todo: DataFrame) -> DataFrame:
        return (match(rows, todo, "inner").repartition(*keys, "chain").sortWithinPartitions(*keys, "chain", "seq", "_gid")
                .mapInPandas(_settle_fn(keys, threshold, top), schema))

    done = materialize(fold(states.withColumn("chain", F.col("_sb"))))
    by_key, by_match = Window.partitionBy(*keys).orderBy("seq"), Window.partitionBy(*keys, "in_start")
    while True:
        seen = done.select(*ids, *STATE_COLS, "near", F.coalesce(F.lag("o_start").over(by_key), F.lit(-1)).alias("p_start"),
                           F.coalesce(F.lag("o_sum").over(by_key), F.lit(0.0)).alias("p_sum"),
                           F.coalesce(F.lag("o_cnt").over(by_key), F.lit(0)).alias("p_cnt"))
        other = F.col("in_start") != F.col("p_start")
        seen = (seen.withColumn("doubt", F.max("near").over(by_match))
                .withColumn("off", F.max(other | (F.col("in_sum") != F.col("p_sum"))).over(by_match)))
        todo = materialize(seen.where(other | (F.col("doubt") & F.col("off"))).select(
            *ids, "seq", F.col("p_start").alias("in_start"), F.col("p_sum").alias("in_sum"), F.col("p_cnt").alias("in_cnt"),
            F.when(F.col("p_start") >= 0, F.col("p_start")).otherwise(-2 - F.col("_sb")).alias("chain")))
        if todo.isEmpty():
            return done
        done = materialize(match(done, todo, "left_anti").unionByName(fold(todo)))


# ------------------------------------------------------------------ operator

def ordered_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], score: str, text: str, partitions: int) -> DataFrame:
    """``df``'s keys, ``_score``, ``_text`` and ``_order0``, range-partitioned and numbered (``_gid``) in order, materialised."""
    rows = df.select(*keys, *order, F.col(score).cast("double").alias("_score"),
                     F.col(text).cast("string").alias("_text"))
    rows = rows.withColumn("_score", F.when(F.isnan("_score"), F.lit(None)).otherwise(F.col("_score")))
    # The range exchange samples its input in a separate job: keep the input
    # so the upstream (possibly a paid model scorer) is evaluated once.
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    tagged = (rows.repartitionByRange(partitions, *keys, *order)
              .sortWithinPartitions(*keys, *order)
              .withColumn("_gid", F.monotonically_increasing_id())
              .withColumn("_order0", F.col(order[0]))
              .select(*keys, "_gid", "_score", "_text", "_order0"))
    # Several branches read these rows: materialise them once so row numbers
    # agree (range bounds are sampled per shuffle) and the upstream scorer
    # never runs twice.
    tagged = materialize(tagged)
    rows.unpersist()
    return tagged


def match_escalations(df: DataFrame, keys: Sequence[str] = ("customer_id", "customer_name"),
                      order: Sequence[str] = ("message_timestamp", "source_partition", "source_offset"),
                      score: str = "sentiment_score", text: str = "message_text",
                      threshold: float = DEFAULT_THRESHOLD, separator: str = MESSAGE_SEPARATOR,
                      chunk_rows: int = DEFAULT_CHUNK_ROWS, partitions: int | None = None,
                      small_chunk: int = SMALL_CHUNK, settle_rows: int = SETTLE_ROWS) -> DataFrame:
    """One row per match: keys, karen_score_total, trigger_message_count,
    recent_messages, trigger_order (value of ``order[0]`` on the closing row).

    ``order`` must be unique within a key (the default Kafka position is);
    ``chunk_rows`` (or ``settle_rows``, if that is more) bounds the rows any
    single pandas call sees; chunks of at most ``small_chunk`` rows are
    summarised on plain lists instead of numpy.
    """
    keys, order = list(keys), list(order)
    spark = df.sparkSession
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shift = max(0, int(chunk_rows - 1).bit_length())
    settle_shift = max(shift, int(settle_rows - 1).bit_length())
    in_schema = df.schema
    key_fields = [in_schema[c] for c in keys]
    order0_type = in_schema[order[0]].dataType

    tagged = ordered_rows(df, keys, order, score, text, partitions).withColumns(
        {"_cb": F.shiftright("_gid", shift), "_sb": F.shiftright("_gid", settle_shift)})

    kfields = [T.StructField(f.name, f.dataType) for f in key_fields]
    how = Folds(threshold)
    summary_schema = T.StructType(kfields + [T.StructField("_cb", T.LongType()), *T.StructType.fromDDL(how.fields)])
    summarize_big, summarize_small = _summary_fn(keys, threshold), _summary_small_fn(keys, threshold)
    in_cols, out_cols = [*keys, "_cb", "_gid", "_score"], [*keys, *SUMMARY_COLS]

    def summarize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in spanning(batches, keys):
            if len(chunk) > small_chunk:
                yield summarize_big(chunk)[out_cols]
            else:
                out = {c: [] for c in out_cols}
                summarize_small({c: chunk[c].tolist() for c in in_cols}, 0, len(chunk), out)
                yield _frame(out)

    # Every chunk lies inside one range partition, already in order: the
    # summaries need no shuffle. Most keys lie inside one chunk and have none.
    summaries = materialize(tagged.select(*in_cols).sortWithinPartitions(*keys, "_cb", "_gid").mapInPandas(summarize, summary_schema))
    several = summaries.groupBy(*keys).count().where("count > 1").drop("count")
    resolved = scan(same(summaries, several, keys, "left_semi"), keys, "_cb", how, PARTITION_BITS - shift)
    # The first proposed state of each (key, settle chunk), for keys that have several of them. A key inside one chunk
    # starts there without an open match, so it has no state row: this side has about two rows a chunk.
    open_in = F.col("in_kind") == _OPEN
    first = F.min_by(F.struct(F.when(open_in, F.col("in_start")).otherwise(F.lit(-1)).alias("in_start"),
                              F.when(open_in, F.col("in_sum") / F.lit(float(SCORE_SCALE))).otherwise(F.lit(0.0)).alias("in_sum"),
                              F.when(open_in, F.col("in_cnt")).otherwise(F.lit(0)).alias("in_cnt")), "_cb")
    per_key = Window.partitionBy(*keys)
    states = (resolved.groupBy(*keys, F.shiftright("_cb", settle_shift - shift).alias("_sb")).agg(first.alias("_in"))
              .withColumn("_n", F.count("*").over(per_key)).withColumn("seq", F.row_number().over(per_key.orderBy("_sb")))
              .where("_n > 1").select(*keys, "_sb", "seq", "_in.*"))
    states = materialize(states)
    frag_schema = T.StructType(kfields + [
        T.StructField("match_gid", T.LongType()), T.StructField("_sb", T.LongType()),
        T.StructField("frag_count", T.LongType()), T.StructField("frag_texts", T.StringType()),
        T.StructField("frag_scores", T.ArrayType(T.DoubleType())), T.StructField("is_close", T.BooleanType()),
        T.StructField("t_text", T.StringType()), T.StructField("t_order", order0_type),
    ])
    # One state row per chunk joins its rows (null-safe on the keys). AQE
    # broadcasts the state side only when its measured size is small;
    # otherwise both sides shuffle on the chunk id, which keeps chunks whole.
    ids = [*keys, "_sb"]
    rows = tagged.select(*ids, "_gid", "_score", "_text", "_order0")
    fresh = {"in_start": -1, "in_sum": 0.0, "in_cnt": 0, "out_closes": False}
    if states.isEmpty():
        rows = rows.withColumns({c: F.lit(v) for c, v in fresh.items()})
    else:
        states = settled(tagged, states, keys, threshold)
        # Matches that close in a later chunk than the one they start in, by start
        # row id (unique): at most one per chunk, so this side stays small.
        closing = states.filter(F.col("in_hit")).select(F.col("in_start").alias("_closing_start"))
        states = (states.join(closing, F.col("o_start") == F.col("_closing_start"), "left")
                  .withColumn("out_closes", F.col("_closing_start").isNotNull()).drop("_closing_start"))
        rows = same(rows, states.select(*ids, "in_start", "in_sum", "in_cnt", "out_closes"), ids, "left").fillna(fresh)
    frags = (rows.sortWithinPartitions(*ids, "_gid")
             .mapInPandas(_per_chunk_stream(ids, None, _emit_fn(keys, threshold, separator),
                                            [*ids, "_gid", "_score", "_text", "_order0", *fresh],
                                            [*keys, *FRAG_COLS], small_rows=1 << 62),
                          frag_schema))

    # Only fragments of closing matches remain, so each group is one output row.
    matches = (frags.groupBy(*keys, "match_gid").agg(
        F.array_sort(F.collect_list(F.struct("_sb", "frag_texts", "frag_scores"))).alias("_f"),
        F.sum("frag_count").alias("trigger_message_count"),
        F.max(F.when(F.col("is_close"), F.struct("t_order", "t_text"))).alias("_t"),
    ).filter(F.col("_t").isNotNull()))
    pre = F.array_join(F.transform("_f", lambda f: f["frag_texts"]), separator)
    has_pre = F.exists("_f", lambda f: f["frag_texts"].isNotNull())
    return matches.select(
        *keys,
        F.aggregate(F.flatten(F.transform("_f", lambda f: f["frag_scores"])), F.lit(0.0),
                    lambda acc, v: acc + v).alias("karen_score_total"),
        F.col("trigger_message_count").cast("long").alias("trigger_message_count"),
        F.when(has_pre, F.concat(pre, F.lit(separator), F.col("_t.t_text"))).alias("recent_messages"),
        F.col("_t.t_order").alias("trigger_order"),
    )


def fold_reference(scores: Sequence[float | None], threshold: float = DEFAULT_THRESHOLD):
    """Plain sequential fold in doubles, used by tests as the brute-force definition.

    Returns a list of (first_index, last_index, total, count).
    """
    out, s, n, st = [], 0.0, 0, -1
    for i, x in enumerate(scores):
        if x is not None and np.isnan(x):
            x = None
        if n == 0:
            if x is not None and x > threshold:
                s, n, st = x, 1, i
        elif x is not None and s + x <= threshold:
            out.append((st, i, s + x, n + 1))
            s, n, st = 0.0, 0, -1
        else:
            s, n = s + (x or 0.0), n + 1
    return out
