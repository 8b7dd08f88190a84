"""Escalation matcher: hand-made cases, a property test against the plain
sequential fold, and the fixture counts."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from moodwire.operators import escalation as esc
from moodwire.operators.escalation import fold_reference, match_escalations

SCHEMA = ("customer_id string, customer_name string, message_timestamp long, source_partition int, "
          "source_offset long, sentiment_score double, message_text string")


def _frame(spark, seqs):
    rows = []
    for (cid, name), scores in seqs.items():
        for i, x in enumerate(scores):
            rows.append((cid, name, 1_000 + i, 0, i, x, f"{cid}-{i}"))
    return spark.createDataFrame(rows, SCHEMA)


def _run(spark, seqs, **kw):
    out = match_escalations(_frame(spark, seqs), **kw).collect()
    return sorted((r.customer_id, r.customer_name, r.karen_score_total, r.trigger_message_count,
                   r.recent_messages) for r in out)


def _expected(seqs):
    out = []
    for (cid, name), scores in seqs.items():
        for a, b, total, n in fold_reference(scores):
            out.append((cid, name, total, n, " \\n ".join(f"{cid}-{i}" for i in range(a, b + 1))))
    return sorted(out)


CASES = {
    ("c1", "A"): [0.8] + [-0.8] * 18,
    ("c2", "B"): [-0.5] * 24,
    ("c3", "C"): [-1.0] * 2,
    ("c4", "D"): [None] + [-0.8] * 7,
    ("c5", "E"): [-1.0] * 5,
    ("c6", "F"): [-1.0] * 4 + [None, -1.0],
    ("c7", "G"): [-6.0],
    ("c8", "H"): [-1.0] * 5,
    ("c8", "H2"): [-1.0] * 3,
}


@pytest.mark.parametrize("chunk_rows", [1 << 18, 4, 1])
def test_fixture_cases(spark, chunk_rows):
    rows = match_escalations(_frame(spark, CASES), chunk_rows=chunk_rows).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.customer_id, r.customer_name, r.trigger_order)):
        got.setdefault((r.customer_id, r.customer_name), []).append(
            (round(r.karen_score_total, 9), r.trigger_message_count))
    assert got[("c1", "A")] == [(-5.6, 9), (-5.6, 7)]
    assert got[("c2", "B")] == [(-5.0, 10), (-5.0, 10)]
    assert ("c3", "C") not in got
    assert got[("c4", "D")] == [(-5.6, 7)]
    assert got[("c5", "E")] == [(-5.0, 5)]
    assert got[("c6", "F")] == [(-5.0, 6)]
    assert ("c7", "G") not in got
    assert got[("c8", "H")] == [(-5.0, 5)] and ("c8", "H2") not in got


def test_matches_reference_fold_exactly(spark):
    assert _run(spark, CASES, chunk_rows=2) == _expected(CASES)


def test_totals_are_sequential_double_sums(spark):
    xs = [0.3, -0.7, -0.9, -0.7, -0.9, -0.7, -0.9, -0.6, 0.1, -0.3]
    seqs = {("k", "n"): xs}
    got = [(r[2], r[3]) for r in _run(spark, seqs, chunk_rows=3)]
    exp = [(t, n) for _, _, t, n in fold_reference(xs)]
    assert got == exp and len(got) == 1  # bit-identical doubles


def test_texts_skip_nulls_and_null_t_text_gives_null(spark):
    rows = [("k", "n", 1000 + i, 0, i, -1.0, t) for i, t in enumerate(["a", None, "c", "d", "e"])]
    rows += [("k2", "n", 1000 + i, 0, i, -1.0, t) for i, t in enumerate(["a", "b", "c", "d", None])]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.customer_id: r.recent_messages for r in match_escalations(df).collect()}
    assert got == {"k": "a \\n c \\n d \\n e", "k2": None}


scores = st.lists(st.one_of(st.none(), st.sampled_from([-1.0, -0.75, -0.5, -0.25, 0.0, 0.25, 0.5, 1.0, -6.0])),
                  min_size=0, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(scores, min_size=1, max_size=6), st.sampled_from([1, 2, 3, 8, 1 << 10]), st.sampled_from([0, 128]))
def test_property_equals_sequential_fold(spark, seqs, chunk_rows, small_chunk):
    data = {(f"c{i}", "n"): s for i, s in enumerate(seqs)}
    got = _run(spark, data, chunk_rows=chunk_rows, partitions=3, small_chunk=small_chunk)
    exp = _expected(data)
    assert got == exp
    for cid, _, total, n, _ in got:
        assert total <= -5.0 and n >= 2 and not math.isnan(total)


def test_fixture_counts(spark):
    from moodwire.plans import registry
    assert registry.escalation_matches(spark, "/root/testdata/sf0.01").count() == 397
    assert registry.escalation_matches(spark, "/root/testdata/sf0.01", sparse=True).count() == 39


def test_hot_key_is_split_and_exact(spark):
    """One customer holds ~90% of the rows: range partitioning spreads it over
    several partitions and chunks, and the result still equals the fold."""
    import random
    rnd = random.Random(7)
    vals = [-1.0, -0.5, -0.25, 0.0, 0.25, 0.5, None]
    seqs = {("hot", "H"): [rnd.choice(vals) for _ in range(20_000)]}
    for i in range(20):
        seqs[(f"c{i:02d}", "n")] = [rnd.choice(vals) for _ in range(100)]
    df = _frame(spark, seqs)
    got = _run(spark, seqs, chunk_rows=1024, partitions=8)
    assert got == _expected(seqs)
    from pyspark.sql import functions as F
    parts = (df.repartitionByRange(8, "customer_id", "customer_name", "message_timestamp")
             .filter(F.col("customer_id") == "hot").select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts >= 6


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-3.0, 2.0, allow_nan=False)), min_size=1, max_size=80),
       st.floats(-4.0, 4.0, allow_nan=False))
def test_list_and_numpy_chunk_paths_decide_alike(xs, s_in):
    """The short-chunk list path and the numpy path agree on every start, close
    and trajectory, including for arbitrary (non-grid) doubles."""
    import numpy as np
    from moodwire.operators.escalation import _Chunk, _Seq
    arr = np.array([np.nan if x is None else x for x in xs], dtype="float64")
    ch, sq = _Chunk(arr, -5.0), _Seq(arr.tolist(), -5.0)
    assert list(ch.nv) == sq.nv
    assert [int(e) for e in ch.end] == [sq.end(s) for s in range(len(xs))]
    assert [int(t) for t in ch.trajectories()] == [sq.open_start(p) for p in range(len(xs) + 1)]
    assert ch.close_in(s_in) == sq.close_in(s_in)
    assert ch.p.tolist() == sq.p


def test_hot_key_numpy_and_list_paths_agree(spark):
    import random
    rnd = random.Random(11)
    vals = [-1.0, -0.5, -0.25, 0.0, 0.25, 0.5, 0.8, None]
    seqs = {("hot", "H"): [rnd.choice(vals) for _ in range(3_000)]}
    for i in range(30):
        seqs[(f"c{i:02d}", "n")] = [rnd.choice(vals) for _ in range(rnd.randint(1, 300))]
    exp = _expected(seqs)
    for small in (0, 128, 1 << 20):
        assert _run(spark, seqs, chunk_rows=512, partitions=4, small_chunk=small) == exp


def test_decimal_ties_decide_the_same_at_any_chunking(spark):
    """Scores with one decimal reach the threshold exactly and often (e.g.
    -0.7 * 5 - 0.3 * 5). Decisions are made on the in-order double sums, so every
    chunking, both chunk paths, the reference fold and the SQL twin agree."""
    import random

    import duckdb
    import pandas as pd

    from moodwire.plans.fixture_sql import pattern_sql
    rnd = random.Random(3)
    vals = [-0.7, -0.3, -0.5, -0.1, 0.1, 0.3, 0.8, -1.0, None]
    seqs = {("hot", "H"): [rnd.choice(vals) for _ in range(4000)]}
    for i in range(12):
        seqs[(f"c{i:02d}", "n")] = [rnd.choice(vals) for _ in range(rnd.randint(1, 400))]
    exp = _expected(seqs)
    assert len(exp) > 100
    for chunk_rows, small in ((1 << 18, 128), (97, 128), (97, 0), (5, 128), (1, 0)):
        assert _run(spark, seqs, chunk_rows=chunk_rows, partitions=5, small_chunk=small) == exp
    rows = [(cid, name, 1_000 + i, 0, i, x, f"{cid}-{i}")
            for (cid, name), xs in seqs.items() for i, x in enumerate(xs)]
    src = pd.DataFrame(rows, columns=["customer_id", "customer_name", "message_timestamp", "source_partition",
                                      "source_offset", "sentiment_score", "message_text"])
    src["sentiment_score"] = src["sentiment_score"].astype("Float64")   # None -> SQL NULL, not NaN
    con = duckdb.connect()
    con.register("src", src)
    got = con.execute(f"SELECT customer_id, customer_name, karen_score_total, trigger_message_count, "
                      f"recent_messages FROM ({pattern_sql('SELECT * FROM src')}) m").fetchall()
    assert sorted(got) == exp


def _double_fold(xs):
    """The rule as written: a double sum added row by row, compared with <= -5.0."""
    out, total, rows, first = [], None, 0, 0
    for i, x in enumerate(xs):
        if total is None:
            if x > -5.0:
                total, rows, first = x, 1, i
            continue
        total, rows = total + x, rows + 1
        if total <= -5.0:
            out.append((first, i, total, rows))
            total = None
    return out


@pytest.mark.parametrize("settle_rows", [1, 8, 32])
def test_double_sums_decide_where_matches_cross_chunks(spark, settle_rows):
    """Start states are settled chunk by chunk, however wrong the proposed ones are, also under a long open run."""
    import random
    rnd = random.Random(settle_rows)
    vals = [-0.7, -0.3, -0.1, 0.1, 0.3]
    seqs = {("hot", "H"): [rnd.choice(vals) for _ in range(40 * settle_rows)],
            ("up", "U"): [0.3] * (10 * settle_rows) + [-0.1] * (40 * settle_rows),
            ("tie", "T"): [-0.7] * 5 + [-0.3] * 5 + [0.1, -0.1, -0.7, -0.3] * 6}
    exp = sorted((c, n, t, k, " \\n ".join(f"{c}-{i}" for i in range(a, b + 1)))
                 for (c, n), xs in seqs.items() for a, b, t, k in _double_fold(xs))
    got = _run(spark, seqs, chunk_rows=settle_rows, settle_rows=settle_rows, partitions=3)
    assert got == exp and all(r[2] <= -5.0 for r in got)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-10, 8).map(lambda k: k / 10), max_size=150))
def test_one_decimal_scores_decide_by_the_double_sum(xs):
    from moodwire.operators.escalation import walk
    exp = _double_fold(xs)
    assert [tuple(r) for r in fold_reference(xs)] == exp
    assert walk(xs, -5.0)[0] == [(a, b) for a, b, _, _ in exp]


@pytest.mark.parametrize("low, high", [(-1.0, 0.2), (-2.0, 1.0)])
def test_transition_keeps_break_points_only(low, high):
    """A falling chunk of 2^18 rows closes an incoming match at very many places, but leaves few different states."""
    x = np.random.default_rng(7).uniform(low, high, 1 << 18)
    one = esc._summary_fn(["k"], -5.0)(pd.DataFrame({"k": "a", "_cb": 0, "_gid": np.arange(len(x)), "_score": x}))
    assert 0 < len(one["rl_q"].iloc[0]) < 1000


def test_composed_transitions_equal_applying_in_turn():
    rng = np.random.default_rng(8)
    how = esc.Folds(-5.0)
    for _ in range(200):
        parts, at, fns = [rng.integers(-30, 25, rng.integers(1, 40)) / 10.0 for _ in range(3)], 0, []
        for x in parts:
            pdf = pd.DataFrame({"k": "a", "_cb": 0, "_gid": at + np.arange(len(x)), "_score": x})
            fns.append(tuple(esc._summary_fn(["k"], -5.0)(pdf)[esc.SUMMARY_COLS[1:]].iloc[0]))
            at += len(x)
        whole = how.then(how.then(fns[0], fns[1]), fns[2])
        again = how.then(fns[0], how.then(fns[1], fns[2]))
        for s in [None, *rng.integers(-49, 200, 20)]:
            state = how.start if s is None else (1, int(s) * 10 ** 8, 3, 10 ** 6)
            one = state
            for fn in fns:
                one = how.apply(one, fn)
            assert how.apply(state, whole) == one == how.apply(state, again)
