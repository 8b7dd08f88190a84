"""Time-bounded matcher: batch against the plain definition at any chunking."""

import random

import pytest

from moodwire.operators.escalation import match_escalations
from moodwire.operators.within import match_escalations_within, within_reference

SCHEMA = ("customer_id string, customer_name string, message_timestamp long, source_partition int, source_offset long, "
          "sentiment_score double, message_text string")


def make(seed, keys=6, rows=60):
    rnd = random.Random(seed)
    out = {}
    for k in range(keys):
        ts, seq = 1_000, []
        for i in range(rows * 12 if k == 0 else rnd.randrange(1, rows)):
            ts += rnd.choice([0, 1, 5, 20, 80])
            x = None if rnd.random() < 0.05 else rnd.randrange(-40, 36) / 10.0
            seq.append((ts, x, None if rnd.random() < 0.1 else f"{k}-{i}"))
        out[None if k == 5 else f"c{k}", "n"] = seq
    return out


def table(spark, data):
    rows = [(c, n, ts, 0, i, x, t) for (c, n), seq in data.items() for i, (ts, x, t) in enumerate(seq)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def expected(data, within_ms):
    out = []
    for (c, n), seq in data.items():
        for a, b in within_reference([x for _, x, _ in seq], [t for t, _, _ in seq], within_ms):
            pre, last = [t for _, _, t in seq[a:b] if t is not None], seq[b][2]
            out.append((c, n, round(sum(x or 0.0 for _, x, _ in seq[a:b + 1]), 6), b - a + 1,
                        "\n".join(["|".join(pre), last]) if pre and last is not None else None, seq[b][0]))
    return sorted(out, key=str)


def got(df):
    return sorted(((r[0], r[1], round(r[2], 6), r[3], r[4], r[5]) for r in df.collect()), key=str)


@pytest.mark.parametrize("chunk_rows, partitions", [(1, 3), (4, 5), (64, 4), (1 << 18, 8)])
@pytest.mark.parametrize("within_ms", [60, 400])
def test_within_equals_definition(spark, chunk_rows, partitions, within_ms):
    data = make(chunk_rows + within_ms)
    df = match_escalations_within(table(spark, data), within_ms, chunk_rows=chunk_rows, partitions=partitions, separator="|")
    want = [(*w[:4], w[4].replace("\n", "|") if w[4] else None, w[5]) for w in expected(data, within_ms)]
    assert got(df) == want and want


def test_an_expired_start_hands_over(spark):
    """The first start never closes in time; the second has closed meanwhile and is taken."""
    data = {("a", "n"): [(0, 3.0, "x"), (10, -1.0, "y"), (20, -4.0, "z"), (500, -9.0, "w")]}
    assert got(match_escalations_within(table(spark, data), 100)) == [("a", "n", -5.0, 2, "y" + _sep() + "z", 20)]
    assert got(match_escalations_within(table(spark, data), 501))[0][3:] == (4, _sep().join("xyzw"), 500)


def _sep():
    from moodwire.functions.text import MESSAGE_SEPARATOR
    return MESSAGE_SEPARATOR


def test_wide_bound_holds_the_matches_of_the_unbounded_matcher(spark):
    data = {k: [(t, None if x is None else round(x * 8) / 8, s) for t, x, s in v] for k, v in make(9).items()}
    df = table(spark, data)
    free, wide = got(match_escalations(df, chunk_rows=16)), got(match_escalations_within(df, 1 << 60, chunk_rows=16))
    assert free and set(free) <= set(wide)
    for key in {w[0] for w in wide}:
        n = sum(f[0] == key for f in free)
        assert sorted(w[5] for w in wide if w[0] == key)[:n] == sorted(f[5] for f in free if f[0] == key)
    assert match_escalations_within(df.limit(0), 10).collect() == []
