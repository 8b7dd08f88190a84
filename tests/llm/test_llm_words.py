"""Spelling variants, sharding and periodic runs against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm import runs, sharding, spelling

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


# ------------------------------------------------------------------------------------------- spelling variants

def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_groups(vocab):
    near = {w: [v for v in vocab if one_apart(w, v)] for w in vocab}
    form = {}
    for w, vs in near.items():
        top = min(vs, key=lambda v: (-vocab[v], v), default=None)
        form[w] = top if top is not None and vocab[top] >= 2 * vocab[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {(w, form[w], root(w), n, len(near[w]), vocab[form[w]] if form[w] else None) for w, n in vocab.items()}


def brute_words(rows):
    out = Counter()
    for i, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def grouped(spark, vocab):
    df = spark.createDataFrame(sorted(vocab.items()), "word string, n long")
    return {tuple(r) for r in spelling.variant_groups(df).select("word", "form", "root", "n", "n_near", "form_n").collect()}


@pytest.mark.parametrize("long_list, cut, signs", [(1, 1, "ab"), (3, 2, "abé"), (64, 100, "abcd"), (2, 10 ** 9, "ab")])
def test_variant_groups_brute_force(spark, monkeypatch, long_list, cut, signs):
    monkeypatch.setattr(spelling, "LONG", long_list)
    monkeypatch.setattr(spelling, "MIN_CUT", cut)
    rnd = random.Random(long_list)
    vocab = {"".join(rnd.choice(signs) for _ in range(rnd.randint(5, 8))): rnd.choice([3, 4, 6, 12, 30, 200]) for _ in range(220)}
    assert grouped(spark, vocab) == brute_groups(vocab)


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=5, max_size=12), st.integers(0, 30), st.sampled_from("abcx"),
       st.sampled_from("idr"), st.sets(st.text("abc", min_size=2, max_size=4), max_size=40))
def test_affected_gram_bound(word, at, sign, edit, some):
    """Whatever the dictionary, an edited word keeps at least (grams - bound) grams of both words."""
    frequent = {g[:k]: 1 for g in some for k in range(2, len(g) + 1)}
    at %= len(word)
    other = {"i": word[:at] + sign + word[at:], "d": word[:at] + word[at + 1:], "r": word[:at] + sign + word[at + 1:]}[edit]
    if len(other) < 5:
        return
    a, ga, ka = spelling.decompose(word, frequent)
    b, gb, kb = spelling.decompose(other, frequent)
    both = Counter(a[p:e] for p, e in ga) & Counter(b[p:e] for p, e in gb)
    assert sum(both.values()) >= max(len(ga) - ka, len(gb) - kb) >= 1


def test_spelling_query_and_edges(spark):
    rnd = random.Random(2)
    words = ["colour", "color", "colours", "Ünder", "straße", "école", "tionen", "tionne", "abcde", "naïve×naïve", "x"]
    rows = [(i, " ".join(rnd.choice(words) + rnd.choice(["", "s", "e"]) for _ in range(60)) + "1Foo-Bar") for i in range(40)]
    rows += [(1, None), (2, ""), (None, "colour colour colour COLOUR"), rows[0], rows[0], (7, "z" * 200_000), (8, "longer " * 100_000)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("word", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("id", F.lit(2))
    found = spelling.runs(docs)
    vocab = spelling.vocabulary(found.select(spelling.misspelt(F.col("id"), F.col("run")).alias("word")))
    want = brute_words(rows)
    assert {r["word"]: r["n"] for r in vocab.collect()} == want
    got = {tuple(r) for r in spelling.variant_groups(vocab).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == brute_groups(want) and any(g[1] for g in got)
    assert spelling.variant_groups(vocab.limit(0)).collect() == []


def test_spelling_query_whole_table(spark):
    want = brute_words([tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()])
    out = spelling.op11_spelling_variants(spark, SF).collect()
    assert {r["word"]: r["n"] for r in out} == want
    assert {tuple(r) for r in out} == brute_groups(want)


# ---------------------------------------------------------------------------------------------------- sharding

def test_shards_are_contiguous_and_near_equal(spark):
    rnd = random.Random(4)
    rows = [(i, "é" * rnd.randrange(400)) for i in range(3000)] + [(5, "same")] * 1500 + [(None, None)] * 20 + [(9, "x" * 30)] * 3
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("row", "size", "part", "at", "before", "shard", "slot", "k0", "k1", "tie", "bytes", "rows", "first"):
        df = df.withColumn(c, F.lit(c))
    out = sharding.sharded(df, shards=7)
    assert out.columns == [c for c in df.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    got = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows) and all(r["size"] == "size" for r in got)
    sizes, slots, spans = Counter(), {}, {}
    for r in got:
        sizes[r["shard"]] += len((r["text"] or "").encode()) + 16
        slots.setdefault(r["shard"], []).append(r["slot"])
        spans.setdefault(r["shard"], []).append((r["doc_id"] is None, r["doc_id"] or 0))
    assert sorted(sizes) == list(range(7)) and max(sizes.values()) - min(sizes.values()) <= 2 * (800 + 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(max(spans[k]) <= min(spans[k + 1]) for k in range(6))


def test_sharding_edges(spark, scratch):
    none = spark.createDataFrame([], SCHEMA)
    assert sharding.sharded(none).collect() == []
    few = spark.createDataFrame([(1, "a"), (2, "b" * 5_000_000), (3, None)], SCHEMA)
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.sharded(few, shards=4).collect()}
    assert got == {1: (0, 0), 2: (2, 0), 3: (3, 0)}
    bare = spark.createDataFrame([(i, None) for i in range(10)], SCHEMA)
    assert Counter(r["shard"] for r in sharding.sharded(bare, shards=5, overhead=0).collect()) == {k: 2 for k in range(5)}
    sharding.write_shards(bare, f"{scratch}/out", shards=2)
    back = spark.read.parquet(f"{scratch}/out")
    assert sorted(tuple(r) for r in back.select("doc_id", "shard", "slot").collect()) == [(i, i // 5, i % 5) for i in range(10)]


# ------------------------------------------------------------------------------------------------ periodic runs

def brute_runs(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(6, 4 * q):
                found.setdefault((s, i + q), q)
            i += 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=5), st.integers(1, 9)), max_size=8))
def test_runs_brute_force(parts):
    words = [x for part, times in parts for x in part * times]
    assert runs.find_all([words, words[1:]]) == [brute_runs(words), brute_runs(words[1:])]


def test_runs_of_long_texts():
    assert runs.find_all([["la"] * 100_000, ["x"], []]) == [[(0, 100_000, 1)], [], []]
    rnd = random.Random(5)
    part = [rnd.randrange(1000) for _ in range(700)]
    assert runs.find_all([[1, 2] + part * 40 + [3]])[0] == brute_runs([1, 2] + part * 40 + [3])


def brute_digest(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    keep = [x for i, x in enumerate(w) if not any(s + q <= i < s + m for s, m, q in found)]
    return (doc_id, len(found), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(keep).encode()).hexdigest())


def test_runs_query_brute_force(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in runs.op13_periodic_runs(spark, SF).collect()]
    want = [brute_digest(i, t) for i, t in rows if len(t or "") < 20_000]
    assert len(got) == len(rows) and set(want) <= set(got) and any(w[1] for w in want)


def test_runs_edges(spark):
    big = "ab cd " * 400_000 + "end " + "solo" * 300_000
    rows = [(1, "a a a a a a b"), (1, "a a a a a a b"), (None, None), (2, ""), (3, " \t\n"), (4, "one"), (5, big),
            (6, "            x"), (7, "A a A a A a A a")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("runs", F.lit(1)).withColumn("start", F.lit(2))
    out = runs.runs_of(df)
    assert out.columns == ["doc_id", "text", "start", "runs"]
    got = sorted(((r["doc_id"] or 0, [tuple(x) for x in r["runs"]]) for r in out.collect()))
    assert got == [(0, []), (1, [(0, 6, 1)]), (1, [(0, 6, 1)]), (2, []), (3, []), (4, []), (5, [(0, 800_000, 2)]), (6, [(0, 6, 1)]), (7, [(0, 8, 2)])]
    assert runs.runs_of(df.limit(0)).collect() == []
    assert runs.collapsed(list("xabababababy"), [(1, 10, 2)]) == list("xaby")
