"""Operators on documents against brute force, and their edge cases: nulls, empty and long texts, ties, repeated rows,
empty tables, extra columns with clashing names."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import bpe, fingerprint, langid, mixing, near_dup, pii, quality
from llm.common import components, shingle_sets

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = r"[^\x20\x09-\x0D]+"


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def shingles(t):
    w = re.findall(WORD, low(t))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


@pytest.fixture(scope="module")
def edge(spark):
    rnd = random.Random(1)
    words = ["alpha", "beta", "Gamma", "delta", "the", "of", "and", "été", "straße", "x1"]
    base = [rnd.choice(words) + str(rnd.randrange(400)) for _ in range(120)]
    near = list(base)
    near[60] = "changed"
    rows = [(1, " ".join(base), "en", "a", 1), (2, "".join(c.upper() if c.isascii() else c for c in " ".join(base)), "en", "a", 1), (3, " ".join(near), None, "b", None),
            (4, None, None, None, None), (5, "", "en", "a", 0), (6, "  \n\t", "en", "z", 4), (7, "one two", "en", "b", 7),
            (8, "one  two", "en", "b", 8), (9, "x" * 300_000, "de", "b", 300_000), (10, "Z\u00e9 \U0001f600 mail a@b.org", "fr", None, 3),
            (7, "one two", "en", "b", 7), (None, "no id here at all today", "en", "a", 5)]
    return spark.createDataFrame(rows, SCHEMA)


def test_near_duplicates_brute_force(spark, edge):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(
        edge.withColumn("doc_id", F.col("doc_id") + 1_000_000).select("doc_id", "text"))
    rows = [(r[0], r[1]) for r in docs.collect()]
    got = {r["doc_id"]: r for r in near_dup.near_duplicates(docs.withColumn("rep", F.lit(1))).collect() if r["doc_id"] is not None}
    sets = {i: shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    for i in ids:
        assert got[i]["component_id"] == find(i) and got[i]["n_shingles"] == len(sets[i])
        assert got[i]["kept"] == (i == find(i))
    none = [r for r in near_dup.near_duplicates(edge).collect() if r["doc_id"] is None]
    assert len(none) == 1 and none[0]["component_id"] is None and none[0]["kept"]


def test_near_duplicates_large_family_in_blocks(spark, monkeypatch):
    """Copies edited at random places: links that no pivot shows must still be found."""
    rnd = random.Random(7)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rnd.randrange(0, 7)):
            w[rnd.randrange(150)] = f"e{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: shingles(t) for i, t in rows}
    pairs = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    root = dict(zip(sets, sets))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {i: find(i) for i in sets}


def _families(n, seed=11):
    """Texts in families whose members differ from the first by edited words: similarities around 0.7 to 0.95."""
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(100)]
        for k in (0, 1, 2, 2, 3, 3):
            w = list(base)
            for at in rnd.sample(range(5, 95), k):
                w[at] = f"e{rnd.randrange(10**6)}"
            rows.append((len(rows), " ".join(w)))
    return rows


def test_keep_one_at_the_stage_threshold(spark):
    """The pipeline stage links at 0.8, also pairs that op10's 0.85 leaves apart."""
    rows = _families(60)
    sets = {i: shingles(t) for i, t in rows}
    like = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in range(a) if a // 6 == b // 6}
    assert sum(0.8 <= x < 0.85 for x in like.values()) > 30
    root = dict(zip(sets, sets))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], SCHEMA)
    assert sorted(r["doc_id"] for r in near_dup.keep_one(spark, docs).collect()) == [i for i in sets if find(i) == i]


def test_keep_one_of_repeated_rows_and_rows_without_id(spark):
    (_, a), (_, near_a), _, (_, b), _, _, (_, c), (_, near_c), *_ = _families(2, seed=3)
    other = " ".join(reversed(b.split()))
    rows = [(5, a, "en", "a", 1)] * 3 + [(5, a, "de", "a", 1), (9, near_a, "en", "a", 1), (7, other, "en", "a", 1), (7, "one two", "en", "a", 1),
            (8, "", "en", "a", 0), (8, "", "en", "a", 0), (None, a, "en", "a", 1), (None, near_c, "en", "z", 1), (None, "", "en", "a", 0), (None, None, "en", "a", 0)]
    rows += [(None, c, "en", "a", 1)] * 40 + [(None, None, "en", "a", 0), (None, "", "en", "a", 0)]
    got = sorted(((r["doc_id"], r["text"], r["lang"]) for r in near_dup.keep_one(spark, spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    in_c = [r for r in got if r[1] in (c, near_c)]
    assert len(in_c) == 1 and in_c[0][0] is None
    assert [r for r in got if r not in in_c] == sorted([(5, a, "de"), (7, other, "en"), (7, "one two", "en"), (8, "", "en"),
                                                        (None, "", "en"), (None, None, "en")], key=str)
    plain = spark.createDataFrame([(1, a, "en", "a", 1), (2, other, "en", "a", 1)], SCHEMA)
    assert sorted(r["doc_id"] for r in near_dup.keep_one(spark, plain.withColumn("extra", F.lit(1))).collect()) == [1, 2]
    assert near_dup.keep_one(spark, plain.limit(0)).count() == 0


def test_banding_follows_the_threshold():
    assert near_dup.banding(85) == (5, 25) and near_dup.likely_at(85) == 0.68
    for percent in range(20, 101):
        rows, bands = near_dup.banding(percent)
        assert rows * bands < 128 and (1 - (percent / 100) ** rows) ** bands <= 5e-7 and near_dup.likely_at(percent) < percent / 100
    with pytest.raises(ValueError):
        near_dup.banding(5)


def test_components_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300) if i % 100 != 99], "a long, b long").repartition(7)
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert all(got.get(i, i) == i // 100 * 100 for i in range(300))


def test_superminhash_estimates_and_stops():
    rng = np.random.default_rng(0)
    err = []
    for _ in range(60):
        pool = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
        a, b = pool[:200], pool[100:]
        s = near_dup.superminhash([a, b])
        err.append((s[0] == s[1]).mean() - len(np.intersect1d(a, b)) / len(pool))
    assert abs(np.mean(err)) < 0.02 and np.std(err) < 0.05
    assert (near_dup.superminhash([np.empty(0, np.uint64)]) == 0xFFFFFFFF).all()


def test_long_text_shingles_match_short_path():
    text = " ".join(f"w{i % 977} " for i in range(250_000)).encode()
    assert len(text) > 1 << 20
    assert len(shingle_sets([text])[0]) == len(shingles(text.decode()))


def _tiktoken():
    import public_tokenizers
    import tiktoken
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    return ranks, public_tokenizers.PATTERN, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_round_trip(spark, edge):
    ranks, pattern, enc = _tiktoken()
    docs = edge.withColumn("token_ids", F.lit("clash"))
    out = bpe.decode(bpe.encode(docs, ranks, pattern, buckets=3, chunk_chars=2000), ranks).collect()
    want = sorted(((r["doc_id"] or -1, r["text"] or "") for r in edge.collect()))
    got = sorted((r["doc_id"] or -1, bytes(r["decoded"]).decode()) for r in out)
    assert got == want
    ids = {r["doc_id"]: list(r["token_ids"]) for r in out}
    assert all(ids[i] == enc.encode_ordinary(t) for i, t in ((r["doc_id"], r["text"] or "") for r in edge.collect()))
    assert bpe.encode(docs.limit(0), ranks, pattern).count() == 0


def test_bpe_query_digests(spark):
    _, _, enc = _tiktoken()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = bpe.op2_byte_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = enc.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_bpe_classes_and_long_words():
    ranks, pattern, enc = _tiktoken()
    split = bpe.splitter(pattern)
    for c in [*range(0x300), 0x558, 0x88F, 0x1C89, 0xA7CB, 0xA7CE, 0x10940, 0x10D50, 0x323B0, 0x3D000, 0x2028, 0x3000]:
        t = f"a{chr(c)}'s 1{chr(c)}1 {chr(c)}"
        assert [i for w in split(t) for i in bpe.merge(w.encode(), ranks)] == enc.encode_ordinary(t), hex(c)
    rnd = random.Random(2)
    for n in (1, 127, 129, 900):
        for signs in ("a", "ab", "=-", "the "):
            w = "".join(rnd.choice(signs) for _ in range(n)).encode()
            assert bpe.merge(w, ranks) == enc._core_bpe.encode_single_piece(w)


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(t):
    def ok(k, m):
        d = re.sub("[^0-9]", "", m)
        if k == "ip":
            return all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.split("."))
        if k == "card":
            s = sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d))))
            return 14 <= len(d) <= 19 and s % 10 == 0
        return k == "email" or 10 <= len(d) <= 15
    found = [(m.start(), i, m.end(), k) for i, k in enumerate(BASE) for m in re.finditer(BASE[k], t or "") if ok(k, m[0])]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def test_pii_base_spans(spark):
    rnd = random.Random(4)
    texts = [None, "", "a@b.c_d@e.f x@y.z@w.v", "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.0255", "+1 (555) 123-4567 +1+2 +12345678901",
             "4111 1111 1111 1111 4111-1111-1111-1112", "é \U0001f600 a.b+c@d-e.fr.", "1" * 5000 + ".1.1.1", "a@" + "b." * 5000 + "c",
             "a@b.cc 1.1.1.1 " * 800, "call 555-123-4567, ssn 123-45-6789; joe [at] ex [dot] com Mr. Smith"]
    texts += ["".join(rnd.choice("ab1.@+- 0()%_é\U0001f6004") for _ in range(rnd.randint(1, 60))) for _ in range(200)]
    texts += ["".join(rnd.choice("12345.-+ ") for _ in range(rnd.randint(1, 80))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.candidates(df)
    out = pii.detect(found, pii.fit(found)).select("doc_id", pii.span_text("_pii_base").alias("b"), pii.span_text("_pii_spans").alias("s")).collect()
    for r in out:
        assert r["b"] == base_spans(texts[r["doc_id"]]), texts[r["doc_id"]][:80]
        assert set(filter(None, r["b"].split(","))) <= set(r["s"].split(","))
    assert "MapIn" not in found._jdf.queryExecution().toString() and "Python" not in found._jdf.queryExecution().toString()


def test_pii_redaction_keeps_columns_and_clean_text(spark, edge):
    out = pii.redacted(spark, edge.withColumn("l", F.lit(1)))
    assert out.columns == [*edge.columns, "l"] and out.count() == edge.count()
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[10] == "Z\u00e9 \U0001f600 mail [EMAIL]" and texts[4] is None and texts[5] == "" and texts[7] == "one two"
    assert pii.redacted(spark, edge.limit(0)).count() == 0


def test_fingerprints(spark, edge):
    docs = edge.where("doc_id is not null").dropDuplicates(["doc_id"])
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    order = sorted(texts)
    out = {r["doc_id"]: r for r in fingerprint.in_order(docs.select("doc_id", "text"), 5).mapInArrow(
        fingerprint._edit_batches, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double").collect()}
    assert sorted(out) == order
    for n, i in enumerate(order):
        a, b = texts[i], texts[order[(n + 1) % len(order)]]
        q = len(a) // 4
        e = a[:len(a) - q] + b[:q]
        assert out[i]["n_chars"] == len(a) and out[i]["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        x, y = shingles(a), shingles(e)
        if len(x | y) <= fingerprint.K:
            assert out[i]["near_edited"] == pytest.approx(len(x & y) / len(x | y) if x | y else 1.0)
    assert out[1]["fingerprint"] == out[2]["fingerprint"] and out[1]["near_next"] == 1.0
    one = docs.where("doc_id = 1").select("doc_id", "text")
    assert fingerprint.in_order(one, 5).count() == 2  # itself and the look-ahead copy
    assert fingerprint.in_order(one.limit(0), 5).count() == 0


def test_fingerprint_merge_and_containment(spark):
    rows = [(i, i % 2, " ".join(f"w{(i * 37 + k) % 911}" for k in range(90))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, g int, text string")
    for r in fingerprint.merged(fingerprint.fingerprints(df), ["g"]).collect():
        parts = [fingerprint.sketch(shingle_sets([t.encode()])[0]) for _, g, t in rows if g == r["g"]]
        assert (fingerprint.from_text(r["fingerprint"]) == fingerprint.merge(*parts)).all()
    a = fingerprint.sketch(shingle_sets([" ".join(f"w{k}" for k in range(1000)).encode()])[0])
    b = fingerprint.sketch(shingle_sets([" ".join(f"w{k}" for k in range(2000)).encode()])[0])
    assert fingerprint.containment(a, b) > 0.75 and 0.35 < fingerprint.resemblance(a, b) < 0.65
    assert 750 < fingerprint.distinct(a) < 1300


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = langid.op5_language_id(spark, sf).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and len(held) > 150
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95


def test_language_edges(spark, edge):
    model = langid.learn(edge.select("doc_id", "text", F.col("lang").alias("label")))
    out = {r["doc_id"]: r for r in langid.predict(edge.withColumn("score", F.lit("clash")), model).collect()}
    assert out[4]["lang_pred"] == out[5]["lang_pred"] == out[6]["lang_pred"] == "und" and out[4]["score"] == 0
    assert out[1]["lang_pred"] in {"en", "de", "fr"} and 0 <= out[1]["score"] <= 1
    nothing = langid.learn(edge.where("lang = 'xx'").select("doc_id", "text", F.col("lang").alias("label")))
    assert {r["lang_pred"] for r in langid.predict(edge, nothing).collect()} == {"und"}


def test_quality_against_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet").select(
        "doc_id", F.col("quality").alias("y")), "doc_id")
    rows = quality.score(docs.select("doc_id", "text", "y"), quality.learn(docs)).collect()
    assert np.mean([r["keep"] for r in rows if r["y"] == 1]) > 0.99 and np.mean([not r["keep"] for r in rows if r["y"] == 0]) > 0.95


def test_quality_edges(spark, edge):
    out = {r["doc_id"]: r for r in quality.score(edge.withColumn("keep", F.lit("clash")), quality.learn(edge)).collect()}
    assert not out[4]["keep"] and not out[5]["keep"] and not out[6]["keep"] and out[4]["quality"] == 0
    empty = quality.learn(edge.limit(0))
    assert all(r["keep"] for r in quality.score(edge.where("doc_id = 1"), empty).collect())
    assert quality.accepted(spark, edge).columns == edge.columns


def test_quality_stage_sends_texts_once(spark, edge, capsys):
    """Only the text goes to Python, in batches bounded by bytes; columns with any name stay as they are."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.unset(key)
    try:
        docs = edge.withColumn("a.b", F.lit(1)).withColumn("Quality", F.lit("q")).withColumn("keep", F.lit("k"))
        kept = quality.accepted(spark, docs)
        assert int(spark.conf.get(key)) <= 8 << 20
        assert kept.columns == docs.columns and {(r["Quality"], r["keep"], r["a.b"]) for r in kept.collect()} <= {("q", "k", 1)}
        model = quality.learn(docs)
        good = {r["doc_id"] for r in quality.score(edge, model).where("keep").collect()}
        assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(
            str(r["doc_id"]) for r in edge.collect() if r["doc_id"] in good)
        kept.explain()
        plan = capsys.readouterr().out
        assert "MapInArrow" not in plan and plan.count("ArrowEvalPython") == 1
        sizes = docs.sparkSession.range(0, 3000, 1, 1).select(F.repeat(F.lit("word "), 1000).alias("t")).mapInArrow(
            lambda bs: (b.slice(0, 1).set_column(0, "t", [str(b.nbytes)]) for b in bs), "t string").collect()
        assert len(sizes) > 1 and max(int(r["t"]) for r in sizes) < 8 << 20
        spark.conf.set(key, "123456")
        quality.score(edge, model)
        assert spark.conf.get(key) == "123456"
    finally:
        spark.conf.unset(key)
        if before is not None:
            spark.conf.set(key, before)


def test_mix_totals_and_shards(spark, edge):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", mixing.words("text").alias("size"))
    rows = mixing.mix(docs, shards=8, block_words=500).collect()
    again = mixing.mix(docs.repartition(5), shards=8, block_words=500).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    by = defaultdict(lambda: [0, 0, 0])
    shard = defaultdict(int)
    for r in rows:
        assert len(r["draws"]) <= 2
        by[r["source"]][0] = r["target"]
        by[r["source"]][1] += r["size"] * r["copies"] * len(r["draws"])
        by[r["source"]][2] = max(by[r["source"]][2], r["size"] * r["copies"])
        for d in r["draws"]:
            shard[d["shard"]] += r["size"]
    assert all(abs(got - want) <= most / 2 + 1 for want, got, most in by.values())
    total = sum({r["source"]: r["source_size"] for r in rows}.values())
    assert sum(v[0] for v in by.values()) == pytest.approx(1.5 * total) and len(shard) == 8


def test_mix_shards_grow_with_the_mix(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2], 10) for i in range(400)], "doc_id long, source string, size long")
    few, many = mixing.mix(docs, shards=2, block_words=20), mixing.mix(docs, shards=2, block_words=20, shard_words=100)
    count = lambda d: len({x["shard"] for r in d.collect() for x in r["draws"]})
    assert count(few) == 2 and count(many) == 60
    taken = lambda d: sorted((r["doc_id"], len(r["draws"])) for r in d.collect())
    assert taken(few) == taken(many)


def test_mix_tree_draws_are_disjoint_and_exact(spark):
    blocks = spark.createDataFrame([(i, n) for i, n in enumerate([50, 0, 7, 300, 1])], "rank long, blocks long")
    rows = mixing.split(blocks, shards=10).collect()
    per = defaultdict(int)
    for rank, n in enumerate([50, 0, 7, 300, 1]):
        got = sorted(k for r in rows if r["rank"] == rank for k in range(r["first"], r["first"] + r["n"]))
        assert got == list(range(n))
    for r in rows:
        per[r["shard"]] += r["n"]
    assert sorted(per) == list(range(10)) and max(per.values()) - min(per.values()) <= 1


def test_mix_edges(spark, edge):
    out = mixing.mixed(spark, edge)
    assert out.columns == edge.columns and out.where("text is null or trim(text) = ''").count() == 0
    assert mixing.mixed(spark, edge.limit(0)).count() == 0


def test_every_label_is_learned(spark):
    """Three hundred languages, each with letters of its own: all can be predicted."""
    rnd = random.Random(11)
    rows = []
    for k in range(300):
        signs = [chr(0x4E00 + 20 * k + i) for i in range(20)]
        rows += [(k * 100 + i, " ".join("".join(rnd.choice(signs) for _ in range(5)) for _ in range(30)), f"lang{k:03}") for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string")
    model = langid.learn(df)
    clash = df.withColumns({"_text": F.lit("x"), "_letter": F.lit(1), "a.b": F.lit(2)})
    got = langid.predict(clash, model).collect()
    assert len(model["labels"]) == 300 and {(r["_text"], r["_letter"], r["a.b"]) for r in got} == {("x", 1, 2)}
    assert sum(r["lang_pred"] == r["label"] for r in got) >= 0.99 * len(rows), sum(r["lang_pred"] == r["label"] for r in got)


def test_bpe_query_needs_one_worker_behind_the_join(spark, tmp_path):
    """Rejoining, decoding and digesting run in one Python worker; kept columns do not keep the texts they came with."""
    import pyarrow as pa
    from llm import bpe
    rows = [(i, None if i == 3 else ("word %d \u00e9 " % i) * i) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = bpe.op2_byte_bpe(spark, str(tmp_path))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 2
    got = {r.doc_id: r.decoded_sha256 for r in out.collect()}
    assert got == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in rows}
    sink = pa.BufferOutputStream()
    batch = pa.record_batch([pa.array(range(100)), pa.array(["x" * 10_000] * 100)], names=["doc_id", "text"])
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    before = pa.total_allocated_bytes()
    received = pa.ipc.open_stream(sink.getvalue().to_pybytes()).read_next_batch()
    own = bpe._own(received.select(["doc_id"]))
    assert own.column(0).to_pylist() == list(range(100)) and pa.total_allocated_bytes() - before < 100_000
    assert own.column(0).buffers()[1].address != received.column(0).buffers()[1].address
