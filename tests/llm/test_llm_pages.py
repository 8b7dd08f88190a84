"""Archives, search and URLs against brute force, damage and edge cases."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import ann, urls, warc
from moodwire.streaming.replay import scratch_path

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pages(spark):
    long = "é" * 80
    return spark.createDataFrame([
        (1, "http://a.com/x", long, 0), (2, "http://a.com/y", long, 0), (3, None, long, 0), (4, "http://b\r\nEvil: 1", "short", 0), (5, "u", "short", 0),
        (6, "http://c", None, 0), (7, "http://d", "", 0), (None, "http://e", "x" * 300_000, 0), (9, "http://f", long, 0), (9, "http://f", long, 0)],
        "page_id long, url string, html string, digest int")


def test_warc_round_trip(spark, pages):
    path = scratch_path(spark, "t")
    warc.write(pages, path)
    rows = warc.read(spark, path).collect()
    assert len(rows) == 10 and all(r["reason"] is None for r in rows)
    by = {r["page_id"]: r for r in rows}
    digest = hashlib.sha256(("é" * 80).encode()).hexdigest()
    assert by[1]["record_type"] == "response" and bytes(by[1]["payload"]).decode() == "é" * 80
    for i in (2, 3, 9):
        assert (by[i]["record_type"], by[i]["refers_to"], by[i]["payload_digest"], by[i]["payload_bytes"]) == ("revisit", 1, digest, 160)
    assert by[4]["record_type"] == by[5]["record_type"] == "response" and by[4]["uri"] == "http://b%0D%0AEvil:%201"
    assert by[6]["payload_bytes"] == by[7]["payload_bytes"] == 0 and by[3]["uri"] is None and by[None]["payload_bytes"] == 300_000
    empty = scratch_path(spark, "t")
    warc.write(pages.limit(0), empty)
    assert warc.read(spark, empty).count() == 0


def _one(i, body):
    return warc.record(i, f"http://x/{i}", body, hashlib.sha256(body).hexdigest(), None)


def test_salvage_recovers_after_damage():
    bodies = [f"page {i} ".encode() * 40 for i in range(6)]
    packed = [warc.member(_one(i, b)) for i, b in enumerate(bodies)]
    bad = bytearray(packed[2])
    bad[len(bad) // 2] ^= 0xFF
    data = packed[0] + warc.SEPARATOR + packed[1] + bytes(bad) + b"\x1f\x8b\x08 noise" + packed[3] + _one(4, bodies[4]) + packed[5][:-9]
    got = list(warc.salvage(data))
    assert [bytes(x[4]) for x in got if x[0] == "record"] == [bodies[0], bodies[1], bodies[3], bodies[4]]
    gaps = [(x[1], x[2]) for x in got if x[0] == "gap"]
    first = len(packed[0] + warc.SEPARATOR + packed[1])
    assert gaps == [(first, len(bad) + 9), (len(data) - len(packed[5]) + 9, len(packed[5]) - 9)]
    plain = _one(0, bodies[0]) + _one(1, bodies[1]).replace(b"page 1", b"page X", 1) + _one(2, bodies[2])
    kinds = [x[0] for x in warc.salvage(plain)]
    assert kinds == ["record", "gap", "record"]
    assert list(warc.salvage(b"")) == [] and [x[0] for x in warc.salvage(b"junk")] == ["gap"]


def test_salvage_inside_a_member_of_many_records(spark, scratch):
    rng = np.random.default_rng(5)
    bodies = [rng.integers(0, 256, 3000).astype(np.uint8).tobytes().hex().encode() for _ in range(8)]
    recs = [_one(i, b) for i, b in enumerate(bodies)]
    ids = lambda data: [int(x[3]["x-page-id"]) for x in warc.salvage(data) if x[0] == "record"]
    gaps = lambda data: [x[1:] for x in warc.salvage(data) if x[0] == "gap"]
    # One bad digest: the records around it stay, and the gap says where it is.
    wrong = recs[3].replace(bodies[3], bodies[3][::-1])
    one = warc.member(b"".join([*recs[:3], wrong, *recs[4:]]))
    data = one + warc.member(recs[0])
    assert ids(data) == [0, 1, 2, 4, 5, 6, 7, 0]
    assert gaps(data) == [(0, len(one), "payload digest differs", len(b"".join(recs[:3])), len(wrong))]
    # Cut short: all that was inflated; the next member is found.
    whole = warc.member(b"".join(recs))
    cut = whole[:len(whole) * 6 // 8]
    assert ids(cut) == [0, 1, 2, 3, 4] or ids(cut) == [0, 1, 2, 3, 4, 5]
    assert ids(cut + warc.member(recs[7]) + recs[6]) == [*ids(cut), 7, 6]
    assert {g[:2] for g in gaps(cut + warc.member(recs[7]))} == {(0, len(cut))} and gaps(cut)[-1][2] == "gzip member cut short"
    # A wrong CRC: records stay whose digest agrees, others are logged.
    bare = recs[2].replace(b"WARC-Payload-Digest", b"X-Other", 1)
    crc = bytearray(warc.member(b"".join([*recs[:2], bare, *recs[3:]])))
    crc[-6] ^= 0xFF
    assert ids(bytes(crc)) == [0, 1, 3, 4, 5, 6, 7]
    assert [(g[2], g[3]) for g in gaps(bytes(crc))] == [("no payload digest to check in a broken member", len(recs[0] + recs[1])),
                                                        ("bad gzip member", len(b"".join(recs)) - len(recs[2]) + len(bare))]
    # A flipped byte: whatever was inflated before it.
    flip = bytearray(whole)
    flip[len(flip) // 2] ^= 0xFF
    assert ids(bytes(flip))[:3] == [0, 1, 2] and all(bytes(x[4]) in bodies for x in warc.salvage(bytes(flip)) if x[0] == "record")
    with open(scratch + "/a.warc.gz", "wb") as f:
        f.write(data)
    rows = warc.read(spark, scratch).collect()
    assert [r["page_id"] for r in rows if r["record_type"]] == ids(data)
    assert [(r["offset"], r["length"], r["reason"], r["inner_offset"], r["inner_length"]) for r in rows if not r["record_type"]] == gaps(data)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.1"])
def test_search_recall_and_scores(spark, sf):
    rows = ann.op8_multi_index(spark, sf).toPandas()
    e = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    x, ids = np.stack(e.embedding).astype(float), e.vec_id.to_numpy()
    hits = []
    for q, g in rows.groupby("query_id"):
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        best = [i for i in ids[np.lexsort((ids, d))] if i != q][:10]
        hits.append(len(set(best) & set(g.vec_id)) / 10)
        assert np.allclose(g.sort_values("rank").score, np.sort(d[np.isin(ids, g.vec_id)]), rtol=0, atol=1e-12)
        assert list(g.sort_values("rank")["rank"]) == list(range(1, 11))
    assert len(hits) == (ids % 100 == 0).sum() and np.mean(hits) >= 0.9


def test_search_edges(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0], "x"), (1, [1.0, 0.0], "x"), (2, [0.0, 2.0], "x"), (3, None, "x"), (4, [0.0, 0.0], "x"), (5, [nan, 1.0], "x"),
            (6, [None, 1.0], "x"), (7, [1.0], "x"), (None, [1.0, 1.0], "x"), (100, [1.0, 0.0], "x"), (200, None, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = [tuple(r) for r in ann.search(df, df.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 0.0), (0, 2, 100, 0.0), (0, 3, 2, 5 ** 0.5), (100, 1, 0, 0.0), (100, 2, 1, 0.0), (100, 3, 2, 5 ** 0.5)]
    assert ann.search(df.limit(0), df).count() == 0


def test_search_repeated_queries_and_queries_of_another_length(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(0, [1.0, 0.0]), (0, [1.0, 0.0]), (7, [1.0]), (8, [2.0]), (9, [3.0])], df.schema)
    got = [tuple(r)[:3] for r in ann.search(df, asked).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2)]


def test_walk_is_in_order_of_summed_distance():
    rng = np.random.default_rng(3)
    a, b, n = rng.random(9), rng.random(7), rng.integers(0, 4, (9, 7))
    order = ann.walk(a, b, n, 10 ** 9)
    sums = [a[i] + b[j] for i, j in order]
    assert sums == sorted(sums) and set(order) == {(i, j) for i in range(9) for j in range(7) if n[i, j]}


def test_url_rules(spark):
    given = [None, "nothing", "http://EX.com/a?b#c", "https://www.Example.com/en/1", "https://example.com/en/1", "http://x.example.com/en/2?u", "http://a.net/es/1",
             "http://net/fr/", "http://example.com", "http://É.com/x", "http://h.org:80/p#f", "a://b://c/d", "http://a.net/es/1"]
    df = spark.createDataFrame(list(enumerate(given)), "page_id long, url string").withColumn("host", F.lit("clash"))
    got = {r["page_id"]: r for r in urls.judge(df).collect()}
    assert len(got) == len(given)
    for i, u in enumerate(given):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fit = max(((len(h + p), len(h), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)), default=None)
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, fit and fit[2])
        assert r["verdict"] == (fit[3] if fit else "allow")
    assert urls.judge(df.limit(0)).count() == 0


def test_url_templates_learn_blocked_branches(spark):
    rules = (("h.x", "/bad/1", "block"), ("h.x", "/good/1", "allow"))
    rows = [f"http://h.x/bad/{i}/p{i}" for i in range(10, 60)] + [f"http://h.x/good/{i}/p{i}" for i in range(10, 60)]
    rows += [f"http://h.x/bad/{i}/q" for i in range(100, 130)] + [f"http://h.x/good/{i}/q" for i in range(100, 130)]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = {r["page_id"]: r for r in urls.judge(df, rules=rules).collect()}
    for i, u in enumerate(rows):
        assert got[i]["verdict"] == ("block" if "/bad/" in u else "allow"), (u, got[i])
        assert "<n>" in got[i]["template"] or "*" in got[i]["template"]


def test_urls_of_many_segments(spark):
    """A path of thousands of segments is one branch; nothing of it is lost."""
    deep = "http://a.org" + "/s" * 3000
    rows = [(1, deep), (2, deep + "/t"), (3, "http://a.org/s"), (4, None)]
    got = {r["page_id"]: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[1]["path"] == "/s" * 3000 and got[2]["path"].endswith("/s/t") and len(got) == 4
    assert got[1]["template"] != got[2]["template"] and all(r["verdict"] == "allow" for r in got.values())


def test_url_tree_generalises_and_judges_deep_segments(spark):
    """Twenty segments; the eighteenth tells blocked pages from others, the last one varies."""
    rules = [("h.org", "/" + "/".join("abcdefghijklmnopq") + "/bad/x1/known", urls.BLOCK),
             ("h.org", "/" + "/".join("abcdefghijklmnopq") + "/good/x1/known", urls.ALLOW)]
    front = "http://h.org/" + "/".join("abcdefghijklmnopq")
    rows = [(k * 1000 + i, f"{front}/{word}/x1/{'known' if i < 60 else 'p'}{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}")
            for k, word in enumerate(("bad", "good")) for i in range(100)]
    got = {r["page_id"]: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules=rules).collect()}
    assert {got[i]["verdict"] for i in range(100)} == {"block"} and {got[1000 + i]["verdict"] for i in range(100)} == {"allow"}
    assert got[99]["template"].split("/")[18] == "bad" and got[99]["template"].endswith("/*") and got[99]["rule"] is None
