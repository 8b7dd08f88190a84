"""Serving tables in packed files, rollups that merge, scorers bound to SQL names, token limits."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodwire.plans import rollup
from moodwire.sources import segments

SCHEMA = T.StructType.fromJson({"type": "struct", "fields": [
    {"name": "message_id", "type": "string", "nullable": True, "metadata": {}},
    {"name": "ts", "type": "long", "nullable": True, "metadata": {}}]})
DAY = 86_400_000


def rows(spark, lo, hi, parts=6):
    return spark.range(lo, hi, 1, parts).select(F.concat(F.lit("m"), F.col("id")).alias("message_id"), (F.col("id") % 3 * DAY + 5).alias("ts"))


def ids(spark, root):
    return sorted(int(r[0][1:]) for r in segments.read(spark, root, SCHEMA).collect())


def test_readers_see_either_set_of_files(spark, scratch):
    assert segments.read(spark, scratch, SCHEMA).collect() == [] and segments.compact(spark, scratch, SCHEMA) == 0
    assert segments.append(rows(spark, 0, 300), scratch, "ts", ("q", 0))
    before = segments.read(spark, scratch, SCHEMA)
    assert not segments.append(rows(spark, 0, 300), scratch, "ts", ("q", 0))       # the same batch run again
    assert len(segments.state(spark, scratch)[1]["files"]) == 18
    assert segments.compact(spark, scratch, SCHEMA) == 18
    files = segments.state(spark, scratch)[1]["files"]
    assert sorted(f["day"] for f in files) == ["1970-01-01", "1970-01-02", "1970-01-03"]
    assert ids(spark, scratch) == sorted(int(r[0][1:]) for r in before.collect()) == list(range(300))
    segments.append(rows(spark, 300, 400, 1), scratch, "ts", ("q", 1))
    assert segments.compact(spark, scratch, SCHEMA) == 6 and ids(spark, scratch) == list(range(400))
    assert segments.read(spark, scratch, SCHEMA).where(F.col("event_date") == "1970-01-02").count() == 133


def test_packed_files_stay_within_the_target(spark, scratch):
    segments.append(rows(spark, 0, 6000, 40), scratch, "ts")
    sizes = [f["bytes"] for f in segments.state(spark, scratch)[1]["files"]]
    target = 8 * max(sizes)
    segments.compact(spark, scratch, SCHEMA, target)
    packed = segments.state(spark, scratch)[1]["files"]
    assert len(packed) < len(sizes) / 4 and max(f["bytes"] for f in packed) <= target and ids(spark, scratch) == list(range(6000))


def test_bins_hold_the_target():
    rnd = random.Random(1)
    files = [{"path": str(i), "bytes": rnd.randrange(1, 100)} for i in range(200)]
    out = segments.bins(files, 100)
    assert all(len(b) > 1 and sum(f["bytes"] for f in b) <= 100 for b in out)
    assert all(f["bytes"] < 50 for b in out for f in b) and len({f["path"] for b in out for f in b}) == sum(map(len, out))


def test_a_stale_compaction_is_given_up(spark, scratch, monkeypatch):
    segments.append(rows(spark, 0, 60), scratch, "ts")
    real, calls = segments.publish, []

    def late(spark_, root, change):
        if not calls:
            calls.append(1)
            segments.compact(spark_, root, SCHEMA)       # another writer is faster
        return real(spark_, root, change)
    monkeypatch.setattr(segments, "publish", late)
    with pytest.raises(segments.Conflict):
        segments.compact(spark, scratch, SCHEMA)
    assert ids(spark, scratch) == list(range(60))


def test_stream_appends_each_batch_once(spark, scratch):
    rows(spark, 0, 50, 2).write.parquet(f"{scratch}/src")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(f"{scratch}/src")
    segments.stream_append(stream, f"{scratch}/t", "ts", f"{scratch}/ck", "seg", None).awaitTermination()
    assert ids(spark, f"{scratch}/t") == list(range(50))
    assert segments.state(spark, f"{scratch}/t")[1]["batches"] == {"seg": 1}


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_rollups_do_not_hang_on_partitions(spark, parts):
    rnd = random.Random(3)
    data = [(f"c{rnd.randrange(90)}", i * 1_000_000, rnd.choice([0.1, -0.7, 0.3, 1e-9, None, -0.2]), "F - Very Negative", rnd.choice("ab"))
            for i in range(2000)]
    df = spark.createDataFrame(data, "customer_id string, message_timestamp long, sentiment_score double, sentiment_category string, "
                                     "model_used string").repartition(parts)
    fine = rollup.sentiment_rollup(df, 3_600_000)
    day = {r[0]: r for r in rollup.rollup_metrics(rollup.merge_rollup(fine, DAY, ()), ()).collect()}
    direct = {r[0]: r for r in rollup.rollup_metrics(rollup.sentiment_rollup(df, DAY, ()), ()).collect()}
    assert day == direct
    for k, r in day.items():
        xs = [x for _, t, x, _, _ in data if t // DAY * DAY == k]
        exact = sum(round(x * 10**9) for x in xs if x is not None)
        assert r["msgs"] == len(xs) and r["avg_sentiment"] == (exact / 10**9) / sum(x is not None for x in xs)
        n = len({c for c, t, *_ in data if t // DAY * DAY == k})
        assert abs(r["unique_customers"] - n) <= max(1, n * rollup.ERROR_BOUND)


def test_native_scorer_keeps_its_value_under_a_sql_name(spark):
    from moodwire.functions.scoring import LexiconScorer, register
    sc = LexiconScorer({"it's": 0.5, "bad\\ly": -1.0, "good": 0.25, "été": 0.5})
    df = spark.createDataFrame([("good GOOD été",), ("bad",), (None,), (" \t ",), ("it's good",), ("good " * 9,)], "t string")
    register(spark, "score_x", sc)
    rows_ = df.select(F.expr("score_x(t)").alias("a"), sc.score(F.col("t")).alias("b")).collect()
    assert [r["a"] for r in rows_] == [r["b"] for r in rows_] and rows_[0]["a"] == 1.0
    assert "Python" not in df.selectExpr("score_x(t)")._jdf.queryExecution().executedPlan().toString()


class TokenModel:
    """One token a word; remembers what it was asked."""

    calls: list = []

    def token_lengths(self, texts, max_tokens):
        return [min(max_tokens, len(t.split())) for t in texts]

    def predict(self, texts, max_tokens=None):
        TokenModel.calls.append((list(texts), max_tokens))
        return [min(max_tokens, len(t.split())) % 5 for t in texts]


def test_calls_are_packed_by_tokens_and_whole_texts_reach_the_tokenizer():
    from moodwire.functions import scoring
    lengths = [3, 700, 2, 512, 9, 1, 40]
    for pack in scoring.packed(lengths, 600):
        assert len(pack) == 1 or len(pack) * max(lengths[i] for i in pack) <= 600
    assert sorted(i for p in scoring.packed(lengths, 600) for i in p) == list(range(7))
    assert scoring.ClassifierScorer(TokenModel).max_tokens == scoring.MODEL_MAX_TOKENS_INPUT == 512


def test_token_limit_through_spark(spark):
    from moodwire.functions import scoring
    texts = ["w " * n for n in (1, 5, 511, 512, 513, 2000)] + ["", None]
    sc = scoring.ClassifierScorer(TokenModel, cache_key="tokens", batch_tokens=600)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    got = [r[1] for r in df.select("i", sc.score(F.col("t"))).orderBy("i").collect()]
    from moodwire.functions.text import CLASS_SCORES
    assert got == [CLASS_SCORES[n % 5] for n in (1, 5, 511, 512, 512, 512)] + [0.0, 0.0]
