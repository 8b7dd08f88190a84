"""Model adapters with in-process fakes: one load per worker, one call per
non-blank row, error policies, retries; generator defaults and fallbacks."""

import hashlib
import pytest
from pyspark.sql import functions as F

from moodwire.functions import generation as G
from moodwire.functions import scoring as S

TEXTS = [("good day",), ("   ",), (None,), ("terrible!",), ("\t",)]


class CountingClassifier:
    calls = 0

    def predict(self, texts):
        CountingClassifier.calls += len(texts)
        return [0 if "terrible" in t else 4 for t in texts]


class FailingClassifier:
    def predict(self, texts):
        if len(texts) > 1:
            raise RuntimeError("batch failed")
        if "terrible" in texts[0]:
            raise RuntimeError("row failed")
        return [3]


def _scores(spark, scorer):
    df = spark.createDataFrame(TEXTS, "t string")
    return [r[0] for r in df.coalesce(1).select(scorer.score(F.col("t"))).collect()]


def test_classifier_scores_and_blank_guard(spark):
    got = _scores(spark, S.ClassifierScorer(CountingClassifier, cache_key="t-count"))
    assert got == [0.8, 0.0, 0.0, -0.8, 0.0]


def test_classifier_error_policies(spark):
    assert _scores(spark, S.ClassifierScorer(FailingClassifier, on_error="neutral", cache_key="t-fail-n")) == \
        [0.4, 0.0, 0.0, 0.0, 0.0]
    with pytest.raises(Exception):
        _scores(spark, S.ClassifierScorer(FailingClassifier, on_error="fail", cache_key="t-fail-f"))


class FlakyChat:
    def __init__(self):
        self.n = 0

    def complete(self, system, user, **kw):
        self.n += 1
        if self.n % 2 == 1:
            raise TimeoutError("first try fails")
        return " -0.7 " if "terrible" in user else "+2"


class DeadChat:
    def complete(self, system, user, **kw):
        raise ConnectionError("down")


def test_chat_scorer_retries_and_parses(spark):
    got = _scores(spark, S.ChatModelScorer(FlakyChat, sleep=lambda s: None, cache_key="t-flaky"))
    assert got == [1.0, 0.0, 0.0, -0.7, 0.0]
    got = _scores(spark, S.ChatModelScorer(DeadChat, sleep=lambda s: None, cache_key="t-dead"))
    assert got == [0.0] * 5


def test_retry_waits_are_clamped():
    waits = []
    with pytest.raises(ValueError):
        S.retry_call(lambda: (_ for _ in ()).throw(ValueError("x")), sleep=waits.append)
    assert waits == [4, 4]
    assert S.retry_call(lambda: 5, sleep=waits.append) == 5


def test_generator_defaults_and_fallbacks(spark):
    df = spark.createDataFrame([("hello there", None), ("  ", "m1"), ("x", "")], "p string, m string")
    gen = G.ChatModelGenerator(G.EchoChatClient, sleep=lambda s: None, cache_key="t-echo")
    got = [r[0] for r in df.coalesce(1).select(gen.generate(F.col("p"), F.col("m"))).collect()]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == [f"gpt-4o: {sha('hello there')}", G.NO_PROMPT_TEXT, f"gpt-4o: {sha('x')}"]
    dead = G.ChatModelGenerator(DeadChat, sleep=lambda s: None, cache_key="t-gdead")
    got = [r[0] for r in df.coalesce(1).select(dead.generate(F.col("p"), F.col("m"))).collect()]
    assert got == [G.CALL_FAILED_TEXT, G.NO_PROMPT_TEXT, G.CALL_FAILED_TEXT]
    fixed = [r[0] for r in df.select(G.FixedTextGenerator().generate(F.col("p"))).collect()]
    assert fixed == [G.OTHER_FAILURE_TEXT, G.NO_PROMPT_TEXT, G.OTHER_FAILURE_TEXT]


class SlowChat:
    """Each call waits, and answers with the prompt and the most calls this
    worker has seen in flight at once."""
    import threading
    lock, active, peak = threading.Lock(), 0, 0

    def complete(self, system, user, model=None, **kw):
        import time
        with SlowChat.lock:
            SlowChat.active += 1
            SlowChat.peak = max(SlowChat.peak, SlowChat.active)
        time.sleep(0.05)
        with SlowChat.lock:
            SlowChat.active -= 1
            return f"{user}|{SlowChat.peak}"


def test_generator_calls_overlap_and_keep_order(spark):
    prompts = [(f"p{i}",) for i in range(24)]
    df = spark.createDataFrame(prompts, "p string").coalesce(1)
    gen = G.ChatModelGenerator(SlowChat, sleep=lambda s: None, cache_key="t-slow", concurrency=6)
    got = [r[0] for r in df.select(gen.generate(F.col("p"))).collect()]
    assert [g.split("|")[0] for g in got] == [p for (p,) in prompts]
    assert max(int(g.split("|")[1]) for g in got) > 1


class CountingClient:
    """Writes down each call; the prompt "poison" fails until a flag file lies there."""

    def __init__(self, folder):
        self.folder = folder

    def complete(self, system, user, **kw):
        import os
        if "poison" in user and not os.path.exists(f"{self.folder}/healed"):
            raise KeyboardInterrupt("worker lost")
        with open(f"{self.folder}/calls", "a") as f:
            f.write(user + "\n")
        return "re: " + user


def test_ledger_pays_each_call_once_also_after_a_lost_job(spark, scratch):
    from moodwire.functions.generation import ChatModelGenerator
    from moodwire.functions.ledger import ask_once
    gen = ChatModelGenerator(lambda: CountingClient(scratch), sleep=lambda s: None, cache_key=f"count:{scratch}")
    texts = [f"p{i % 40}" for i in range(400)] + ["poison"] * 3
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, prompt string").withColumn("answer", F.lit("old"))

    def ask(rows):
        return ask_once(rows, "prompt", "answer", lambda p: gen.generate(p), "m", f"{scratch}/ledger", calls_per_task=1)
    with pytest.raises(Exception):
        ask(df)
    open(f"{scratch}/healed", "w").close()
    got = {r["i"]: r["answer"] for r in ask(df).collect()}
    assert got == {i: "re: " + t for i, t in enumerate(texts)}
    calls = open(f"{scratch}/calls").read().split()
    assert sorted(set(calls)) == sorted(set(texts)) and len(calls) <= len(set(texts)) + 8
    before = len(calls)
    assert ask(df).where("answer is null").count() == 0 and len(open(f"{scratch}/calls").read().split()) == before


def test_missing_key_fails_where_the_job_is_built(monkeypatch):
    from moodwire.functions.generation import ChatModelGenerator
    from moodwire.functions.scoring import ChatModelScorer
    monkeypatch.delenv("SOME_API_KEY", raising=False)
    for cls in (ChatModelScorer, ChatModelGenerator):
        with pytest.raises(ValueError):
            cls(object, key_variable="SOME_API_KEY")
    monkeypatch.setenv("SOME_API_KEY", "x")
    assert ChatModelScorer(object, key_variable="SOME_API_KEY").concurrency == 1
