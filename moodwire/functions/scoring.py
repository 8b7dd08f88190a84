"""Pluggable sentiment scorers.

A scorer turns a text column into a DOUBLE score in [-1, 1] and names the
model it stands for (``model_used``). Three kinds exist:

* :class:`LexiconScorer` — native Catalyst expression (word weights summed and
  clamped). Deterministic, oracle-checkable, no Python at run time.
* :class:`ClassifierScorer` — an Arrow-batched iterator ``pandas_udf`` around a
  5-class model: the model is loaded once per Python worker, texts are sent in
  batches, class index -> score via the fixed class table.
* :class:`ChatModelScorer` — the same batching around a chat-completion client;
  the reply is parsed and clamped. Retries with exponential wait.

Model libraries are not part of this package: the classifier and the chat
client are injected as factories, so clusters bring their own and tests use
in-process fakes. Blank texts (Python ``strip`` rules) score 0.0 without a
model call in every scorer.
"""

from __future__ import annotations

import logging
import os
import time
import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodwire.functions import text as tx

log = logging.getLogger(__name__)

# --- fixed values that must equal the reference's -------------------------
CHAT_MODEL_DEFAULT = "gpt-4.1-nano"
CLASSIFIER_MODEL_DEFAULT = "tabularisai/multilingual-sentiment-analysis"
CUSTOM_MODEL_DEFAULT = "custom"
MODEL_MAX_TOKENS_INPUT = 512
CHAT_MAX_TOKENS = 10
CHAT_TEMPERATURE = 0.1
CALL_TIMEOUT_S = 30
RETRY_ATTEMPTS = 3
RETRY_WAIT_MIN_S = 4
RETRY_WAIT_MAX_S = 10
# --------------------------------------------------------------------------

#: Tokens that one model call may hold, padding included.
MODEL_BATCH_TOKENS = 32 * MODEL_MAX_TOKENS_INPUT

# Default lexicon of the native scorer: word -> weight. It is a stand-in for a
# model and is sized for the event-message fixture; pass your own for prose.
DEFAULT_LEXICON = {
    "error": -0.8,
    "view": -0.4,
    "signup": -0.4,
    "click": 0.0,
    "purchase": 0.4,
}
# Sparser variant used to exercise rarer escalations.
SPARSE_LEXICON = {
    "error": -0.8,
    "view": -0.4,
    "signup": 0.4,
    "click": 0.0,
    "purchase": 0.8,
}


class Scorer:
    """Interface: ``score(text_col) -> Column`` and ``model_name``."""

    model_name: str = "unknown"

    def score(self, text: Column) -> Column:  # pragma: no cover - interface
        raise NotImplementedError


class LexiconScorer(Scorer):
    """Sum of word weights over the lower-cased words, clamped to [-1, 1].

    Words are maximal runs of letters. Blank text scores 0.0 like the model
    scorers. Runs entirely in the JVM (split + transform + aggregate).
    """

    def __init__(self, lexicon: dict[str, float] | None = None, model_name: str = "lexicon"):
        self.lexicon = dict(lexicon or DEFAULT_LEXICON)
        self.model_name = model_name

    def score(self, text: Column) -> Column:
        words = F.split(F.lower(text), r"[^\p{L}]+")
        weights = F.create_map(*[x for kv in sorted(self.lexicon.items())
                                 for x in (F.lit(kv[0]), F.lit(float(kv[1])))])
        total = F.aggregate(
            F.transform(words, lambda w: F.coalesce(F.element_at(weights, w), F.lit(0.0))),
            F.lit(0.0), lambda acc, v: acc + v)
        clamped = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), total))
        return F.when(tx.is_blank_py(text), F.lit(0.0)).otherwise(clamped)

    def sql(self, text: str) -> str:
        """The same expression as SQL text over the SQL expression ``text``."""
        def quoted(v: str) -> str:
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        weights = ", ".join(f"{quoted(w)}, {float(x)!r}D" for w, x in sorted(self.lexicon.items()))
        total = (f"aggregate(transform(split(lower({text}), {quoted('[^' + chr(92) + 'p{L}]+')}), "
                 f"w -> coalesce(element_at(map({weights}), w), 0.0D)), 0.0D, (acc, v) -> acc + v)")
        return (f"CASE WHEN {text} IS NULL OR NOT rlike({text}, {quoted(tx.NON_BLANK_RE)}) THEN 0.0D "
                f"ELSE greatest(-1.0D, least(1.0D, {total})) END")


def retry_call(fn: Callable[[], object], attempts: int = RETRY_ATTEMPTS,
               wait_min: float = RETRY_WAIT_MIN_S, wait_max: float = RETRY_WAIT_MAX_S,
               sleep: Callable[[float], None] = time.sleep):
    """Call ``fn`` up to ``attempts`` times; exponential wait clamped to [min, max]."""
    last = None
    for i in range(attempts):
        try:
            return fn()
        except Exception as e:  # noqa: BLE001 - any error is retried
            last = e
            if i + 1 < attempts:
                sleep(min(wait_max, max(wait_min, 2 ** i)))
    raise last  # type: ignore[misc]


def require_key(variable: str | None) -> None:
    """Fail where a job is built if the key its client needs is not set."""
    if variable is not None and not os.environ.get(variable, "").strip():
        raise ValueError(f"environment variable {variable} is not set")


def parse_reply(reply: str | None) -> float:
    """Python-side twin of :func:`moodwire.functions.text.parse_score`."""
    try:
        v = float((reply or "").strip())
    except ValueError:
        return 0.0
    return max(-1.0, min(1.0, v))


# Per-worker model cache: one load per Python worker and factory key.
_WORKER_MODELS: dict[str, object] = {}


def _worker_model(key: str, factory: Callable[[], object]):
    m = _WORKER_MODELS.get(key)
    if m is None:
        m = factory()
        _WORKER_MODELS[key] = m
    return m


def call_all(fn: Callable, items: list, concurrency: int, key: str) -> list:
    """``[fn(x) for x in items]``, with up to ``concurrency`` calls in flight
    (remote model calls wait on the network). Results keep the input order;
    the thread pool is made once per Python worker."""
    if concurrency <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    from concurrent.futures import ThreadPoolExecutor
    pool = _worker_model(f"{key}:pool:{concurrency}", lambda: ThreadPoolExecutor(concurrency))
    return list(pool.map(fn, items))


def packed(lengths: Sequence[int], budget: int) -> list[list[int]]:
    """Indices in packs of like length: a pack's size times its longest stays within ``budget`` (one item always fits)."""
    out: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: lengths[i]):
        if out and (len(out[-1]) + 1) * lengths[i] <= budget:
            out[-1].append(i)
        else:
            out.append([i])
    return out


class ClassifierScorer(Scorer):
    """Batched 5-class classifier.

    ``factory()`` returns an object with ``predict(texts: list[str]) -> list[int]``
    (class indices). ``on_error``: ``"fail"`` re-raises (the local scorer
    fails the job), ``"neutral"`` scores the failing rows 0.0 one by one.

    A model that also has ``token_lengths(texts, max_tokens) -> list[int]`` is
    called as ``predict(texts, max_tokens=...)``: its own tokenizer cuts at
    ``max_tokens`` tokens (texts are never cut by characters here), and calls
    are packed by token length, so that padding a call's texts to its longest
    takes at most ``batch_tokens`` tokens.
    """

    def __init__(self, factory: Callable[[], object], model_name: str = CLASSIFIER_MODEL_DEFAULT,
                 on_error: str = "fail", cache_key: str | None = None, max_tokens: int = MODEL_MAX_TOKENS_INPUT,
                 batch_tokens: int = MODEL_BATCH_TOKENS):
        self.factory = factory
        self.max_tokens = max_tokens
        self.batch_tokens = batch_tokens
        self.model_name = model_name
        self.on_error = on_error
        self.cache_key = cache_key or f"clf:{model_name}:{uuid.uuid4().hex}"

    def _udf(self):
        factory, on_error, key = self.factory, self.on_error, self.cache_key
        scores, max_tokens, batch_tokens = list(tx.CLASS_SCORES), self.max_tokens, self.batch_tokens

        def predict(model, texts: list[str]) -> list:
            if not hasattr(model, "token_lengths"):
                return list(model.predict(texts))
            out: list = [None] * len(texts)
            for pack in packed(model.token_lengths(texts, max_tokens), batch_tokens):
                for i, v in zip(pack, model.predict([texts[i] for i in pack], max_tokens=max_tokens)):
                    out[i] = v
            return out

        def to_score(i) -> float:
            return scores[i] if i is not None and 0 <= i < len(scores) else 0.0

        @F.pandas_udf(T.DoubleType())
        def score_batches(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = _worker_model(key, factory)
            for texts in it:
                out = pd.Series(0.0, index=texts.index, dtype="float64")
                live = texts.notna() & texts.fillna("").str.strip().ne("")
                todo = texts[live].tolist()
                if todo:
                    try:
                        idx = predict(model, todo)
                        out[live] = [to_score(i) for i in idx]
                    except Exception:
                        if on_error != "neutral":
                            raise
                        vals = []
                        for t in todo:
                            try:
                                vals.append(to_score(predict(model, [t])[0]))
                            except Exception:  # noqa: BLE001
                                vals.append(0.0)
                        out[live] = vals
                yield out

        return score_batches.asNondeterministic()

    def score(self, text: Column) -> Column:
        return self._udf()(text)


class ChatModelScorer(Scorer):
    """Chat-model scorer; ``factory()`` returns ``complete(system, user, **kw) -> str``.

    Each non-blank text becomes one prompt; the reply is parsed and clamped.
    Calls are retried; a final error scores 0.0. ``concurrency`` bounds the
    calls in flight per Python worker (1 = one at a time). ``key_variable``
    names the environment variable the client takes its key from: a missing
    key fails on the driver, before any job starts.
    """

    def __init__(self, factory: Callable[[], object], model_name: str = CHAT_MODEL_DEFAULT,
                 sleep: Callable[[float], None] = time.sleep, cache_key: str | None = None,
                 concurrency: int = 1, key_variable: str | None = None):
        require_key(key_variable)
        self.factory = factory
        self.model_name = model_name
        self.sleep = sleep
        self.cache_key = cache_key or f"chat:{model_name}:{uuid.uuid4().hex}"
        self.concurrency = concurrency

    def _udf(self):
        factory, model, sleep, key = self.factory, self.model_name, self.sleep, self.cache_key
        concurrency = self.concurrency
        head, tail, system = tx.SENTIMENT_PROMPT_HEAD, tx.SENTIMENT_PROMPT_TAIL, tx.SENTIMENT_SYSTEM_PROMPT

        def one(client, t: str) -> float:
            if not t or not t.strip():
                return 0.0
            try:
                reply = retry_call(lambda: client.complete(
                    system, head + t + tail, model=model, max_tokens=CHAT_MAX_TOKENS,
                    temperature=CHAT_TEMPERATURE, timeout=CALL_TIMEOUT_S), sleep=sleep)
            except Exception:  # noqa: BLE001 - final error is neutral
                return 0.0
            return parse_reply(reply)

        @F.pandas_udf(T.DoubleType())
        def score_batches(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
            client = _worker_model(key, factory)
            for texts in it:
                vals = call_all(lambda t: one(client, t), texts.tolist(), concurrency, key)
                yield pd.Series(vals, index=texts.index, dtype="float64")

        return score_batches.asNondeterministic()

    def score(self, text: Column) -> Column:
        return self._udf()(text)


def register(spark, name: str, scorer: Scorer) -> None:
    """Bind a scorer to one SQL function name (drop-in swap of models): queries that call ``name(text)`` stay as they are.

    Native scorers become SQL functions with an expression body, so they stay inside the plan; model scorers are
    registered as vectorised functions. Binding a name again replaces what it stood for."""
    spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")
    if isinstance(scorer, LexiconScorer):
        spark.sql(f"CREATE TEMPORARY FUNCTION {name}(text STRING) RETURNS DOUBLE RETURN {scorer.sql('text')}")
    else:
        spark.udf.register(name, scorer._udf())  # type: ignore[attr-defined]


class LengthClassifier:
    """Dry-run 5-class model: class = character count mod 5. Deterministic;
    lets the batched classifier path run without model weights."""

    def predict(self, texts):
        return [len(t) % 5 for t in texts]
