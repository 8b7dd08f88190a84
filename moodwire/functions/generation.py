"""Response generators for escalations.

``Generator.generate(prompt_col, model_col) -> Column``. The native
:class:`FixedTextGenerator` answers every prompt with the fixed
acknowledgement (deterministic; used where results are compared), the
:class:`ChatModelGenerator` calls an injected chat client per prompt from an
Arrow-batched iterator ``pandas_udf`` (client made once per Python worker).
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodwire.functions.scoring import CALL_TIMEOUT_S, _worker_model, call_all, require_key, retry_call

# --- fixed values that must equal the reference's -------------------------
RESPONSE_MODEL_DEFAULT = "gpt-4o"
NO_PROMPT_TEXT = "No prompt provided"
CALL_FAILED_TEXT = ("Thank you for your feedback. We appreciate your business and will review "
                    "your concerns promptly.")
OTHER_FAILURE_TEXT = "Thank you for your feedback. We appreciate your business."
RESPONSE_SYSTEM_PROMPT = """You are a witty, snarky, sarcastic, and slightly mean customer service response generator. 
                        You are aware that you are an AI customer service bot and you are not ashamed of that.
                        Keep responses concise, clever, and most importantly hilarious. 50 words max. """
RESPONSE_MAX_TOKENS = 200
RESPONSE_TEMPERATURE = 0.8
# --------------------------------------------------------------------------


def _blank(c: Column) -> Column:
    from moodwire.functions.text import is_blank_py
    return is_blank_py(c)


class Generator:
    model_name: str = RESPONSE_MODEL_DEFAULT

    def generate(self, prompt: Column, model: Column | None = None) -> Column:  # pragma: no cover
        raise NotImplementedError


class FixedTextGenerator(Generator):
    """Native stand-in: blank prompt -> ``No prompt provided``, else the fixed
    acknowledgement a failed generation returns."""

    def __init__(self, text: str = OTHER_FAILURE_TEXT):
        self.text = text

    def generate(self, prompt: Column, model: Column | None = None) -> Column:
        return F.when(_blank(prompt), F.lit(NO_PROMPT_TEXT)).otherwise(F.lit(self.text))


class ChatModelGenerator(Generator):
    """``factory()`` returns a client with ``complete(system, user, **kw) -> str``.

    Blank prompt -> ``No prompt provided``; NULL/empty model -> the default
    model; each call is retried, then the call-failure text is returned.
    ``concurrency`` bounds the calls in flight per Python worker;
    ``key_variable``: see :class:`moodwire.functions.scoring.ChatModelScorer`.
    """

    def __init__(self, factory: Callable[[], object], default_model: str = RESPONSE_MODEL_DEFAULT,
                 sleep: Callable[[float], None] = time.sleep, cache_key: str | None = None,
                 concurrency: int = 1, key_variable: str | None = None):
        require_key(key_variable)
        self.factory = factory
        self.default_model = default_model
        self.sleep = sleep
        self.cache_key = cache_key or f"gen:{default_model}:{uuid.uuid4().hex}"
        self.concurrency = concurrency

    def _udf(self):
        factory, default, sleep, key = self.factory, self.default_model, self.sleep, self.cache_key
        concurrency = self.concurrency

        def one(client, prompt, model) -> str:
            if not prompt or not str(prompt).strip():
                return NO_PROMPT_TEXT
            use = model if isinstance(model, str) and model else default
            try:
                reply = retry_call(lambda: client.complete(
                    RESPONSE_SYSTEM_PROMPT, prompt, model=use, max_tokens=RESPONSE_MAX_TOKENS,
                    temperature=RESPONSE_TEMPERATURE, timeout=CALL_TIMEOUT_S), sleep=sleep)
                return str(reply).strip()
            except Exception:  # noqa: BLE001 - final failure answers politely
                return CALL_FAILED_TEXT

        @F.pandas_udf(T.StringType())
        def gen(it: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            client = _worker_model(key, factory)
            for prompts, models in it:
                vals = call_all(lambda pm: one(client, *pm), list(zip(prompts, models)), concurrency, key)
                yield pd.Series(vals, index=prompts.index, dtype="object")

        return gen.asNondeterministic()

    def generate(self, prompt: Column, model: Column | None = None) -> Column:
        return self._udf()(prompt, model if model is not None else F.lit(None).cast("string"))


class EchoChatClient:
    """Dry-run chat client: answers ``"<model>: "`` plus the SHA-256 of the
    whole prompt. Deterministic; lets the batched call path run without a
    network model."""

    def complete(self, system, user, model=None, **kw):
        return f"{model}: {hashlib.sha256(user.encode('utf-8')).hexdigest()}"
