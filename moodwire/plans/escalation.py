"""J2 — the escalation job: match per customer, build prompt, generate reply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodwire.functions import text as tx
from moodwire.functions.generation import RESPONSE_MODEL_DEFAULT, FixedTextGenerator, Generator
from moodwire.operators.escalation import DEFAULT_THRESHOLD, match_escalations

RESPONSE_COLUMNS = [
    "customer_id", "customer_name", "karen_score_total", "rebuttal_text", "rebuttal_model",
    "generated_timestamp", "trigger_message_count", "recent_messages",
]


def generated_now() -> Column:
    """``UNIX_TIMESTAMP() * 1000``: wall clock at second precision, in ms."""
    return F.unix_timestamp() * F.lit(1000)


def respond(matches: DataFrame, generator: Generator | None = None,
            model: str = RESPONSE_MODEL_DEFAULT, generated_at: str = "now") -> DataFrame:
    """Matches -> response rows (8 columns, fixed order).

    ``generated_at="now"`` stamps wall-clock time like the streaming job;
    ``"event"`` uses the closing message's timestamp, so replays over
    history are reproducible.
    """
    generator = generator or FixedTextGenerator()
    prompt = tx.response_prompt(F.col("customer_name"), F.col("karen_score_total"), F.col("recent_messages"))
    ts = generated_now() if generated_at == "now" else F.col("trigger_order").cast("long")
    return matches.select(
        "customer_id", "customer_name", "karen_score_total",
        generator.generate(prompt, F.lit(model)).alias("rebuttal_text"),
        F.lit(model).alias("rebuttal_model"),
        ts.alias("generated_timestamp"),
        "trigger_message_count", "recent_messages",
    )


def escalations(sentiments: DataFrame, threshold: float = DEFAULT_THRESHOLD, model_filter: str | None = None,
                **kw) -> DataFrame:
    """Match escalations over scored messages. ``model_filter`` keeps one
    scorer's rows when several scorers share the input (the reference mixes them)."""
    if model_filter is not None:
        sentiments = sentiments.filter(F.col("model_used") == model_filter)
    return match_escalations(sentiments, threshold=threshold, **kw)
