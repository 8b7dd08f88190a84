"""J3 — serving queries: named metrics, ready-made queries and panels.

Metrics are named aggregate ``Column`` factories usable with any grouping (or
none). All queries are plain ``groupBy().agg()`` / ``orderBy().limit()`` plans:
partial aggregation happens map-side, so a hot group costs one partial row
per task before the shuffle, and ``orderBy().limit(n)`` plans as
``TakeOrderedAndProject`` (per-partition top-n, no full sort).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodwire.functions.text import epoch_ms_to_utc

# --- fixed values that must equal the reference's -------------------------
VERY_NEGATIVE_BELOW = -0.5      # karen_count / karen_percentage
POSITIVE_ABOVE = 0.1            # positive_count
NEGATIVE_BELOW = -0.1           # negative_count
EXTREME_TRIGGER_AT_LEAST = 8    # extreme_karen_count
COUNTED_RESPONSE_MODEL = "gpt-4.1-mini"  # gpt4_rebuttals
WORST_CUSTOMERS_LIMIT = 10
RECENT_RESPONSES_LIMIT = 5
TOP_ESCALATORS_LIMIT = 10
# --------------------------------------------------------------------------

HOUR_MS = 3_600_000


def _pct(part: Column, whole: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), whole)


SENTIMENT_METRICS: dict[str, Callable[[], Column]] = {
    "count": lambda: F.count(F.lit(1)),
    "avg_sentiment": lambda: F.avg("sentiment_score"),
    "min_sentiment": lambda: F.min("sentiment_score"),
    "max_sentiment": lambda: F.max("sentiment_score"),
    "karen_count": lambda: F.count_if(F.col("sentiment_score") < VERY_NEGATIVE_BELOW),
    "positive_count": lambda: F.count_if(F.col("sentiment_score") > POSITIVE_ABOVE),
    "negative_count": lambda: F.count_if(F.col("sentiment_score") < NEGATIVE_BELOW),
    "unique_customers": lambda: F.count_distinct("customer_id"),
    "karen_percentage": lambda: _pct(F.count_if(F.col("sentiment_score") < VERY_NEGATIVE_BELOW),
                                     F.count(F.lit(1))),
}


def _rate_per_hour_of_day() -> Column:
    """COUNT / (hour-of-day(max) - hour-of-day(min) + 1), as written in the
    reference: negative or undefined across midnight (then NULL here)."""
    hi = F.hour(epoch_ms_to_utc(F.max("generated_timestamp")))
    lo = F.hour(epoch_ms_to_utc(F.min("generated_timestamp")))
    return F.try_divide(F.count(F.lit(1)).cast("double"), (hi - lo + 1).cast("double"))


def _rate_per_elapsed_hour() -> Column:
    """Corrected rate: COUNT / (whole hours elapsed between min and max + 1)."""
    span = F.floor((F.max("generated_timestamp") - F.min("generated_timestamp")) / F.lit(HOUR_MS)) + 1
    return F.try_divide(F.count(F.lit(1)).cast("double"), span.cast("double"))


def response_metrics(counted_model: str = COUNTED_RESPONSE_MODEL) -> dict[str, Callable[[], Column]]:
    return {
        "rebuttal_count": lambda: F.count(F.lit(1)),
        "avg_karen_score": lambda: F.avg("karen_score_total"),
        "max_karen_score": lambda: F.max("karen_score_total"),
        "min_karen_score": lambda: F.min("karen_score_total"),
        "avg_trigger_count": lambda: F.avg("trigger_message_count"),
        "max_trigger_count": lambda: F.max("trigger_message_count"),
        "unique_karen_customers": lambda: F.count_distinct("customer_id"),
        "gpt4_rebuttals": lambda: F.count_if(F.col("rebuttal_model") == F.lit(counted_model)),
        "extreme_karen_count": lambda: F.count_if(F.col("trigger_message_count") >= EXTREME_TRIGGER_AT_LEAST),
        "rebuttals_per_hour": _rate_per_hour_of_day,
        "rebuttals_per_elapsed_hour": _rate_per_elapsed_hour,
    }


RESPONSE_METRICS = response_metrics()


APPROX_DISTINCT = {"unique_customers": "customer_id", "unique_karen_customers": "customer_id"}


def metrics(df: DataFrame, registry: dict[str, Callable[[], Column]], names=None,
            by: list[str] | None = None, digits: int | None = None,
            approx_distinct: bool = False, rsd: float = 0.01) -> DataFrame:
    """Apply named metrics to ``df``, grouped by ``by`` (or over all rows).

    ``digits`` rounds double-valued metrics (float sums depend on the order in
    which partial aggregates meet, so comparisons use a fixed precision).
    ``approx_distinct`` swaps the distinct counts for HyperLogLog++ sketches
    (mergeable partial states; the form streaming aggregations need).
    """
    names = list(names or registry)
    cols = []
    for n in names:
        if approx_distinct and n in APPROX_DISTINCT:
            c = F.approx_count_distinct(APPROX_DISTINCT[n], rsd)
        else:
            c = registry[n]()
        cols.append(c.alias(n))
    out = df.groupBy(*(by or [])).agg(*cols)
    if digits is not None:
        out = round_doubles(out, digits)
    return out


def round_doubles(df: DataFrame, digits: int) -> DataFrame:
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
        for f in df.schema.fields
    ])


# ---- ready-made queries ------------------------------------------------------

def q_basic_count(sentiments: DataFrame) -> DataFrame:
    return sentiments.agg(F.count(F.lit(1)).alias("total_messages"))


def q_geographic(sentiments: DataFrame, digits: int | None = None) -> DataFrame:
    out = sentiments.groupBy("ip_country").agg(
        F.count(F.lit(1)).alias("msgs"), F.avg("sentiment_score").alias("avg_sentiment"))
    return round_doubles(out, digits) if digits is not None else out


def q_worst_customers(sentiments: DataFrame, n: int = WORST_CUSTOMERS_LIMIT,
                      digits: int | None = None) -> DataFrame:
    """Lowest average score per (name, id); ties broken by id then name."""
    avg = F.avg("sentiment_score")
    if digits is not None:
        avg = F.round(avg, digits)
    return (sentiments.groupBy("customer_name", "customer_id")
            .agg(avg.alias("avg_sentiment"), F.count(F.lit(1)).alias("msgs"))
            .orderBy(F.col("avg_sentiment").asc(), F.col("customer_id").asc(),
                     F.col("customer_name").asc_nulls_first())
            .limit(n))


def q_recent_responses(responses: DataFrame, n: int = RECENT_RESPONSES_LIMIT) -> DataFrame:
    return (responses.select("customer_name", "customer_id", "rebuttal_text", "generated_timestamp")
            .orderBy(F.col("generated_timestamp").desc(), F.col("customer_id").asc(),
                     F.col("customer_name").asc_nulls_first())
            .limit(n))


def q_top_escalators(responses: DataFrame, n: int = TOP_ESCALATORS_LIMIT,
                     digits: int | None = None) -> DataFrame:
    """Grouped by name only, as the reference does (namesakes merge)."""
    avg = F.avg("karen_score_total")
    if digits is not None:
        avg = F.round(avg, digits)
    return (responses.groupBy("customer_name")
            .agg(F.count(F.lit(1)).alias("rebuttal_count"), avg.alias("avg_karen_score"))
            .orderBy(F.col("rebuttal_count").desc(), F.col("customer_name").asc_nulls_first())
            .limit(n))


def q_effectiveness(responses: DataFrame, digits: int | None = None) -> DataFrame:
    out = responses.groupBy("rebuttal_model").agg(
        F.count(F.lit(1)).alias("total_rebuttals"),
        F.avg("trigger_message_count").alias("avg_trigger_count"))
    return round_doubles(out, digits) if digits is not None else out


# ---- dashboard panels (batch form; the streaming form is in moodwire.streaming) --

def bucket_ms(ts_ms: Column, grain_ms: int) -> Column:
    """Start of the fixed-size bucket (epoch ms) holding ``ts_ms``."""
    return ts_ms - F.pmod(ts_ms, F.lit(grain_ms))


def ts_sentiment_trend(sentiments: DataFrame, grain_ms: int = 60_000,
                       digits: int | None = None) -> DataFrame:
    out = (sentiments.groupBy(bucket_ms(F.col("message_timestamp"), grain_ms).alias("bucket_start_ms"))
           .agg(F.avg("sentiment_score").alias("avg_sentiment"), F.count(F.lit(1)).alias("msgs")))
    return round_doubles(out, digits) if digits is not None else out


def ts_category_distribution(sentiments: DataFrame, digits: int | None = None) -> DataFrame:
    """Count and share per category. The share window runs over the grouped
    result (one row per category), never over the raw rows."""
    counts = sentiments.groupBy("sentiment_category").agg(F.count(F.lit(1)).alias("msgs"))
    out = counts.withColumn("share_pct", _pct(F.col("msgs"), F.sum("msgs").over(Window.partitionBy())))
    return round_doubles(out, digits) if digits is not None else out


def ts_message_volume(sentiments: DataFrame, grain_ms: int = 60_000,
                      digits: int | None = None) -> DataFrame:
    out = (sentiments.groupBy(bucket_ms(F.col("message_timestamp"), grain_ms).alias("bucket_start_ms"))
           .agg(F.count(F.lit(1)).alias("msgs"))
           .withColumn("msgs_per_sec", F.col("msgs") / F.lit(grain_ms / 1000.0)))
    return round_doubles(out, digits) if digits is not None else out


def ts_responses(responses: DataFrame, grain_ms: int = HOUR_MS, digits: int | None = None) -> DataFrame:
    out = (responses.groupBy(bucket_ms(F.col("generated_timestamp"), grain_ms).alias("bucket_start_ms"))
           .agg(F.count(F.lit(1)).alias("responses"),
                F.avg("karen_score_total").alias("avg_karen_score"),
                F.sum("trigger_message_count").alias("trigger_messages")))
    return round_doubles(out, digits) if digits is not None else out


def ts_model_comparison(sentiments: DataFrame, digits: int | None = None) -> DataFrame:
    return metrics(sentiments, SENTIMENT_METRICS, by=["model_used"], digits=digits)
