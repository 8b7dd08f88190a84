"""J1 — the sentiment job: filter blank, score, categorise, enrich.

The same transform runs on a batch or a streaming DataFrame of customer
messages; it is stateless and introduces no shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodwire.functions import text as tx
from moodwire.functions.scoring import LexiconScorer, Scorer

# Column order of the scored-message table.
SENTIMENT_COLUMNS = [
    "message_id", "customer_id", "customer_name", "message_timestamp", "message_text",
    "ip_country", "sentiment_score", "sentiment_category", "model_used",
    "processing_timestamp", "source_partition", "source_offset",
]


def filter_non_blank(df: DataFrame, col: str = "message_text") -> DataFrame:
    return df.filter(tx.non_blank(col))


def processing_time(at: dt.datetime | None = None) -> Column:
    """Processing timestamp (ms precision, zone-less); fixed when ``at`` is given."""
    if at is not None:
        return F.lit(at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return F.date_trunc("millisecond", F.current_timestamp()).cast("timestamp_ntz")


def score_messages(messages: DataFrame, scorer: Scorer | None = None,
                   processed_at: dt.datetime | None = None) -> DataFrame:
    """customer_messages -> message_sentiments (12 columns, fixed order)."""
    scorer = scorer or LexiconScorer()
    enriched = filter_non_blank(messages).select(
        "message_id", "customer_id", "customer_name", "message_timestamp", "message_text",
        F.col("metadata.ip_country").alias("ip_country"),
        "kafka_partition", "kafka_offset",
        scorer.score(F.col("message_text")).alias("sentiment_score"),
    )
    return enriched.select(
        "message_id", "customer_id", "customer_name", "message_timestamp", "message_text",
        "ip_country", "sentiment_score",
        tx.category(F.col("sentiment_score")).alias("sentiment_category"),
        F.lit(scorer.model_name).alias("model_used"),
        processing_time(processed_at).alias("processing_timestamp"),
        F.col("kafka_partition").alias("source_partition"),
        F.col("kafka_offset").alias("source_offset"),
    )


def to_serving(sentiments: DataFrame) -> DataFrame:
    """Serving-table form: processing_timestamp as ISO text, plus a date column
    for partition pruning by day."""
    return sentiments.withColumn(
        "processing_timestamp",
        F.date_format("processing_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSS"),
    ).withColumn("message_date", F.to_date(tx.epoch_ms_to_utc(F.col("message_timestamp"))))
