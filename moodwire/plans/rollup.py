"""Rollups that merge: serving metrics per time bucket and group, stored in a form from which any coarser one follows.

Counts, minima and maxima merge as they are. Sums are kept as decimals of nine places, so they are exact, the same for any
partitioning, and averages derived from them are reproducible to the bit. Distinct customers are kept as HLL sketches, which
merge by union; a table of plain distinct counts could not be merged at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sketch size is 2^LG_K registers; the relative standard error is about 1.04 / sqrt(2^LG_K), three of them are the stated bound.
LG_K = 12
ERROR_BOUND = 3 * 1.04 / (1 << LG_K) ** 0.5
SUM_TYPE = "decimal(38,9)"


def exact_sum(value: Column) -> Column:
    """Sum of doubles rounded to nine decimals, independent of the order of additions."""
    return F.sum(value.cast("decimal(28,9)")).cast(SUM_TYPE)


def exact_avg(total: Column, n: Column) -> Column:
    return F.try_divide(total.cast("double"), n.cast("double"))


def sentiment_rollup(df: DataFrame, grain_ms: int, by: Sequence[str] = ("model_used",), ts: str = "message_timestamp") -> DataFrame:
    """One row per bucket of ``grain_ms`` and ``by``: msgs, scored, score_sum, score_min, score_max, very_negative, customers (sketch)."""
    bucket = (F.floor(F.col(ts) / F.lit(grain_ms)) * grain_ms).cast("long").alias("bucket_ms")
    return df.groupBy(bucket, *by).agg(
        F.count(F.lit(1)).alias("msgs"), F.count("sentiment_score").alias("scored"), exact_sum(F.col("sentiment_score")).alias("score_sum"),
        F.min("sentiment_score").alias("score_min"), F.max("sentiment_score").alias("score_max"),
        F.count_if(F.col("sentiment_category") == "F - Very Negative").alias("very_negative"),
        F.hll_sketch_agg("customer_id", F.lit(LG_K)).alias("customers"))


def merge_rollup(rollup: DataFrame, grain_ms: int, by: Sequence[str] = ("model_used",)) -> DataFrame:
    """The rollup of a coarser grain (a multiple of the stored one) or of fewer groups, from stored rows alone."""
    bucket = (F.floor(F.col("bucket_ms") / F.lit(grain_ms)) * grain_ms).cast("long").alias("bucket_ms")
    return rollup.groupBy(bucket, *by).agg(
        F.sum("msgs").alias("msgs"), F.sum("scored").alias("scored"), F.sum("score_sum").cast(SUM_TYPE).alias("score_sum"),
        F.min("score_min").alias("score_min"), F.max("score_max").alias("score_max"), F.sum("very_negative").alias("very_negative"),
        F.hll_union_agg("customers").alias("customers"))


def rollup_metrics(rollup: DataFrame, by: Sequence[str] = ("model_used",)) -> DataFrame:
    """Served metrics of a rollup: averages from exact sums, customers as the sketch's estimate."""
    return rollup.select("bucket_ms", *by, "msgs", exact_avg(F.col("score_sum"), F.col("scored")).alias("avg_sentiment"),
                         F.col("score_min").alias("min_sentiment"), F.col("score_max").alias("max_sentiment"), "very_negative",
                         F.hll_sketch_estimate("customers").alias("unique_customers"))
