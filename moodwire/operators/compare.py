"""Several scorers on one table: union by model and pairwise comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_models(frames: list[DataFrame]) -> DataFrame:
    """Rows of several scorers in one table, told apart by ``model_used``."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def compare_models(a: DataFrame, b: DataFrame, key: str = "message_id", digits: int | None = None) -> DataFrame:
    """Per category of scorer ``a``: rows, category agreements with ``b``, mean
    absolute score difference. An equi-join on the message key; both sides
    are projected to three columns before the shuffle. A message repeated by
    an at-least-once sink counts once per side, so the join never pairs up
    copies; of repeats that differ the one with the lowest partition and offset
    counts (then the lowest score). The repeat removal is partially aggregated
    and its hash partitioning on the key is the one the join uses."""
    def once(df: DataFrame, side: str) -> DataFrame:
        order = [c for c in ("source_partition", "source_offset") if c in df.columns]
        kept = F.min(F.struct(*order, F.col("sentiment_score").alias("score"), F.col("sentiment_category").alias("category")))
        return df.groupBy(key).agg(kept.alias("k")).select(
            key, F.col("k.category").alias(f"category_{side}"), F.col("k.score").alias(f"score_{side}"))

    left, right = once(a, "a"), once(b, "b")
    j = left.join(right, key)
    diff = F.avg(F.abs(F.col("score_a") - F.col("score_b")))
    if digits is not None:
        diff = F.round(diff, digits)
    return j.groupBy("category_a").agg(
        F.count(F.lit(1)).alias("msgs"),
        F.count_if(F.col("category_a") == F.col("category_b")).alias("agree"),
        diff.alias("mean_abs_diff"))
