"""User lookup with a default record for unknown ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's -------------------------
DEFAULT_NAME_PREFIX = "Customer_"
DEFAULT_NAME_ID_CHARS = 5
DEFAULT_COUNTRY = "US"
DEFAULT_TYPES = ["normal"]
# --------------------------------------------------------------------------


def user_lookup(messages: DataFrame, pool: DataFrame, key: str = "customer_id") -> DataFrame:
    """Left-join the user pool on ``key``; first pool row per id wins; ids
    missing from the pool get the default record.

    The pool is a dimension that grows with the customer base, so no
    broadcast is forced: the planner broadcasts it only below its size
    threshold and otherwise shuffles both sides on the key.
    """
    # First pool row per id wins, in scan order (file order for a JSONL pool).
    fields = F.struct(F.col("name").alias("_name"), F.col("country").alias("_country"),
                      F.col("sentiment_types").alias("_types"), F.col("is_karen").alias("_karen"))
    p = (pool.withColumn("_pos", F.monotonically_increasing_id())
         .groupBy(key).agg(F.min_by(fields, F.col("_pos")).alias("_u"))
         .select(key, "_u.*"))
    j = messages.join(p, key, "left")
    default_types = F.array(*[F.lit(t) for t in DEFAULT_TYPES])
    return j.select(
        *[c for c in messages.columns],
        F.coalesce("_name", F.concat(F.lit(DEFAULT_NAME_PREFIX),
                                     F.right(F.col(key), F.lit(DEFAULT_NAME_ID_CHARS)))).alias("name"),
        F.coalesce("_country", F.lit(DEFAULT_COUNTRY)).alias("country"),
        F.coalesce("_types", default_types).alias("sentiment_types"),
        F.coalesce("_karen", F.lit(False)).alias("is_karen"),
    )
