"""Map the driver's tables onto the message data model.

The driver's tables hold no chat, so ``events`` becomes the message stream:

* message_id        = event_id as string
* customer_id       = ``'cust_' || lpad(user_id, 5, '0')``
* customer_name     = ``customer.c_name`` (user_id = c_custkey)
* message_timestamp = epoch milliseconds of ``ts`` (microseconds div 1000)
* message_text      = ``event_type || ' ' || props``
* metadata          = (``'sess_' || user_id``, NULL, ``nation.n_name``)
* kafka_partition   = event_id % 4 ; kafka_offset = event_id div 4

The same definitions are written as SQL in :data:`MESSAGES_SQL` so the DuckDB
oracle sees identical input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwire.functions.text import EPOCH_NTZ
from moodwire.operators.joins import broadcast_if_bounded

TOPIC_PARTITIONS = 4
# Bound checked before broadcasting the nation dimension (25 rows by schema).
NATION_MAX_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer messages derived from events ⋈ customer ⋈ nation.

    ``nation`` has 25 rows at every scale (fixed by the schema); it is
    broadcast once a bounded count confirms that. ``customer`` grows with the
    scale factor, so the planner picks the strategy from its size statistics
    (broadcast under the threshold, a shuffle join with AQE skew splitting
    above it).
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cust = cu.join(broadcast_if_bounded(na, NATION_MAX_ROWS), cu.c_nationkey == na.n_nationkey, "left")
    j = ev.join(cust, ev.user_id == cust.c_custkey, "left")
    return j.select(
        F.col("event_id").cast("string").alias("message_id"),
        F.concat(F.lit("cust_"), F.lpad(F.col("user_id").cast("string"), 5, "0")).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.expr(f"timestampdiff(MICROSECOND, {EPOCH_NTZ}, ts) div 1000").alias("message_timestamp"),
        F.concat_ws(" ", F.col("event_type"), F.col("props")).alias("message_text"),
        F.struct(
            F.concat(F.lit("sess_"), F.col("user_id").cast("string")).alias("session_id"),
            F.lit(None).cast("string").alias("user_agent"),
            F.col("n_name").alias("ip_country"),
        ).alias("metadata"),
        F.col("ts").alias("kafka_timestamp"),
        (F.col("event_id") % TOPIC_PARTITIONS).cast("int").alias("kafka_partition"),
        F.expr(f"event_id div {TOPIC_PARTITIONS}").alias("kafka_offset"),
    )


# The same mapping for the SQL oracle (DuckDB dialect; tables are views).
MESSAGES_SQL = """
SELECT CAST(e.event_id AS VARCHAR) AS message_id,
       'cust_' || lpad(CAST(e.user_id AS VARCHAR), 5, '0') AS customer_id,
       c.c_name AS customer_name,
       epoch_us(e.ts) // 1000 AS message_timestamp,
       e.event_type || ' ' || e.props AS message_text,
       n.n_name AS ip_country,
       CAST(e.event_id % 4 AS INTEGER) AS kafka_partition,
       e.event_id // 4 AS kafka_offset
FROM events e
LEFT JOIN customer c ON e.user_id = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""
