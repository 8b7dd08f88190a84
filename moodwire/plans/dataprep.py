"""J0 — preparing message data as Spark jobs: expand a user pool into
messages, pick templates, scale a set to an exact size, re-stamp and replay.

Randomness is a hash of (row identity, seed), not ``rand()``: a recomputed
partition after an executor loss draws the same values, so ids and choices
stay stable and exactly-once sinks stay exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodwire.sources.codec import JSON_WRITE_OPTS
from moodwire.operators.joins import broadcast_if_bounded
from moodwire.session import materialize

# Row bounds under which a lookup side is broadcast (checked before use).
TEMPLATE_BROADCAST_ROWS = 100_000

# --- fixed values that must equal the reference's -------------------------
KAREN_MESSAGES = (30, 40)      # messages per escalation-prone user (inclusive)
REGULAR_MESSAGES = (5, 12)     # messages per other user (inclusive)
USER_AGENTS = [
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/537.36",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 15_0 like Mac OS X) AppleWebKit/605.1.15",
]
# --------------------------------------------------------------------------


def draw(n: Column, seed: int, *parts: Column) -> Column:
    """Deterministic uniform integer in [0, n) from the row's ``parts``."""
    return F.pmod(F.xxhash64(F.lit(seed), *parts), n.cast("long"))


def hash_uuid(*parts: Column) -> Column:
    """UUID-formatted id derived from ``parts`` (stable across recomputation)."""
    h = F.sha2(F.concat_ws("\u0001", *[p.cast("string") for p in parts]), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def expand_users(pool: DataFrame, seed: int = 42) -> DataFrame:
    """One row per message to generate: (customer fields, seq). Each user gets
    a count drawn in the escalation-prone or regular range."""
    lo_k, hi_k = KAREN_MESSAGES
    lo_r, hi_r = REGULAR_MESSAGES
    karen = F.coalesce(F.col("is_karen"), F.lit(False))
    n = F.when(karen, F.lit(lo_k) + draw(F.lit(hi_k - lo_k + 1), seed, F.col("customer_id")))
    n = n.otherwise(F.lit(lo_r) + draw(F.lit(hi_r - lo_r + 1), seed, F.col("customer_id")))
    return pool.withColumn("n_messages", n.cast("int")).select(
        "*", F.explode(F.sequence(F.lit(1), F.col("n_messages"))).alias("seq"))


def index_within(df: DataFrame, group: str, index_col: str = "idx") -> DataFrame:
    """Dense 0-based index per ``group`` without a per-group window: rows are
    numbered inside each (group, input partition) (bounded), and partition
    offsets come from a small table of per-(group, partition) counts."""
    t = materialize(df.withColumn("_gid", F.monotonically_increasing_id())
                    .withColumn("_pid", F.spark_partition_id()))
    counts = t.groupBy(group, "_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.partitionBy(group).orderBy("_pid")
                                            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    local = F.row_number().over(Window.partitionBy(group, "_pid").orderBy("_gid")) - 1
    counted = counts.groupBy(group).agg(F.sum("_n").alias("group_size"))
    return (t.withColumn("_local", local).join(offsets.select(group, "_pid", "_off"), [group, "_pid"])
            .join(counted, group)
            .withColumn(index_col, (F.col("_off") + F.col("_local")).cast("long"))
            .drop("_gid", "_pid", "_local", "_off"))


def dense_index(df: DataFrame, index_col: str = "idx") -> DataFrame:
    """Dense 0-based index over all rows: a row's place in its partition plus
    the rows of the partitions before it (one count a partition). No shuffle
    on a constant key."""
    t = materialize(df.withColumn("_gid", F.monotonically_increasing_id()))
    t = t.withColumn("_pid", F.shiftright("_gid", 33))
    counts = t.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_pid", F.coalesce(before, F.lit(0)).alias("_off"))
    place = F.col("_gid").bitwiseAND(F.lit((1 << 33) - 1))
    return (t.join(offsets, "_pid").withColumn(index_col, (F.col("_off") + place).cast("long"))
            .drop("_gid", "_pid", "_off"))


def pick_templates(rows: DataFrame, templates: DataFrame, seed: int = 42) -> DataFrame:
    """For each row: a random type from its ``sentiment_types``, then a random
    template of that type. A type with no template fails the job."""
    types = F.col("sentiment_types")
    rid = F.concat_ws(":", F.col("customer_id"), F.col("seq").cast("string"))
    chosen = rows.withColumn("type", F.element_at(types, (draw(F.size(types), seed, rid, F.lit("t")) + 1).cast("int")))
    idx = index_within(templates.select("type", "template"), "type")
    # Both lookups are keyed by template type, a handful of hot values on the
    # generated side: broadcast them when a bounded count confirms they are
    # small, else the planner shuffles (AQE splits skewed partitions).
    sizes = broadcast_if_bounded(idx.select("type", "group_size").distinct(), TEMPLATE_BROADCAST_ROWS)
    lookup = broadcast_if_bounded(idx.select("type", "idx", "template"), TEMPLATE_BROADCAST_ROWS)
    with_size = chosen.join(sizes, "type", "left")
    checked = with_size.withColumn(
        "group_size",
        F.when(F.col("group_size").isNull(),
               F.raise_error(F.concat(F.lit("No template found for sentiment type: "),
                                      F.coalesce(F.col("type"), F.lit("NULL")))))
        .otherwise(F.col("group_size")))
    picked = checked.withColumn("idx", draw(F.col("group_size"), seed, rid, F.lit("m")))
    return picked.join(lookup, ["type", "idx"]).drop("idx", "group_size")


def build_messages(rows: DataFrame, seed: int = 42, at_ms: Column | None = None) -> DataFrame:
    """Assemble customer messages (nested metadata) from picked rows."""
    rid = F.concat_ws(":", F.col("customer_id"), F.col("seq").cast("string"), F.lit(str(seed)))
    agents = F.array(*[F.lit(a) for a in USER_AGENTS])
    ts = at_ms if at_ms is not None else F.unix_millis(F.current_timestamp())
    return rows.select(
        hash_uuid(rid, F.lit("message")).alias("message_id"),
        "customer_id",
        F.col("name").alias("customer_name"),
        ts.cast("long").alias("message_timestamp"),
        F.col("template").alias("message_text"),
        F.struct(
            F.concat(F.lit("sess_"), F.substring(F.sha2(F.concat(rid, F.lit("session")), 256), 1, 8)).alias("session_id"),
            F.element_at(agents, (draw(F.lit(len(USER_AGENTS)), seed, rid, F.lit("ua")) + 1).cast("int")).alias("user_agent"),
            F.col("country").alias("ip_country"),
        ).alias("metadata"),
    )


def generate_messages(pool: DataFrame, templates: DataFrame, seed: int = 42, at_ms: Column | None = None) -> DataFrame:
    return build_messages(pick_templates(expand_users(pool, seed), templates, seed), seed, at_ms)


def upsample(messages: DataFrame, target: int, seed: int = 42) -> DataFrame:
    """Scale to exactly ``target`` rows when larger than the input: add
    ``target - N`` copies drawn with replacement, each with a new message_id
    and session_id. At or below N the input is returned unchanged."""
    n = messages.count()
    if target <= n or n == 0:
        return messages
    extra = target - n
    idx = dense_index(messages, "_row")
    picks = (messages.sparkSession.range(extra).withColumnRenamed("id", "_copy")
             .withColumn("_row", draw(F.lit(n), seed, F.col("_copy"))))
    # Draws spread evenly over the rows, so a shuffle join is balanced; a set
    # that is small in bytes the planner broadcasts by itself.
    dup = picks.join(idx, "_row")
    rid = F.concat_ws(":", F.lit(str(seed)), F.col("_copy").cast("string"))
    dup = dup.withColumn("message_id", hash_uuid(rid, F.lit("copy"))).withColumn(
        "metadata", F.struct(  # absent metadata still gets a session
            F.concat(F.lit("sess_"), F.substring(F.sha2(F.concat(rid, F.lit("s")), 256), 1, 8)).alias("session_id"),
            *(F.col(f"metadata.{f.name}").alias(f.name) for f in messages.schema["metadata"].dataType.fields if f.name != "session_id")))
    return messages.unionByName(dup.select(*messages.columns))


def restamp(messages: DataFrame, at_ms: Column | None = None) -> DataFrame:
    """Replace ``message_timestamp`` by the replay time in epoch ms."""
    ts = at_ms if at_ms is not None else F.unix_millis(F.current_timestamp())
    return messages.withColumn("message_timestamp", ts.cast("long"))


def shuffle_order(messages: DataFrame, seed: int = 42) -> DataFrame:
    """A seeded random permutation (range-partitioned global sort on a hash)."""
    return messages.orderBy(F.xxhash64(F.lit(seed), F.col("message_id")), "message_id")


def replay(messages: DataFrame, loops: int = 1, at_ms: Column | None = None) -> DataFrame:
    """The set re-stamped, repeated ``loops`` times (an exploded loop number,
    not a cross join)."""
    looped = messages.withColumn("_loop", F.explode(F.sequence(F.lit(0), F.lit(loops - 1))))
    return restamp(looped, at_ms).drop("_loop")


def keyed_records(messages: DataFrame) -> DataFrame:
    """(key, value) pairs for a topic: key = message_id, value = UTF-8 JSON
    (absent values stay as null keys)."""
    cols = [c for c in messages.columns if c != "key"]
    return messages.select(F.col("message_id").alias("key"), F.to_json(F.struct(*cols), JSON_WRITE_OPTS).alias("value"))
