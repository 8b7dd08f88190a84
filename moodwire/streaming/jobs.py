"""Streaming wiring of the three jobs on the same transforms as batch.

Sources and sinks take a ``format`` + options pair: Kafka on a cluster
(connector jar required), JSON/Parquet file streams elsewhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwire import schemas
from moodwire.functions.generation import RESPONSE_MODEL_DEFAULT, Generator
from moodwire.functions.scoring import Scorer
from moodwire.plans import sentiment
from moodwire.plans.escalation import respond
from moodwire.session import keyed_state
from moodwire.sources import codec
from moodwire.streaming.state import BURST_OUTPUT, MATCH_OUTPUT, BurstProcessor, WithinProcessor, event_time_stream, match_stream

WATERMARK_DELAY = "5 seconds"
CHECKPOINT_TRIGGER = "10 seconds"

# --- fixed values that must equal the reference's -------------------------
TOPIC_MESSAGES = "customer_messages"
TOPIC_SENTIMENTS = "message_sentiments"
TOPIC_RESPONSES = "karen_rebuttals"
CONSUMER_CLIENT = {"request.timeout.ms": 60000, "metadata.max.age.ms": 30000, "connections.max.idle.ms": 300000}
PRODUCER_CLIENT = {"acks": "all", "retries": 3, "batch.size": 16384, "linger.ms": 10, "compression.type": "snappy"}
SENTIMENT_SINK_PARALLELISM = 4
# --------------------------------------------------------------------------


# --------------------------------------------------------------------- sources

def kafka_source_options(bootstrap: str, topic: str, starting: str = "latest",
                         client: dict | None = None, max_offsets_per_trigger: int | None = None) -> dict:
    """Options for ``readStream.format("kafka")``; client settings (default:
    the jobs' consumer timeouts) pass through with the ``kafka.`` prefix.
    Offsets live in the query checkpoint, so no consumer group is needed. Lost
    offsets fail the query (the source's default). ``max_offsets_per_trigger``
    paces a backlog: rows wait for a later micro-batch, none is dropped."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting}
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    for k, v in (CONSUMER_CLIENT if client is None else client).items():
        opts[f"kafka.{k}"] = str(v)
    return opts


def kafka_sink_options(bootstrap: str, topic: str, client: dict | None = None) -> dict:
    """Options for a Kafka sink; ``client=PRODUCER_CLIENT`` gives the keyed
    publisher's delivery settings (all replicas acknowledge, snappy, retries)."""
    opts = {"kafka.bootstrap.servers": bootstrap, "topic": topic}
    for k, v in (client or {}).items():
        opts[f"kafka.{k}"] = str(v)
    return opts


def read_message_stream(spark: SparkSession, fmt: str, path: str | None = None,
                        options: dict | None = None) -> DataFrame:
    """Raw customer messages: tolerant JSON decode plus connector metadata.

    ``fmt="kafka"``: value/timestamp/partition/offset columns of the topic.
    ``fmt="text"``: JSON lines files; partition/offset come from the payload
    fields ``kafka_partition``/``kafka_offset`` when present (else NULL).
    """
    r = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        raw = r.load().select(F.col("value").cast("string").alias("value"),
                              F.col("timestamp").cast("timestamp_ntz").alias("kafka_timestamp"),
                              F.col("partition").alias("kafka_partition"),
                              F.col("offset").alias("kafka_offset"))
        return codec.decode_messages(raw, keep=["kafka_timestamp", "kafka_partition", "kafka_offset"])
    raw = r.load(path)
    meta = F.from_json("value", "kafka_partition int, kafka_offset long")
    with_meta = raw.select("value", meta.alias("_m"))
    out = codec.decode_messages(with_meta, keep=["_m"])
    return out.select(*[c for c in out.columns if c != "_m"],
                      F.lit(None).cast("timestamp_ntz").alias("kafka_timestamp"),
                      F.col("_m.kafka_partition").alias("kafka_partition"),
                      F.col("_m.kafka_offset").alias("kafka_offset"))


def read_sentiment_stream(spark: SparkSession, fmt: str, path: str | None = None,
                          options: dict | None = None) -> DataFrame:
    """Scored messages, strict JSON (a malformed record fails the query)."""
    r = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        raw = r.load().select(F.col("value").cast("string").alias("value"))
    elif fmt == "parquet":
        return r.schema(schemas.MESSAGE_SENTIMENTS).load(path)
    else:
        raw = r.load(path)
    return codec.decode_sentiments(raw, strict=True)


def read_response_stream(spark: SparkSession, fmt: str, path: str | None = None,
                         options: dict | None = None) -> DataFrame:
    """Escalation responses, strict JSON."""
    r = spark.readStream.format(fmt).options(**(options or {}))
    raw = r.load().select(F.col("value").cast("string").alias("value")) if fmt == "kafka" else r.load(path)
    return codec.decode(raw, schemas.ESCALATION_RESPONSES, strict=True)


# ------------------------------------------------------------------------ jobs

def with_event_time(messages: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """``message_ts_ltz`` from epoch ms, with a bounded out-of-orderness watermark."""
    return (messages.withColumn("message_ts_ltz", F.timestamp_millis("message_timestamp"))
            .withWatermark("message_ts_ltz", delay))


def sentiment_stream(messages: DataFrame, scorer: Scorer | None = None,
                     sink_partitions: int | None = None) -> DataFrame:
    """J1 on a stream: stateless, no shuffle. Each input partition writes its
    own rows, so the sink scales with the source; a topic sink spreads
    key-less records over its partitions by itself. ``sink_partitions``
    (e.g. ``SENTIMENT_SINK_PARALLELISM``, the original deployment's 4 writers)
    adds a round-robin spread to exactly that many writers."""
    scored = sentiment.score_messages(messages, scorer)
    return scored.repartition(sink_partitions) if sink_partitions else scored


def escalation_stream(sentiments: DataFrame, generator: Generator | None = None,
                      threshold: float = -5.0, model: str = RESPONSE_MODEL_DEFAULT,
                      model_filter: str | None = None) -> DataFrame:
    """J2 on a stream: one hash shuffle on the customer's bucket into the stateful fold."""
    keyed_state(sentiments.sparkSession)
    if model_filter is not None:
        sentiments = sentiments.filter(F.col("model_used") == model_filter)
    matches = match_stream(sentiments, threshold)
    return respond(matches, generator, model=model, generated_at="now")


def within_stream(sentiments: DataFrame, within_ms: int, threshold: float = -5.0, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Time-bounded matches on a stream, in event-time order; rows are waited for by ``delay``."""
    keyed_state(sentiments.sparkSession)
    return event_time_stream(with_event_time(sentiments, delay), WithinProcessor(within_ms, threshold), MATCH_OUTPUT, "message_ts_ltz")


def burst_stream(sentiments: DataFrame, k: int = 5, window_ms: int = 5 * 60_000,
                 category: str = "F - Very Negative", delay: str = WATERMARK_DELAY) -> DataFrame:
    """The burst rule on a stream, in event-time order; rows are waited for by ``delay``, and a row is reported once the
    watermark has passed it."""
    keyed_state(sentiments.sparkSession)
    rows = with_event_time(sentiments, delay).filter(F.col("sentiment_category") == category)
    return event_time_stream(rows, BurstProcessor(k, window_ms), BURST_OUTPUT, "message_ts_ltz")


def trend_stream(sentiments: DataFrame, grain: str = "1 minute", delay: str = WATERMARK_DELAY) -> DataFrame:
    """Windowed average per event-time bucket; a bucket is emitted once the
    watermark passes its end (append mode)."""
    ev = with_event_time(sentiments, delay)
    return (ev.groupBy(F.window("message_ts_ltz", grain).alias("w"))
            .agg(F.avg("sentiment_score").alias("avg_sentiment"), F.count(F.lit(1)).alias("msgs"))
            .select(F.unix_millis(F.col("w.start")).alias("bucket_start_ms"), "avg_sentiment", "msgs"))


REPEAT_KEY = ("message_id", "model_used")
REPEAT_TTL = "7 days"


def dedup_stream(rows: DataFrame, keys: tuple[str, ...] = REPEAT_KEY, ttl: str = REPEAT_TTL) -> DataFrame:
    """At-least-once sinks can repeat rows: each row once, its repeats dropped for ``ttl`` after it came.

    The watermark is on the time of arrival, which never runs backwards: it frees the keys ``ttl`` after their row came, and
    no row is ever behind it. Rows of any event time pass. The keys are unique per message, so no key is hot."""
    arrived = "_arrived"
    return (rows.withColumn(arrived, F.current_timestamp()).withWatermark(arrived, ttl)
            .dropDuplicatesWithinWatermark(list(keys)).drop(arrived))


def start(df: DataFrame, fmt: str, checkpoint: str, name: str, path: str | None = None,
          options: dict | None = None, trigger: str | None = CHECKPOINT_TRIGGER, json_value: bool = False):
    """Start an append-mode query with a checkpoint; ``json_value`` encodes
    rows as a JSON ``value`` column (topic sinks)."""
    out = codec.encode_json(df) if json_value else df
    w = out.writeStream.format(fmt).outputMode("append").queryName(name).option("checkpointLocation", checkpoint)
    w = w.options(**(options or {}))
    if trigger:
        w = w.trigger(processingTime=trigger)
    return w.start(path) if path else w.start()
