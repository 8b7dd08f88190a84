"""Start the pipeline's streaming jobs by topic name.

:class:`Topics` says where topics live: a Kafka broker, or (no broker) one
folder of JSON-line files per topic. Each job is one Structured Streaming
query with its own checkpoint folder:

* J1 ``customer_messages -> message_sentiments``: stateless scoring, one
  query per scorer; several scorers share the output topic (``model_used``).
* J2 ``message_sentiments -> karen_rebuttals``: keyed row-pattern state.
* J3 both topics into date-partitioned serving tables, from the earliest
  offset; :func:`register_serving_tables` puts them in the catalog.

Kafka jobs start at the latest offset (J1, J2) or the earliest (J3). A folder
topic has no offsets: a job reads every file present at its first start, and
afterwards only new files (tracked in its checkpoint).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from moodwire import schemas
from moodwire.functions.generation import Generator
from moodwire.functions.scoring import LexiconScorer, Scorer
from moodwire.plans.sentiment import to_serving
from moodwire.sources.sinks import recreate_table, stream_serving
from moodwire.streaming import jobs

# --- fixed values that must equal the reference's -------------------------
SERVING_TABLES = {jobs.TOPIC_SENTIMENTS: "sentiments_rt", jobs.TOPIC_RESPONSES: "karen_rebuttals_rt"}
SERVING_TIME_COLUMNS = {jobs.TOPIC_SENTIMENTS: "message_timestamp", jobs.TOPIC_RESPONSES: "generated_timestamp"}
# --------------------------------------------------------------------------
SERVING_SCHEMAS = {jobs.TOPIC_SENTIMENTS: schemas.SENTIMENTS_SERVING, jobs.TOPIC_RESPONSES: schemas.ESCALATION_RESPONSES}


@dataclass(frozen=True)
class Topics:
    """Where topics live: ``Topics(bootstrap="host:9092")`` or ``Topics(root=folder)``."""

    bootstrap: str | None = None
    root: str | None = None
    #: Most records (Kafka) or files (folder topics) of one micro-batch; a backlog is worked off in several.
    max_per_batch: int | None = None

    def __post_init__(self):
        if (self.bootstrap is None) == (self.root is None):
            raise ValueError("give exactly one of bootstrap (Kafka) or root (folder topics)")

    def source(self, topic: str, starting: str = "latest"):
        if self.bootstrap:
            return "kafka", None, jobs.kafka_source_options(self.bootstrap, topic, starting=starting,
                                                            max_offsets_per_trigger=self.max_per_batch)
        paced = {} if self.max_per_batch is None else {"maxFilesPerTrigger": str(self.max_per_batch)}
        return "text", f"{self.root.rstrip('/')}/{topic}", paced

    def sink(self, topic: str):
        if self.bootstrap:
            return "kafka", None, jobs.kafka_sink_options(self.bootstrap, topic)
        return "text", f"{self.root.rstrip('/')}/{topic}", {}


def start_sentiment_job(spark: SparkSession, topics: Topics, checkpoint: str, scorer: Scorer | None = None,
                        trigger: str | None = jobs.CHECKPOINT_TRIGGER, sink_partitions: int | None = None):
    """J1 for one scorer (``sink_partitions``: see :func:`jobs.sentiment_stream`)."""
    scorer = scorer or LexiconScorer()
    fmt, path, opts = topics.source(jobs.TOPIC_MESSAGES)
    scored = jobs.sentiment_stream(jobs.read_message_stream(spark, fmt, path, opts), scorer, sink_partitions)
    fmt, path, opts = topics.sink(jobs.TOPIC_SENTIMENTS)
    return jobs.start(scored, fmt, checkpoint, f"sentiment-{scorer.model_name}", path=path, options=opts,
                      trigger=trigger, json_value=True)


def start_escalation_job(spark: SparkSession, topics: Topics, checkpoint: str,
                         generator: Generator | None = None, model_filter: str | None = None,
                         trigger: str | None = jobs.CHECKPOINT_TRIGGER, repeat_ttl: str | None = jobs.REPEAT_TTL):
    """J2: escalations per customer, prompt, generated response.

    Records that an at-least-once topic repeats are removed for ``repeat_ttl``
    after the first one (None: not at all); late rows are kept."""
    fmt, path, opts = topics.source(jobs.TOPIC_SENTIMENTS)
    scored = jobs.read_sentiment_stream(spark, fmt, path, opts)
    if repeat_ttl is not None:
        scored = jobs.dedup_stream(scored, ttl=repeat_ttl)
    responses = jobs.escalation_stream(scored, generator, model_filter=model_filter)
    fmt, path, opts = topics.sink(jobs.TOPIC_RESPONSES)
    return jobs.start(responses, fmt, checkpoint, "escalation", path=path, options=opts,
                      trigger=trigger, json_value=True)


def start_serving_ingest(spark: SparkSession, topics: Topics, table_root: str, checkpoint_root: str,
                         trigger: str | None = jobs.CHECKPOINT_TRIGGER, repeat_ttl: str | None = jobs.REPEAT_TTL) -> list:
    """J3: both result topics into their serving tables (exactly-once file
    sinks). ``trigger=None`` drains what is there and stops. ``repeat_ttl``:
    see :func:`start_escalation_job`; it concerns the scored messages."""
    readers = {jobs.TOPIC_SENTIMENTS: jobs.read_sentiment_stream, jobs.TOPIC_RESPONSES: jobs.read_response_stream}
    started = []
    for topic, table in SERVING_TABLES.items():
        fmt, path, opts = topics.source(topic, starting="earliest")
        rows = readers[topic](spark, fmt, path, opts)
        if topic == jobs.TOPIC_SENTIMENTS:
            if repeat_ttl is not None:
                rows = jobs.dedup_stream(rows, ttl=repeat_ttl)
            rows = to_serving(rows).drop("message_date")
        started.append(stream_serving(rows, f"{table_root.rstrip('/')}/{table}", SERVING_TIME_COLUMNS[topic],
                                      f"{checkpoint_root.rstrip('/')}/{table}", f"ingest-{table}", trigger))
    return started


def register_serving_tables(spark: SparkSession, table_root: str, recreate: bool = False) -> None:
    """Catalog entries for the serving tables over their folders, with their declared columns."""
    for topic, table in SERVING_TABLES.items():
        recreate_table(spark, table, f"{table_root.rstrip('/')}/{table}", recreate, SERVING_SCHEMAS[topic])
