"""Sinks: JSONL files, topic records, serving tables (batch and stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodwire.functions.text import epoch_ms_to_utc
from moodwire.sources.codec import JSON_WRITE_OPTS

# Day column used to partition serving tables (prunes by date on read).
DATE_COL = "event_date"


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line, UTF-8, NULL fields kept as null keys."""
    df.write.mode(mode).options(**JSON_WRITE_OPTS).json(path)


def publish_keyed(df: DataFrame, options: dict) -> None:
    """Batch publish (key=message_id, value=JSON) to a topic; ``options`` from
    :func:`moodwire.streaming.jobs.kafka_sink_options` (acks/compression go
    through as ``kafka.*``)."""
    from moodwire.plans.dataprep import keyed_records
    keyed_records(df).write.format("kafka").options(**options).save()


def with_date(df: DataFrame, ts_ms_col: str) -> DataFrame:
    return df.withColumn(DATE_COL, F.to_date(epoch_ms_to_utc(F.col(ts_ms_col))))


def write_serving(df: DataFrame, path: str, ts_ms_col: str, mode: str = "append") -> None:
    """Append to a date-partitioned Parquet serving table."""
    with_date(df, ts_ms_col).write.mode(mode).partitionBy(DATE_COL).parquet(path)


def stream_serving(df: DataFrame, path: str, ts_ms_col: str, checkpoint: str, name: str,
                   trigger: str | None = "10 seconds"):
    """Continuous ingestion into a serving table: exactly-once file sink.
    ``trigger=None`` drains what is available and stops (backfills, tests)."""
    w = (with_date(df, ts_ms_col).writeStream.format("parquet").outputMode("append")
         .partitionBy(DATE_COL).option("checkpointLocation", checkpoint).queryName(name))
    w = w.trigger(processingTime=trigger) if trigger else w.trigger(availableNow=True)
    return w.start(path)


def recreate_table(spark: SparkSession, name: str, path: str, recreate: bool = False, schema: T.StructType | None = None) -> None:
    """Register a serving table over ``path``; ``recreate`` drops it first.
    An existing table is not an error. With a declared ``schema`` (the table is
    then partitioned by day) nothing is read from files, so it can be
    registered and queried before any data lands."""
    if recreate:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    if schema is None:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    else:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}, {DATE_COL} DATE) USING parquet PARTITIONED BY ({DATE_COL}) LOCATION '{path}'")
    # Over a stream's sink, whose log names the files and their days, Spark keeps a table without catalog partitions.
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {name}")  # register existing day partitions
