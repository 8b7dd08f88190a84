"""Run a streaming query over a replay of a batch table, and read back its
output as a batch DataFrame.

The table is written as a Parquet file stream in ``slices`` consecutive time
slices, one Spark job per slice, so every file of slice k is older than every
file of slice k+1. Inside a slice, rows are hash-partitioned by the stream's
key, so one key's rows of a slice sit in one file. The file source feeds files
oldest first, hence each key sees its rows in time order across micro-batches,
the arrival order a topic would give. All scratch space lives under the
session's checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodwire.session import checkpoint_dir, keyed_state, materialize


def scratch_path(spark, kind: str = "replay") -> str:
    """A fresh folder under the session's checkpoint folder (shared storage on
    a cluster; never a machine-local temporary folder there)."""
    if checkpoint_dir(spark) is None:
        materialize(spark.range(1))  # sets the local-mode fallback folder
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/moodwire-{kind}-{uuid.uuid4().hex}"


def write_slices(df: DataFrame, path: str, time_col: str, key_cols: list[str], slices: int = 4,
                 partitions: int | None = None) -> None:
    """Write ``df`` as ``slices`` time-ordered batches of Parquet files."""
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Written once, so that what stands above (scans, joins, scoring) runs once and not per slice.
    df.write.parquet(f"{path}-all")
    df = spark.read.schema(df.schema).parquet(f"{path}-all")
    lo, hi = df.agg(F.min(time_col), F.max(time_col)).first()
    if lo is None:
        df.limit(0).write.mode("append").parquet(path)
        return
    width = (hi - lo) // slices + 1
    for k in range(slices):
        part = df.filter((F.col(time_col) >= lo + k * width) & (F.col(time_col) < lo + (k + 1) * width))
        part.repartition(partitions, *key_cols).write.mode("append").parquet(path)


def write_end(df: DataFrame, path: str, time_col: str, key_cols: list[str], wait_ms: int) -> None:
    """A last file with one row of a customer of its own, ``wait_ms`` behind all others: it moves the watermark past them."""
    last = df.agg(F.max(time_col)).first()[0]
    if last is not None:
        end = df.limit(1).withColumns({time_col: F.lit(last + wait_ms).cast(df.schema[time_col].dataType),
                                       **{c: F.lit("end of stream").cast(df.schema[c].dataType) for c in key_cols}})
        end.select(*df.columns).coalesce(1).write.mode("append").parquet(path)


def run_available(stream: DataFrame, name: str, base: str) -> DataFrame:
    """Drain ``stream`` into a Parquet sink (availableNow) and return the sink."""
    out, ckpt = f"{base}/out-{name}", f"{base}/ckpt-{name}"
    q = (stream.writeStream.format("parquet").outputMode("append").queryName(name)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start(out))
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def replay(df: DataFrame, build, name: str, time_col: str = "message_timestamp",
           key_cols: tuple[str, ...] = ("customer_id",), slices: int = 4, arrival: str | None = None, end_ms: int | None = None) -> DataFrame:
    """Replay ``df`` as a file stream, apply ``build(stream_df)``, return the result.

    Rows arrive in order of ``arrival`` (default: ``time_col``). With ``end_ms``, a row of the customer "end of stream"
    comes last, so much later than all others; event-time streams then report everything before it."""
    spark = df.sparkSession
    keyed_state(spark)
    base = scratch_path(spark)
    src = f"{base}/src"
    write_slices(df, src, arrival or time_col, list(key_cols), slices)
    if end_ms is not None:
        write_end(df, src, time_col, list(key_cols), end_ms)
    # About one slice per micro-batch: bounded batches, never a key's whole history at once.
    per_batch = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", str(per_batch)).parquet(src)
    return run_available(build(stream), name, base)
