"""SparkSession construction and session-level helpers."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so epoch-ms <-> timestamp conversions and
# hour extraction agree with the SQL oracle; AQE for runtime coalescing and
# skew-join splitting; RocksDB so keyed streaming state spills to disk.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "moodwire",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Return a session configured for moodwire jobs.

    ``master`` defaults to ``local[$BENCH_CPUS or *]`` only when no master is
    configured by the environment (spark-submit sets one on a cluster).
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and "SPARK_MASTER" not in os.environ and "spark.master" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        master = f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def keyed_state(spark: SparkSession) -> None:
    """Keyed stream processors keep several state variables, which the session's default
    state store may not hold: choose RocksDB where a stream is built, in any session."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in (spark.conf.get(key, "") or ""):
        spark.conf.set(key, BASE_CONF[key])


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, or None if unset.

    Lineage is cut only into this folder; jobs never invent a machine-local
    location on their own.
    """
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        spark.sparkContext.setCheckpointDir(d)
        return spark.sparkContext.getCheckpointDir()
    return None


def materialize(df):
    """Cut lineage with a reliable checkpoint in the session's checkpoint dir.

    On a cluster the dir must be named (``spark.checkpoint.dir``); only a
    local-mode session without one gets a fresh scratch folder.
    """
    spark = df.sparkSession
    if checkpoint_dir(spark) is None:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this job")
        import tempfile
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="moodwire-ckpt-", dir="/tmp"))
    return df.checkpoint(eager=True)

