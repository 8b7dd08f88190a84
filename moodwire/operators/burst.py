"""Burst rule: k very negative messages of one customer within a time window.

A row fires when its customer has ``>= k`` rows of the category with a
timestamp in ``[t - window, t]`` (the SQL frame ``RANGE BETWEEN window
PRECEDING AND CURRENT ROW``, peers included).

No task groups a customer. The count is a rank
difference, ``#rows <= t`` minus ``#rows < t - window``. Each row becomes a
data entry plus two probes (one at ``t - window`` sorting before equal
timestamps, one at ``t`` sorting after them). A global range sort on
(customer, time) spreads even a customer holding a third of all rows over
many partitions; one vectorised pass counts data entries before each probe
inside its partition, and a small table of per-(customer, partition) totals
turns those into global counts. The pass output is checkpointed once, so
totals and probes come from the same partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodwire.session import materialize

VERY_NEGATIVE = "F - Very Negative"
OUTPUT = ["customer_name", "message_id", "message_timestamp", "burst_count"]

_DATA, _LOW, _HIGH, _TOTAL = 1, 0, 2, -1
_NO_KEY = object()


def burst_rule(sentiments: DataFrame, k: int = 5, window_ms: int = 5 * 60_000,
               key: str = "customer_id", category: str = VERY_NEGATIVE, partitions: int | None = None) -> DataFrame:
    """Rows (key, customer_name, message_id, message_timestamp, burst_count)
    at which the customer has ``>= k`` rows of ``category`` within the last
    ``window_ms`` (both ends inclusive)."""
    rows = sentiments.filter(F.col("sentiment_category") == category).select(
        key, "customer_name", "message_id", "message_timestamp")
    return _by_ranks(rows, k, window_ms, key, partitions)


# ------------------------------------------------------------------ ranks plan

def _rank_pass():
    """Per range partition, sorted by (key, ts, kind): for every probe, the
    data entries of its key before it in this partition; per key, the data
    entries in this partition (one ``_TOTAL`` row). Vectorised per batch; only
    a running count per key is carried between batches."""
    cols = ["_c", "_pid", "_k", "_before", "_name", "_mid", "_t"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry_c, carry_n, pid = _NO_KEY, 0, None
        for pdf in batches:
            n = len(pdf)
            if n == 0:
                continue
            pid = int(pdf["_pid"].iat[0])
            c = pdf["_c"].to_numpy(dtype=object)
            kind = pdf["_k"].to_numpy()
            is_data = (kind == _DATA).astype(np.int64)
            new = np.ones(n, dtype=bool)
            if n > 1:
                new[1:] = c[1:] != c[:-1]
            cs = np.cumsum(is_data)
            excl = cs - is_data                     # data entries before each row, in the batch
            starts = np.flatnonzero(new)
            seg = np.cumsum(new) - 1
            before = excl - excl[starts][seg]
            ends = np.r_[starts[1:], n] - 1
            seg_total = cs[ends] - excl[starts]
            totals_c, totals_n = [], []
            if carry_c is not _NO_KEY and c[0] == carry_c:
                before[seg == 0] += carry_n
                seg_total[0] += carry_n
            elif carry_c is not _NO_KEY:
                totals_c.append(carry_c)
                totals_n.append(carry_n)
            totals_c.extend(c[starts[:-1]].tolist())
            totals_n.extend(seg_total[:-1].tolist())
            carry_c, carry_n = c[starts[-1]], int(seg_total[-1])
            probe = kind != _DATA
            out = pd.DataFrame({
                "_c": pd.Series(np.r_[c[probe], np.array(totals_c, dtype=object)], dtype="object"),
                "_pid": pid,
                "_k": np.r_[kind[probe], np.full(len(totals_c), _TOTAL)].astype("int32"),
                "_before": np.r_[before[probe], np.array(totals_n, dtype=np.int64)].astype("int64"),
                "_name": pd.Series(list(pdf["_name"].to_numpy(dtype=object)[probe]) + [None] * len(totals_c),
                                   dtype="object"),
                "_mid": pd.Series(list(pdf["_mid"].to_numpy(dtype=object)[probe]) + [None] * len(totals_c),
                                  dtype="object"),
                "_t": pd.Series(list(pdf["_t"].to_numpy(dtype=object)[probe]) + [None] * len(totals_c),
                                dtype="object"),
            })
            if len(out):
                yield out[cols]
        if carry_c is not _NO_KEY:
            yield pd.DataFrame({"_c": pd.Series([carry_c], dtype="object"), "_pid": [pid],
                                "_k": np.array([_TOTAL], dtype="int32"), "_before": [carry_n],
                                "_name": pd.Series([None], dtype="object"),
                                "_mid": pd.Series([None], dtype="object"),
                                "_t": pd.Series([None], dtype="object")})[cols]

    return run


def _by_ranks(rows: DataFrame, k: int, window_ms: int, key: str, partitions: int | None) -> DataFrame:
    spark = rows.sparkSession
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sch = rows.schema
    ts = F.col("message_timestamp").cast("long")

    def entry(kind, at, with_row):
        fields = [F.lit(kind).cast("int").alias("_k"), at.alias("_ts")]
        for src, name, dt in (("customer_name", "_name", sch["customer_name"].dataType),
                              ("message_id", "_mid", sch["message_id"].dataType),
                              ("message_timestamp", "_t", T.LongType())):
            fields.append((F.col(src).cast(dt) if with_row else F.lit(None).cast(dt)).alias(name))
        return F.struct(*fields)

    entries = F.array(entry(_DATA, ts, False), entry(_LOW, ts - F.lit(int(window_ms)), True),
                      entry(_HIGH, ts, True))
    # The range exchange samples its input in a separate job: keep the input
    # so an upstream model scorer runs once.
    src = rows.persist(StorageLevel.MEMORY_AND_DISK)
    exploded = src.select(F.col(key).alias("_c"), F.explode(entries).alias("_e")).select("_c", "_e.*")
    ordered = (exploded.repartitionByRange(partitions, "_c", "_ts", "_k")
               .sortWithinPartitions("_c", "_ts", "_k")
               .withColumn("_pid", F.spark_partition_id()))
    out_schema = T.StructType([
        T.StructField("_c", sch[key].dataType), T.StructField("_pid", T.IntegerType()),
        T.StructField("_k", T.IntegerType()), T.StructField("_before", T.LongType()),
        T.StructField("_name", sch["customer_name"].dataType), T.StructField("_mid", sch["message_id"].dataType),
        T.StructField("_t", T.LongType()),
    ])
    counted = ordered.select("_c", "_pid", "_k", "_name", "_mid", "_t").mapInPandas(
        _rank_pass(), out_schema)
    # Totals and probes must see the same range bounds: materialise once.
    counted = materialize(counted)
    src.unpersist()

    totals = counted.filter(F.col("_k") == _TOTAL).select("_c", "_pid", F.col("_before").alias("_n"))
    earlier = Window.partitionBy("_c").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("_c").alias("_oc"), F.col("_pid").alias("_opid"),
                            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    probes = counted.filter(F.col("_k") != _TOTAL)
    cond = [F.col("_c").eqNullSafe(F.col("_oc")), F.col("_pid") == F.col("_opid")]
    ranked = probes.join(offsets, cond, "left").select(
        "_c", "_k", "_name", "_mid", "_t", (F.coalesce("_off", F.lit(0)) + F.col("_before")).alias("_cum"))
    per_row = ranked.groupBy("_c", "_name", "_mid", "_t").agg(
        F.max(F.when(F.col("_k") == _HIGH, F.col("_cum"))).alias("_le"),
        F.max(F.when(F.col("_k") == _LOW, F.col("_cum"))).alias("_lt"),
        F.count_if(F.col("_k") == _HIGH).alias("_mult"))
    fired = per_row.withColumn("burst_count", F.col("_le") - F.col("_lt")).filter(F.col("burst_count") >= k)
    # Exact duplicate rows share one group; restore their multiplicity.
    return fired.select(
        F.col("_c").alias(key), F.col("_name").alias("customer_name"), F.col("_mid").alias("message_id"),
        F.col("_t").alias("message_timestamp"), "burst_count",
        F.explode(F.sequence(F.lit(1), F.col("_mult").cast("int"))).alias("_dup"),
    ).drop("_dup").withColumn("message_timestamp", F.col("message_timestamp").cast(sch["message_timestamp"].dataType))
