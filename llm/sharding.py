"""Sharding by global byte-size prefix sums.

Rows are put in order by range partitions, so equal keys and hot ranges spread by their rows. Each partition adds up the
sizes of its rows in order; the partitions' totals, one row each, give every partition the bytes and rows before it. So
each row knows its place in the whole without any task seeing more than its own partition. The whole is cut at
equal byte targets: a row lies in the shard that holds its middle byte, which puts each cut at the row edge nearest to its
target. Shards are contiguous in the order and a cut misses its target by half a row at most; a shard differs from
the target by one row at most.

Order: the id, null ids last, then the text's checksum (so that repeated ids have one order), then the rest of ties as
they come: rows alike in both are interchangeable. A third of all rows may share one id: a hash of the row and its number
break ties for the partitioning only.

Null text: a row of the fixed overhead alone. Empty tables give an empty result; with fewer rows than shards, or rows larger
than a target, some shards stay empty. Very long texts are rows like others. Extra columns stay, whatever their names.
Sizes are non-negative whole numbers; a null size counts as 0.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import read_table, staged
from llm.spelling import crc32_sql

SHARDS = 40
#: Bytes that a row takes beside its text.
OVERHEAD = 16
#: Bytes that one task sorts and numbers, about.
PARTITION_BYTES = 128 << 20
#: Shards whose first rows are sent to all tasks (two numbers each); beyond, they are joined by a shuffle.
FIRSTS = 1 << 18


def text_size(text: Column, overhead: int = OVERHEAD) -> Column:
    return (F.coalesce(F.octet_length(text.cast("string")), F.lit(0)) + F.lit(overhead)).cast("long")


def _running(batches):
    """Number a partition's rows and add up their sizes, both before the row."""
    from pyspark import TaskContext
    part, rows, size = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        n = b.num_rows
        sums = pc.cumulative_sum(b.column("size"))
        before = pc.add(pc.subtract(sums, b.column("size")), pa.scalar(size, pa.int64()))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * n, pa.int32()), pa.array(range(rows, rows + n), pa.int64()), before],
                                         names=[*b.schema.names, "part", "at", "before"])
        rows, size = rows + n, size + (sums[-1].as_py() if n else 0)


def placed(df: DataFrame, shards: int, size: Column, order: list[Column], partitions: int | None = None) -> DataFrame:
    """Rows of ``df`` as ``row`` (a struct of all its columns), with shard (int) and slot (long, gapless from 0 in a shard).

    ``order`` may leave ties; ties are dealt over partitions and shards as they come.
    """
    spark = df.sparkSession
    if partitions is None:
        all_bytes = df.agg(F.sum(size.cast("long"))).first()[0] or 0
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), all_bytes // PARTITION_BYTES)
    keys = [f"k{i}" for i in range(len(order))]
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), F.coalesce(size.cast("long"), F.lit(0)).alias("size"),
                     *(c.alias(k) for c, k in zip(order, keys)), F.monotonically_increasing_id().alias("tie"))
    # Written once: the numbers of a range shuffle hold for this very run of it only.
    ordered = rows.repartitionByRange(partitions, *(F.asc_nulls_last(k) for k in keys), F.xxhash64("tie"))
    ordered = ordered.sortWithinPartitions(*(F.asc_nulls_last(k) for k in keys), F.xxhash64("tie")).drop(*keys, "tie")
    schema = T.StructType([*ordered.schema, *T.StructType.fromDDL("part int, at long, before long")])
    ordered = staged(ordered.mapInArrow(_running, schema), "sharding")

    # One row a partition: what lies before each of them. The driver holds as many numbers as there are partitions.
    totals = sorted(ordered.groupBy("part").agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect())
    offsets, all_bytes, all_rows = [], 0, 0
    for part, s, n in totals:
        offsets.append((part, all_bytes, all_rows))
        all_bytes, all_rows = all_bytes + s, all_rows + n
    offset = spark.createDataFrame(offsets, "part int, bytes long, rows long")
    # floor((start + size / 2) * shards / all), in whole numbers; with no bytes at all, rows count instead.
    if all_bytes:
        shard = F.expr(f"cast(least({shards - 1}, cast((2 * cast(bytes + before as decimal(24,0)) + size) * {shards} as decimal(38,0)) "
                       f"div {2 * all_bytes}) as int)")
    else:
        shard = F.expr(f"cast((rows + at) * {shards} div {max(1, all_rows)} as int)")
    out = staged(ordered.join(F.broadcast(offset), "part").select("row", shard.alias("shard"), (F.col("rows") + F.col("at")).alias("at")), "shards")
    firsts = out.groupBy("shard").agg(F.min("at").alias("first"))
    return out.join(F.broadcast(firsts) if shards <= FIRSTS else firsts, "shard").select("row", "shard", (F.col("at") - F.col("first")).alias("slot"))


def sharded(df: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", overhead: int = OVERHEAD) -> DataFrame:
    """All columns of ``df`` with ``shard`` and ``slot`` (columns of these names in ``df`` are replaced)."""
    text = F.col(f"`{text_col}`").cast("string")
    order = [F.col(f"`{id_col}`"), F.crc32(F.coalesce(text, F.lit("")))]
    out = placed(df, shards, text_size(text, overhead), order)
    return out.select(*(F.col(f"row.`{c}`").alias(c) for c in df.columns if c not in ("shard", "slot")), "shard", "slot")


def write_shards(df: DataFrame, path: str, **kwargs) -> None:
    """Write ``df`` as one folder a shard, each file in the shard's order; a shard is written by the tasks that hold its rows."""
    out = sharded(df, **kwargs)
    (out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in shards of nearly equal bytes."""
    out = sharded(read_table(spark, sf_dir, "documents"))
    text = F.col("text").cast("string")
    return out.select("doc_id", text_size(text).alias("size"), F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
                      F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def oracle_sql() -> str:
    return f"""
WITH rows_ AS (SELECT doc_id, coalesce(octet_length(encode(text)), 0) + {OVERHEAD} AS size,
                      {crc32_sql("encode(coalesce(text, ''))")} AS text_crc32 FROM documents),
summed AS (SELECT *, sum(size) OVER w AS upto, sum(size) OVER () AS total FROM rows_
           WINDOW w AS (ORDER BY doc_id NULLS LAST, text_crc32 ROWS UNBOUNDED PRECEDING)),
cut AS (SELECT *, least({SHARDS - 1}, ((2 * upto - size) * {SHARDS}) // (2 * total))::INTEGER AS shard FROM summed)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS LAST, text_crc32) - 1)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM cut
"""


ORACLE_SQL = oracle_sql()
