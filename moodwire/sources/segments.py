"""Serving tables in few large files: appended batches, and small files packed into files of a target size.

A table is a folder of Parquet files and a list of those that count. Each append or compaction writes new files beside the
old ones and then publishes the next list, in one atomic step (a rename that fails if the name is taken). A reader takes one
list and so sees the files before or after a change, never both or half of them; files that no list names stay on disk
until they are cleared away. Two writers at once are safe: the one that finds its number taken redoes its change on the new
list, and a compaction whose input has meanwhile gone is given up.

Small files are packed per day, largest first, into bins of at most the target size; a day's files at or above half the target are
left alone. The list is the only thing the driver handles; rows move in tasks, one per bin.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodwire.sources.sinks import DATE_COL, with_date

# --- fixed values that must equal the reference's -------------------------
SEGMENT_BYTES = 50 << 20
# --------------------------------------------------------------------------


class Conflict(RuntimeError):
    """The change no longer fits the table."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _list(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, bytes) of all files below ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found, it = [], fs.listFiles(p, True)
    while it.hasNext():
        f = it.next()
        found.append((f.getPath().toString(), f.getLen()))
    return found


def _newest(spark: SparkSession, root: str) -> int:
    names = [p.rsplit("/", 1)[1] for p, _ in _list(spark, f"{root}/lists")]
    return max((int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("_")), default=0)


def state(spark: SparkSession, root: str) -> tuple[int, dict]:
    """The newest list: its number, and {"files": [{path, day, bytes}], "batches": {query: last batch}}."""
    n = _newest(spark, root)
    if n == 0:
        return 0, {"files": [], "batches": {}}
    text = spark.read.option("wholetext", True).text(f"{root}/lists/{n:010d}.json").first()[0]
    return n, json.loads(text)


def publish(spark: SparkSession, root: str, change) -> int:
    """Replace the newest list by ``change(list)``, over again if another writer was faster."""
    while True:
        n, now = state(spark, root)
        new = change(json.loads(json.dumps(now)))
        if new is None:
            return n
        fs, tmp = _fs(spark, f"{root}/lists/_{uuid.uuid4().hex}.json")
        out = fs.create(tmp, False)
        out.write(bytearray(json.dumps(new).encode()))
        out.close()
        _, target = _fs(spark, f"{root}/lists/{n + 1:010d}.json")
        if not fs.exists(target) and fs.rename(tmp, target):
            return n + 1


def _written(spark: SparkSession, folder: str) -> list[dict]:
    return [{"path": p, "day": p.split(f"{DATE_COL}=")[1].split("/")[0], "bytes": b}
            for p, b in _list(spark, folder) if p.endswith(".parquet") and f"{DATE_COL}=" in p]


def append(df: DataFrame, root: str, ts_ms_col: str, batch: tuple[str, int] | None = None) -> bool:
    """Add ``df``'s rows. ``batch`` (query name, batch number) makes it idempotent: a batch that is in already adds nothing."""
    spark = df.sparkSession

    def known(now: dict) -> bool:
        return batch is not None and now["batches"].get(batch[0], -1) >= batch[1]

    if known(state(spark, root)[1]):
        return False
    folder = f"{root}/data/{uuid.uuid4().hex}"
    with_date(df, ts_ms_col).write.partitionBy(DATE_COL).parquet(folder)
    files, added = _written(spark, folder), []

    def change(now: dict):
        added.clear()
        if known(now):
            return None
        added.append(True)
        now["files"] += files
        if batch is not None:
            now["batches"][batch[0]] = batch[1]
        return now
    publish(spark, root, change)
    return bool(added)


def stream_append(df: DataFrame, root: str, ts_ms_col: str, checkpoint: str, name: str, trigger: str | None = "10 seconds"):
    """Continuous ingestion: each micro-batch is appended once, also if it is run again after a failure."""
    w = (df.writeStream.foreachBatch(lambda rows, n: append(rows, root, ts_ms_col, (name, n)) and None)
         .option("checkpointLocation", checkpoint).queryName(name))
    return (w.trigger(processingTime=trigger) if trigger else w.trigger(availableNow=True)).start()


def bins(files: list[dict], target: int) -> list[list[dict]]:
    """Files of one day below half the target, packed largest first into bins of at most ``target`` bytes; bins of one are left out."""
    out: list[list] = []
    for f in sorted((f for f in files if f["bytes"] < target // 2), key=lambda f: (-f["bytes"], f["path"])):
        for b in out:
            if b[0] + f["bytes"] <= target:
                b[0] += f["bytes"]
                b[1].append(f)
                break
        else:
            out.append([f["bytes"], [f]])
    return [b[1] for b in out if len(b[1]) > 1]


def compact(spark: SparkSession, root: str, schema: T.StructType, target: int = SEGMENT_BYTES) -> int:
    """Pack small files; the number of files that went into larger ones (0: nothing to do)."""
    _, now = state(spark, root)
    days: dict[str, list] = {}
    for f in now["files"]:
        days.setdefault(f["day"], []).append(f)
    packs = [b for day in sorted(days) for b in bins(days[day], target)]
    if not packs:
        return 0
    old = [f["path"] for b in packs for f in b]
    # A file is known by its day and name: one task's files of several days share their name.
    where = spark.createDataFrame([(f["path"][f["path"].index(f"{DATE_COL}="):], f["day"], k) for k, b in enumerate(packs) for f in b],
                                  "_file string, _day string, _bin int")
    folder = f"{root}/data/{uuid.uuid4().hex}"
    rows = spark.read.schema(schema).parquet(*old).withColumn("_file", F.regexp_extract("_metadata.file_path", f"{DATE_COL}=.*$", 0))
    rows = rows.join(F.broadcast(where), "_file").drop("_file").withColumn(DATE_COL, F.to_date("_day")).drop("_day")
    # A bin lies in one partition of the shuffle, so it becomes one file.
    rows.repartition(len(packs), "_bin").write.partitionBy(DATE_COL, "_bin").parquet(folder)
    new, gone = _written(spark, folder), set(old)

    def change(then: dict):
        if not gone <= {f["path"] for f in then["files"]}:
            raise Conflict("files to pack were replaced meanwhile")
        then["files"] = [f for f in then["files"] if f["path"] not in gone] + new
        return then
    publish(spark, root, change)
    return len(old)


def read(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The table as of now, with its declared columns and the day; empty before the first append."""
    _, now = state(spark, root)
    whole = T.StructType([*schema.fields, T.StructField(DATE_COL, T.DateType())])
    if not now["files"]:
        return spark.createDataFrame([], whole)
    rows = spark.read.schema(schema).parquet(*(f["path"] for f in now["files"]))
    day = F.to_date(F.regexp_extract(F.col("_metadata.file_path"), f"{DATE_COL}=([^/]+)/", 1))
    return rows.withColumn(DATE_COL, day)
