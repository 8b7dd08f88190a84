"""Paid model calls made once: a ledger of answers.

Rows that ask a model the same thing ask it once: distinct (model, prompt) first, so copies are aggregated before any shuffle of
texts. What the ledger already holds is not asked again. The rest is asked in small tasks, each of which adds its answers to
the ledger as soon as it is done, also if the job fails later; running the job again goes on from there. Only the calls of a
task that fails are made again, ``calls_per_task`` at most. Rows then take their answers from the ledger by a join.

The ledger is a folder of Parquet files on shared storage: key (SHA-256 of model and prompt), model, answer. Two runs may
answer one key twice; the smaller answer counts, so rows of one prompt always agree. A null prompt is a prompt like others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CALLS_PER_TASK = 64
#: Files of a finished task are moved to their place at once, not when the whole job ends.
TASK_COMMIT = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def call_key(model: str, prompt: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{model}\n"), F.coalesce(F.concat(F.lit("="), prompt), F.lit("-"))), 256)


def _schema(answer_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("key", T.StringType()), T.StructField("model", T.StringType()), T.StructField("answer", answer_type)])


def _known(spark, ledger: str, schema: T.StructType) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(ledger)


def ask_once(df: DataFrame, prompt: str, out: str, answer: Callable[[Column], Column], model: str, ledger: str,
             answer_type: T.DataType | None = None, calls_per_task: int = CALLS_PER_TASK) -> DataFrame:
    """``df`` with ``out``, the ``answer`` (a scorer's ``score``, a generator's ``generate``) to its column ``prompt``."""
    spark, schema = df.sparkSession, _schema(answer_type or T.StringType())
    text = F.col(f"`{prompt}`").cast("string")
    asked = df.select(call_key(model, text).alias("key"), text.alias("prompt")).groupBy("key").agg(F.first("prompt").alias("prompt"))
    todo = asked.join(_known(spark, ledger, schema).select("key"), "key", "left_anti").persist()
    try:
        n = todo.count()
        if n:
            tasks = todo.repartitionByRange(max(1, -(-n // calls_per_task)), "key")
            (tasks.select("key", F.lit(model).alias("model"), answer(F.col("prompt")).cast(schema["answer"].dataType).alias("answer"))
             .write.mode("append").options(**TASK_COMMIT).parquet(ledger))
    finally:
        todo.unpersist()
    answers = _known(spark, ledger, schema).where(F.col("model") == model).groupBy(F.col("key").alias("_call")).agg(F.min("answer").alias("_answer"))
    rest = [F.col(f"`{c}`") for c in df.columns if c != out]
    return (df.withColumn("_key", call_key(model, text)).join(answers, F.col("_key") == F.col("_call"), "left")
            .select(*rest, F.col("_answer").alias(out)))
