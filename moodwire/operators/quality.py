"""Required-field checks: report, never drop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REQUIRED_FIELDS = ("message_id", "customer_name")


def missing(col: str) -> Column:
    c = F.col(col)
    return c.isNull() | (c == F.lit(""))


def flag_required_fields(df: DataFrame, fields=REQUIRED_FIELDS) -> DataFrame:
    """Add ``missing_<field>`` flags; rows are kept."""
    for f in fields:
        df = df.withColumn(f"missing_{f}", missing(f))
    return df


def required_field_report(df: DataFrame, fields=REQUIRED_FIELDS) -> DataFrame:
    """One row: total and per-field missing counts (partial counts map-side)."""
    return df.agg(F.count(F.lit(1)).alias("total"),
                  *[F.count_if(missing(f)).alias(f"missing_{f}") for f in fields])


def observe_required_fields(df: DataFrame, name: str = "required_fields", fields=REQUIRED_FIELDS) -> DataFrame:
    """Streaming-friendly form: counts published per micro-batch via ``observe``."""
    return df.observe(name, F.count(F.lit(1)).alias("total"),
                      *[F.count_if(missing(f)).alias(f"missing_{f}") for f in fields])
