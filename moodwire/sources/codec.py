"""JSON record <-> row codecs for message topics and JSONL files.

Tolerant decoding (raw messages): a record that does not parse is dropped,
missing fields become NULL. Strict decoding (scored messages): a malformed
record fails the query. Timestamps travel as ISO-8601 text with milliseconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodwire import schemas

ISO_MS = "yyyy-MM-dd'T'HH:mm:ss.SSS"
JSON_WRITE_OPTS = {"timestampFormat": ISO_MS, "timestampNTZFormat": ISO_MS, "ignoreNullFields": "false"}
JSON_READ_OPTS = {"timestampFormat": ISO_MS, "timestampNTZFormat": ISO_MS, "allowSingleQuotes": "false"}


def encode_json(df: DataFrame, col: str = "value") -> DataFrame:
    """Every row as one JSON object text (NULL fields kept as null keys)."""
    return df.select(F.to_json(F.struct(*df.columns), JSON_WRITE_OPTS).alias(col))


def decode(df: DataFrame, schema: T.StructType, col: str = "value", strict: bool = False,
           keep: list[str] | None = None) -> DataFrame:
    """Parse JSON text in ``col`` with a declared schema.

    ``strict``: FAILFAST — the query fails on a malformed record.
    Otherwise tolerant: a record that is not a JSON object is dropped; in a
    parsed record a missing or wrongly typed field becomes NULL and the rest
    of the record is kept.
    """
    keep = keep or []
    if strict:
        parsed = F.from_json(F.col(col), schema, {**JSON_READ_OPTS, "mode": "FAILFAST"})
        return df.select(*keep, parsed.alias("_r")).select(*keep, "_r.*")
    parsed = F.from_json(F.col(col), schema, {**JSON_READ_OPTS, "mode": "PERMISSIVE"})
    out = df.filter(is_json_object(F.col(col))).select(*keep, parsed.alias("_r"))
    return out.select(*keep, *[F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields])


def is_json_object(c):
    """True when ``c`` is one JSON object and nothing else, double-quoted.

    The text is read as the only element of an array, so trailing text and a
    second object are seen; get_json_object would stop after the first."""
    one = F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<string>", {"allowSingleQuotes": "false"})
    return F.coalesce((F.size(one) == 1) & F.trim(c).startswith("{"), F.lit(False))


def quarantine(df: DataFrame, schema: T.StructType, col: str = "value") -> DataFrame:
    """The records tolerant :func:`decode` drops, with their raw text."""
    return df.filter(~F.coalesce(is_json_object(F.col(col)), F.lit(False))).select(F.col(col).alias("raw"))


def decode_messages(df: DataFrame, col: str = "value", keep=None) -> DataFrame:
    return decode(df, schemas.MESSAGE_PAYLOAD, col, strict=False, keep=keep)


def decode_sentiments(df: DataFrame, col: str = "value", strict: bool = True, keep=None) -> DataFrame:
    return decode(df, schemas.MESSAGE_SENTIMENTS, col, strict=strict, keep=keep)


def read_jsonl(spark, path: str, schema=None):
    """JSON-lines file(s) -> (rows, quarantine).

    Lines are stripped (Python rules, every kind of whitespace) and blank
    lines skipped; lines that do not parse go to the quarantine frame with
    their file and raw text (a line number is not stable in a distributed
    read). A missing path fails the read.
    """
    from moodwire.functions.text import py_strip
    schema = schema or schemas.MESSAGE_PAYLOAD
    raw = (spark.read.text(path).select(py_strip(F.col("value")).alias("value"),
                                        F.input_file_name().alias("file"))
           .filter(F.length("value") > 0))
    good = decode(raw, schema)
    bad = raw.filter(~F.coalesce(is_json_object(F.col("value")), F.lit(False))).select(
        "file", F.col("value").alias("raw"))
    return good, bad
