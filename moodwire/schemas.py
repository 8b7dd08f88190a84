"""Declared schemas of the message data model. Nothing is ever inferred."""

from pyspark.sql import types as T

METADATA = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("ip_country", T.StringType()),
])

# JSON payload of a raw customer message (what a producer writes).
MESSAGE_PAYLOAD = T.StructType([
    T.StructField("message_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("message_timestamp", T.LongType()),
    T.StructField("message_text", T.StringType()),
    T.StructField("metadata", METADATA),
])

# Payload plus the connector metadata columns (record time, partition, offset).
CUSTOMER_MESSAGES = T.StructType(MESSAGE_PAYLOAD.fields + [
    T.StructField("kafka_timestamp", T.TimestampNTZType()),
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
])

MESSAGE_SENTIMENTS = T.StructType([
    T.StructField("message_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("message_timestamp", T.LongType()),
    T.StructField("message_text", T.StringType()),
    T.StructField("ip_country", T.StringType()),
    T.StructField("sentiment_score", T.DoubleType()),
    T.StructField("sentiment_category", T.StringType()),
    T.StructField("model_used", T.StringType()),
    T.StructField("processing_timestamp", T.TimestampNTZType()),
    T.StructField("source_partition", T.IntegerType()),
    T.StructField("source_offset", T.LongType()),
])

ESCALATION_RESPONSES = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("karen_score_total", T.DoubleType()),
    T.StructField("rebuttal_text", T.StringType()),
    T.StructField("rebuttal_model", T.StringType()),
    T.StructField("generated_timestamp", T.LongType()),
    T.StructField("trigger_message_count", T.LongType()),
    T.StructField("recent_messages", T.StringType()),
])

USER_POOL = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("sentiment_types", T.ArrayType(T.StringType())),
    T.StructField("is_karen", T.BooleanType()),
])

# Serving-table variants: processing_timestamp is kept as a string there.
SENTIMENTS_SERVING = T.StructType([
    (f if f.name != "processing_timestamp" else T.StructField("processing_timestamp", T.StringType()))
    for f in MESSAGE_SENTIMENTS.fields
])
