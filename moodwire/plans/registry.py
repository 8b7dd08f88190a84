"""Registered queries: one per operator, each reading the driver's tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL`` (DuckDB
dialect over the pre-registered table views). Every query runs over whole
tables; doubles that depend on summation order are rounded to ``DIGITS`` on
both sides.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwire.functions.scoring import DEFAULT_LEXICON, SPARSE_LEXICON, LexiconScorer
from moodwire.functions.text import SENTIMENT_PROMPT_HEAD, SENTIMENT_PROMPT_TAIL
from moodwire.operators.burst import VERY_NEGATIVE
from moodwire.plans import fixture_sql as fx
from moodwire.plans import sentiment, serving
from moodwire.sources import fixtures

DIGITS = 6
PROCESSED_AT = dt.datetime(2024, 2, 1)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def dense_scorer() -> LexiconScorer:
    return LexiconScorer(DEFAULT_LEXICON, "lexicon")


def sparse_scorer() -> LexiconScorer:
    return LexiconScorer(SPARSE_LEXICON, "lexicon_sparse")


def sentiments(spark: SparkSession, sf_dir: str, sparse: bool = False) -> DataFrame:
    return sentiment.score_messages(fixtures.messages(spark, sf_dir),
                                    sparse_scorer() if sparse else dense_scorer(), PROCESSED_AT)


def _cte(name: str, body: str) -> str:
    return f"WITH {name} AS ({body})\n"


S = _cte("s", fx.DENSE_SQL)

# ---------------------------------------------------------------- J3 queries


@query("q_basic_count", S + "SELECT COUNT(*) AS total_messages FROM s")
def q_basic_count(spark, sf_dir):
    return serving.q_basic_count(sentiments(spark, sf_dir))


@query("q_geographic", S + f"""
SELECT ip_country, COUNT(*) AS msgs, round(AVG(sentiment_score), {DIGITS}) AS avg_sentiment
FROM s GROUP BY ip_country""")
def q_geographic(spark, sf_dir):
    return serving.q_geographic(sentiments(spark, sf_dir), digits=DIGITS)


@query("q_worst_customers", S + f"""
SELECT customer_name, customer_id, round(AVG(sentiment_score), {DIGITS}) AS avg_sentiment,
       COUNT(*) AS msgs
FROM s GROUP BY customer_name, customer_id
ORDER BY avg_sentiment ASC, customer_id ASC, customer_name ASC NULLS FIRST LIMIT 10""")
def q_worst_customers(spark, sf_dir):
    return serving.q_worst_customers(sentiments(spark, sf_dir), digits=DIGITS)



# ------------------------------------------------------------- derived inputs

def doc_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut at every '.', as message-like texts (some empty, some
    whitespace-only: the cases the blank rules disagree on)."""
    d = fixtures.table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", F.posexplode(F.split("text", r"\.")).alias("pos0", "piece")).select(
        "doc_id", (F.col("pos0") + 1).alias("pos"), "piece")


DOC_PIECES_SQL = """
SELECT doc_id, unnest(generate_series(1, len(arr))) AS pos, unnest(arr) AS piece
FROM (SELECT doc_id, string_split(text, '.') AS arr FROM documents) d
"""


def _k(col="props"):
    return F.regexp_extract(col, r"([0-9]+)", 1).cast("int")


K_SQL = "CAST(regexp_extract(props, '[0-9]+') AS INTEGER)"


def escalation_matches(spark, sf_dir, sparse=False, **kw):
    from moodwire.plans.escalation import escalations
    return escalations(sentiments(spark, sf_dir, sparse), **kw)


def responses(spark, sf_dir, sparse=False):
    from moodwire.plans.escalation import respond
    return respond(escalation_matches(spark, sf_dir, sparse), generated_at="event")


SP = _cte("s", fx.SPARSE_SQL)
M_SQL = fx.pattern_sql(fx.DENSE_SQL)
M_SPARSE_SQL = fx.pattern_sql(fx.SPARSE_SQL)
R = _cte("r", fx.responses_sql(fx.DENSE_SQL))
BOTH_SQL = f"({fx.DENSE_SQL}) UNION ALL ({fx.SPARSE_SQL})"

# ------------------------------------------------------- projections, filters


@query("flt_non_blank", f"""
SELECT doc_id, pos, length(piece) AS n_chars FROM ({DOC_PIECES_SQL}) p
WHERE piece IS NOT NULL AND length(trim(piece)) > 0""")
def flt_non_blank(spark, sf_dir):
    return sentiment.filter_non_blank(doc_pieces(spark, sf_dir), "piece").select(
        "doc_id", "pos", F.length("piece").alias("n_chars"))


@query("prj_nested_field", f"SELECT message_id, ip_country FROM ({fixtures.MESSAGES_SQL}) m")
def prj_nested_field(spark, sf_dir):
    return fixtures.messages(spark, sf_dir).select("message_id", F.col("metadata.ip_country").alias("ip_country"))


@query("prj_computed_ts", f"""
SELECT message_id,
       strftime(make_timestamp(message_timestamp * 1000), '%Y-%m-%d %H:%M:%S.%g') AS message_ts,
       strftime(make_timestamp(message_timestamp * 1000) - INTERVAL 5 SECOND, '%Y-%m-%d %H:%M:%S.%g') AS watermark_ts
FROM ({fixtures.MESSAGES_SQL}) m""")
def prj_computed_ts(spark, sf_dir):
    from moodwire.functions.text import epoch_ms_to_utc
    ts = epoch_ms_to_utc(F.col("message_timestamp"))
    fmt = "yyyy-MM-dd HH:mm:ss.SSS"
    return fixtures.messages(spark, sf_dir).select(
        "message_id", F.date_format(ts, fmt).alias("message_ts"),
        F.date_format(ts - F.expr("INTERVAL 5 SECONDS"), fmt).alias("watermark_ts"))


@query("prj_enriched", S + """
SELECT message_id, customer_id, customer_name, message_timestamp, message_text, ip_country,
       sentiment_score, sentiment_category, model_used,
       CAST(processing_timestamp AS VARCHAR) AS processing_timestamp, source_partition, source_offset
FROM s""")
def prj_enriched(spark, sf_dir):
    return sentiments(spark, sf_dir).withColumn(
        "processing_timestamp", F.col("processing_timestamp").cast("string"))


@query("lexicon_score", S + "SELECT message_id, sentiment_score, sentiment_category FROM s")
def lexicon_score(spark, sf_dir):
    return sentiments(spark, sf_dir).select("message_id", "sentiment_score", "sentiment_category")


@query("dq_required_fields", f"""
SELECT COUNT(*) AS total,
       COUNT(*) FILTER (WHERE message_id IS NULL OR message_id = '') AS missing_message_id,
       COUNT(*) FILTER (WHERE customer_name IS NULL OR customer_name = '') AS missing_customer_name
FROM ({fixtures.MESSAGES_SQL}) m""")
def dq_required_fields(spark, sf_dir):
    from moodwire.operators.quality import required_field_report
    return required_field_report(fixtures.messages(spark, sf_dir))


@query("fn_json_roundtrip", S + """
SELECT message_id, customer_id, customer_name, message_timestamp, message_text, ip_country,
       sentiment_score, sentiment_category, model_used,
       strftime(processing_timestamp, '%Y-%m-%dT%H:%M:%S.%g') AS processing_timestamp,
       source_partition, source_offset
FROM s""")
def fn_json_roundtrip(spark, sf_dir):
    from moodwire.sources.codec import decode_sentiments, encode_json
    back = decode_sentiments(encode_json(sentiments(spark, sf_dir)), strict=True)
    return back.withColumn("processing_timestamp",
                           F.date_format("processing_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSS"))


# ------------------------------------------------------------------ scalar UDFs


@query("udf_category", f"""
SELECT event_id, score, {fx.category_sql('score')} AS sentiment_category
FROM (SELECT event_id, CAST({K_SQL} % 21 - 10 AS DOUBLE) / 10.0::DOUBLE AS score FROM events) e""")
def udf_category(spark, sf_dir):
    from moodwire.functions.text import category
    e = fixtures.table(spark, sf_dir, "events").select(
        "event_id", ((_k() % 21 - 10).cast("double") / F.lit(10.0)).alias("score"))
    return e.select("event_id", "score", category(F.col("score")).alias("sentiment_category"))


@query("udf_class_to_score", f"""
SELECT event_id, idx, coalesce(([-0.8, -0.4, 0.0, 0.4, 0.8]::DOUBLE[])[idx + 1], 0.0)::DOUBLE AS score
FROM (SELECT event_id, {K_SQL} % 7 - 1 AS idx FROM events) e""")
def udf_class_to_score(spark, sf_dir):
    from moodwire.functions.text import class_to_score
    e = fixtures.table(spark, sf_dir, "events").select("event_id", (_k() % 7 - 1).alias("idx"))
    return e.select("event_id", "idx", class_to_score(F.col("idx")).alias("score"))


def _reply_col():
    k = _k().cast("string")
    return (F.when(F.col("event_type") == "error", F.concat(F.lit("-0."), k))
            .when(F.col("event_type") == "view", F.concat(F.lit(" "), k, F.lit("e-2 ")))
            .when(F.col("event_type") == "purchase", F.concat(F.lit("+"), k))
            .when(F.col("event_type") == "signup",
                  F.when(_k() % 3 == 0, F.lit("NaN")).when(_k() % 3 == 1, F.lit("-Infinity"))
                  .otherwise(F.concat(F.lit("1_"), k)))
            .otherwise(F.col("props")))


def _parse_sql(r: str) -> str:
    from moodwire.functions.text import PY_SPACE_CLASS as sp
    t = f"regexp_replace({r}, '^[{sp}]+|[{sp}]+$', '', 'g')"
    num = r"^[+-]?(([0-9]+(_[0-9]+)*)(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+(_[0-9]+)*)?$"
    special = "^(?i)[+-]?(nan|inf|infinity)$"
    return f"""CASE WHEN regexp_matches({t}, '{special}')
                THEN CASE WHEN starts_with(lower({t}), '-') AND NOT contains(lower({t}), 'nan') THEN -1.0 ELSE 1.0 END
            WHEN regexp_matches({t}, '{num}')
                THEN coalesce(greatest(-1.0, least(1.0, TRY_CAST(replace({t}, '_', '') AS DOUBLE))), 0.0)
            ELSE 0.0 END::DOUBLE"""


_REPLY_SQL = f"""CASE event_type WHEN 'error' THEN '-0.' || CAST({K_SQL} AS VARCHAR)
    WHEN 'view' THEN ' ' || CAST({K_SQL} AS VARCHAR) || 'e-2 '
    WHEN 'purchase' THEN '+' || CAST({K_SQL} AS VARCHAR)
    WHEN 'signup' THEN CASE {K_SQL} % 3 WHEN 0 THEN 'NaN' WHEN 1 THEN '-Infinity'
                       ELSE '1_' || CAST({K_SQL} AS VARCHAR) END
    ELSE props END"""


@query("udf_parse_score", f"""
SELECT event_id, reply, {_parse_sql('reply')} AS score
FROM (SELECT event_id, {_REPLY_SQL} AS reply FROM events) e""")
def udf_parse_score(spark, sf_dir):
    from moodwire.functions.text import parse_score
    e = fixtures.table(spark, sf_dir, "events").select("event_id", _reply_col().alias("reply"))
    return e.select("event_id", "reply", parse_score(F.col("reply")).alias("score"))


def _blank_sql(c: str) -> str:
    from moodwire.functions.text import NON_BLANK_RE
    return f"({c} IS NULL OR NOT regexp_matches({c}, '{NON_BLANK_RE}'))"


@query("udf_blank_neutral", f"""
SELECT doc_id, pos, {_blank_sql('piece')} AS is_blank,
       CASE WHEN {_blank_sql('piece')} THEN 0.0::DOUBLE ELSE {fx.lexicon_sql('piece', DEFAULT_LEXICON)} END AS score
FROM ({DOC_PIECES_SQL}) p""")
def udf_blank_neutral(spark, sf_dir):
    from moodwire.functions.text import is_blank_py
    p = doc_pieces(spark, sf_dir)
    return p.select("doc_id", "pos", is_blank_py(F.col("piece")).alias("is_blank"),
                    dense_scorer().score(F.col("piece")).alias("score"))


def _sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


@query("udf_sentiment_prompt", f"""
SELECT conv_id, turn, {_sql_str(SENTIMENT_PROMPT_HEAD)} || text || {_sql_str(SENTIMENT_PROMPT_TAIL)} AS prompt
FROM conversations""")
def udf_sentiment_prompt(spark, sf_dir):
    from moodwire.functions.text import sentiment_prompt
    c = fixtures.table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", sentiment_prompt(F.col("text")).alias("prompt"))


# -------------------------------------------------------------- escalations


@query("st_pattern_dense", f"SELECT * FROM ({M_SQL}) m")
def st_pattern_dense(spark, sf_dir):
    return escalation_matches(spark, sf_dir)


@query("st_pattern_sparse", f"SELECT * FROM ({M_SPARSE_SQL}) m")
def st_pattern_sparse(spark, sf_dir):
    return escalation_matches(spark, sf_dir, sparse=True)


# Scores of one decimal, from the number in events.props: running sums reach the threshold often, to the rounding.
TIES_SQL = f"""SELECT * REPLACE ((CAST(regexp_extract(message_text, '[0-9]+') AS INTEGER) % 13 - 7) / 10.0::DOUBLE AS sentiment_score)
FROM ({fx.DENSE_SQL}) d"""


def tie_scores(spark, sf_dir):
    return sentiments(spark, sf_dir).withColumn("sentiment_score", (_k("message_text") % 13 - 7) / F.lit(10.0))


@query("st_pattern_ties", f"SELECT * FROM ({fx.pattern_sql(TIES_SQL)}) m")
def st_pattern_ties(spark, sf_dir):
    from moodwire.plans.escalation import escalations
    return escalations(tie_scores(spark, sf_dir))


PATTERN_WITHIN_MS = 10 * 86_400_000


@query("st_pattern_within", f"SELECT * FROM ({fx.pattern_within_sql(fx.DENSE_SQL, PATTERN_WITHIN_MS)}) m")
def st_pattern_within(spark, sf_dir):
    from moodwire.operators.within import match_escalations_within
    return match_escalations_within(sentiments(spark, sf_dir), PATTERN_WITHIN_MS)


@query("udf_response_prompt", f"""
SELECT customer_id, trigger_order,
       {fx.response_prompt_sql('customer_name', 'karen_score_total', 'recent_messages')} AS prompt
FROM ({M_SQL}) m""")
def udf_response_prompt(spark, sf_dir):
    from moodwire.functions.text import response_prompt
    m = escalation_matches(spark, sf_dir)
    return m.select("customer_id", "trigger_order",
                    response_prompt(F.col("customer_name"), F.col("karen_score_total"),
                                    F.col("recent_messages")).alias("prompt"))


@query("escalation_responses", R + "SELECT * FROM r")
def escalation_responses(spark, sf_dir):
    return responses(spark, sf_dir)


# ------------------------------------------------------------------- metrics

_SM = serving.SENTIMENT_METRICS
_SM_SQL = f"""COUNT(*) AS count, round(AVG(sentiment_score), {DIGITS}) AS avg_sentiment,
  MIN(sentiment_score) AS min_sentiment, MAX(sentiment_score) AS max_sentiment,
  COUNT(CASE WHEN sentiment_score < -0.5 THEN 1 END) AS karen_count,
  COUNT(CASE WHEN sentiment_score > 0.1 THEN 1 END) AS positive_count,
  COUNT(CASE WHEN sentiment_score < -0.1 THEN 1 END) AS negative_count,
  COUNT(DISTINCT customer_id) AS unique_customers,
  round(COUNT(CASE WHEN sentiment_score < -0.5 THEN 1 END) * 100.0::DOUBLE / COUNT(*), {DIGITS}) AS karen_percentage"""


@query("m_sentiments_all", S + f"SELECT {_SM_SQL} FROM s")
def m_sentiments_all(spark, sf_dir):
    return serving.metrics(sentiments(spark, sf_dir), _SM, digits=DIGITS)


@query("m_sentiments_by_country", S + f"SELECT ip_country, {_SM_SQL} FROM s GROUP BY ip_country")
def m_sentiments_by_country(spark, sf_dir):
    return serving.metrics(sentiments(spark, sf_dir), _SM, by=["ip_country"], digits=DIGITS)


_RM_SQL = f"""COUNT(*) AS rebuttal_count, round(AVG(karen_score_total), {DIGITS}) AS avg_karen_score,
  round(MAX(karen_score_total), {DIGITS}) AS max_karen_score, round(MIN(karen_score_total), {DIGITS}) AS min_karen_score,
  round(AVG(trigger_message_count), {DIGITS}) AS avg_trigger_count, MAX(trigger_message_count) AS max_trigger_count,
  COUNT(DISTINCT customer_id) AS unique_karen_customers,
  COUNT(CASE WHEN rebuttal_model = 'gpt-4.1-mini' THEN 1 END) AS gpt4_rebuttals,
  COUNT(CASE WHEN trigger_message_count >= 8 THEN 1 END) AS extreme_karen_count,
  round(CASE WHEN (extract(hour FROM make_timestamp(MAX(generated_timestamp) * 1000))
             - extract(hour FROM make_timestamp(MIN(generated_timestamp) * 1000)) + 1) = 0 THEN NULL
        ELSE COUNT(*)::DOUBLE / (extract(hour FROM make_timestamp(MAX(generated_timestamp) * 1000))
             - extract(hour FROM make_timestamp(MIN(generated_timestamp) * 1000)) + 1) END, {DIGITS}) AS rebuttals_per_hour,
  round(COUNT(*)::DOUBLE / (floor((MAX(generated_timestamp) - MIN(generated_timestamp)) / 3600000) + 1), {DIGITS})
      AS rebuttals_per_elapsed_hour"""


@query("m_responses_all", R + f"SELECT {_RM_SQL} FROM r")
def m_responses_all(spark, sf_dir):
    return serving.metrics(responses(spark, sf_dir), serving.RESPONSE_METRICS, digits=DIGITS)


@query("m_responses_by_model", R + f"SELECT rebuttal_model, {_RM_SQL} FROM r GROUP BY rebuttal_model")
def m_responses_by_model(spark, sf_dir):
    return serving.metrics(responses(spark, sf_dir), serving.RESPONSE_METRICS, by=["rebuttal_model"],
                           digits=DIGITS)


@query("q_recent_responses", R + """
SELECT customer_name, customer_id, rebuttal_text, generated_timestamp FROM r
ORDER BY generated_timestamp DESC, customer_id ASC, customer_name ASC NULLS FIRST LIMIT 5""")
def q_recent_responses(spark, sf_dir):
    return serving.q_recent_responses(responses(spark, sf_dir))


@query("q_top_escalators", R + f"""
SELECT customer_name, COUNT(*) AS rebuttal_count, round(AVG(karen_score_total), {DIGITS}) AS avg_karen_score
FROM r GROUP BY customer_name ORDER BY rebuttal_count DESC, customer_name ASC NULLS FIRST LIMIT 10""")
def q_top_escalators(spark, sf_dir):
    return serving.q_top_escalators(responses(spark, sf_dir), digits=DIGITS)


@query("q_effectiveness", R + f"""
SELECT rebuttal_model, COUNT(*) AS total_rebuttals, round(AVG(trigger_message_count), {DIGITS}) AS avg_trigger_count
FROM r GROUP BY rebuttal_model""")
def q_effectiveness(spark, sf_dir):
    return serving.q_effectiveness(responses(spark, sf_dir), digits=DIGITS)


# -------------------------------------------------------------------- panels

HOUR = 3_600_000
DAY = 24 * HOUR


@query("ts_sentiment_trend", S + f"""
SELECT message_timestamp - (message_timestamp % {HOUR}) AS bucket_start_ms,
       round(AVG(sentiment_score), {DIGITS}) AS avg_sentiment, COUNT(*) AS msgs
FROM s GROUP BY 1""")
def ts_sentiment_trend(spark, sf_dir):
    return serving.ts_sentiment_trend(sentiments(spark, sf_dir), HOUR, digits=DIGITS)


@query("ts_category_distribution", S + f"""
SELECT sentiment_category, msgs, round(msgs * 100.0::DOUBLE / SUM(msgs) OVER (), {DIGITS}) AS share_pct
FROM (SELECT sentiment_category, COUNT(*) AS msgs FROM s GROUP BY 1) c""")
def ts_category_distribution(spark, sf_dir):
    return serving.ts_category_distribution(sentiments(spark, sf_dir), digits=DIGITS)


@query("ts_message_volume", S + f"""
SELECT message_timestamp - (message_timestamp % {HOUR}) AS bucket_start_ms, COUNT(*) AS msgs,
       round(COUNT(*) / {HOUR / 1000.0}, {DIGITS}) AS msgs_per_sec
FROM s GROUP BY 1""")
def ts_message_volume(spark, sf_dir):
    return serving.ts_message_volume(sentiments(spark, sf_dir), HOUR, digits=DIGITS)


@query("ts_responses", R + f"""
SELECT generated_timestamp - (generated_timestamp % {DAY}) AS bucket_start_ms, COUNT(*) AS responses,
       round(AVG(karen_score_total), {DIGITS}) AS avg_karen_score,
       CAST(SUM(trigger_message_count) AS BIGINT) AS trigger_messages
FROM r GROUP BY 1""")
def ts_responses(spark, sf_dir):
    return serving.ts_responses(responses(spark, sf_dir), DAY, digits=DIGITS)


@query("ts_model_comparison", _cte("s", BOTH_SQL) + f"SELECT model_used, {_SM_SQL} FROM s GROUP BY model_used")
def ts_model_comparison(spark, sf_dir):
    both = sentiments(spark, sf_dir).unionByName(sentiments(spark, sf_dir, sparse=True))
    return serving.ts_model_comparison(both, digits=DIGITS)


@query("mdl_union", _cte("s", BOTH_SQL) + """
SELECT model_used, sentiment_category, COUNT(*) AS msgs FROM s GROUP BY 1, 2""")
def mdl_union(spark, sf_dir):
    from moodwire.operators.compare import union_models
    u = union_models([sentiments(spark, sf_dir), sentiments(spark, sf_dir, sparse=True)])
    return u.groupBy("model_used", "sentiment_category").agg(F.count(F.lit(1)).alias("msgs"))


@query("jn_model_compare", f"""
SELECT a.sentiment_category AS category_a, COUNT(*) AS msgs,
       COUNT(*) FILTER (WHERE a.sentiment_category = b.sentiment_category) AS agree,
       round(AVG(abs(a.sentiment_score - b.sentiment_score)), {DIGITS}) AS mean_abs_diff
FROM (SELECT DISTINCT ON (message_id) * FROM ({fx.DENSE_SQL}) d) a
JOIN (SELECT DISTINCT ON (message_id) * FROM ({fx.SPARSE_SQL}) e) b ON a.message_id = b.message_id
GROUP BY 1""")
def jn_model_compare(spark, sf_dir):
    from moodwire.operators.compare import compare_models
    return compare_models(sentiments(spark, sf_dir), sentiments(spark, sf_dir, sparse=True), digits=DIGITS)


# ----------------------------------------------------------------- w_burst_rule

BURST_K, BURST_WINDOW_MS = 5, 7 * DAY


@query("w_burst_rule", S + f"""
SELECT customer_id, customer_name, message_id, message_timestamp, burst_count FROM (
  SELECT customer_id, customer_name, message_id, message_timestamp,
         COUNT(*) OVER (PARTITION BY customer_id ORDER BY message_timestamp
                        RANGE BETWEEN {BURST_WINDOW_MS} PRECEDING AND CURRENT ROW) AS burst_count
  FROM s WHERE sentiment_category = 'F - Very Negative') w
WHERE burst_count >= {BURST_K}""")
def w_burst_rule(spark, sf_dir):
    from moodwire.operators.burst import burst_rule
    return burst_rule(sentiments(spark, sf_dir), k=BURST_K, window_ms=BURST_WINDOW_MS)


# --------------------------------------------------------------- user lookup


@query("jn_user_lookup", f"""
WITH pool AS (
  SELECT 'cust_' || lpad(CAST(c.c_custkey AS VARCHAR), 5, '0') AS customer_id, c.c_name AS name,
         n.n_name AS country, c.c_acctbal < 0 AS is_karen,
         CASE WHEN c.c_acctbal < 0 THEN 'karen,mildly_negative' ELSE 'normal,mildly_positive,funny' END AS types
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT m.message_id, m.customer_id,
       coalesce(p.name, 'Customer_' || right(m.customer_id, 5)) AS name,
       coalesce(p.country, 'US') AS country,
       coalesce(p.is_karen, false) AS is_karen,
       coalesce(p.types, 'normal') AS sentiment_types
FROM (SELECT message_id, CASE WHEN message_timestamp % 10 = 0 THEN 'new_' || customer_id ELSE customer_id END AS customer_id
      FROM ({fixtures.MESSAGES_SQL}) x) m LEFT JOIN pool p ON m.customer_id = p.customer_id""")
def jn_user_lookup(spark, sf_dir):
    from moodwire.operators.lookup import user_lookup
    from moodwire.sources.pools import user_pool_from_customers
    pool = user_pool_from_customers(spark, sf_dir)
    # Some messages get an id outside the pool, so the default record is met too.
    unknown = F.when(F.col("message_timestamp") % 10 == 0, F.concat(F.lit("new_"), "customer_id")).otherwise(F.col("customer_id"))
    out = user_lookup(fixtures.messages(spark, sf_dir).withColumn("customer_id", unknown), pool)
    return out.select("message_id", "customer_id", "name", "country", "is_karen",
                      F.array_join("sentiment_types", ",").alias("sentiment_types"))


# -------------------------------------------------------------------- flagship


def flagship(spark, sf_dir):
    """Score -> categorise -> match escalations -> respond, over whole tables."""
    return responses(spark, sf_dir)


# ------------------------------------------------------ model adapters (batched)


@query("udf_score_classifier", """
SELECT conv_id, turn, CASE length(text) % 5 WHEN 0 THEN -0.8 WHEN 1 THEN -0.4 WHEN 2 THEN 0.0
                      WHEN 3 THEN 0.4 ELSE 0.8 END::DOUBLE AS score
FROM conversations""")
def udf_score_classifier(spark, sf_dir):
    from moodwire.functions.scoring import ClassifierScorer, LengthClassifier
    sc = ClassifierScorer(LengthClassifier, model_name="length-classifier", cache_key="registry:length")
    c = fixtures.table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", sc.score(F.col("text")).alias("score"))


@query("udf_generate", f"""
SELECT customer_id, trigger_order,
       'gpt-4o: ' || sha256({fx.response_prompt_sql('customer_name', 'karen_score_total', 'recent_messages')})
         AS rebuttal_text
FROM ({M_SQL}) m""")
def udf_generate(spark, sf_dir):
    from moodwire.functions.generation import ChatModelGenerator, EchoChatClient
    from moodwire.functions.text import response_prompt
    gen = ChatModelGenerator(EchoChatClient, cache_key="registry:echo")
    m = escalation_matches(spark, sf_dir)
    prompt = response_prompt(F.col("customer_name"), F.col("karen_score_total"), F.col("recent_messages"))
    return m.select("customer_id", "trigger_order", gen.generate(prompt, F.lit("gpt-4o")).alias("rebuttal_text"))


@query("udf_generate_once", ORACLE["udf_generate"])
def udf_generate_once(spark, sf_dir):
    """The same responses through a ledger of calls: every match comes twice, and half of the prompts were asked before."""
    from moodwire.functions.generation import ChatModelGenerator, EchoChatClient
    from moodwire.functions.ledger import ask_once
    from moodwire.functions.text import response_prompt
    from moodwire.streaming.replay import scratch_path
    gen, ledger = ChatModelGenerator(EchoChatClient, cache_key="registry:echo"), scratch_path(spark, "ledger")
    prompt = response_prompt(F.col("customer_name"), F.col("karen_score_total"), F.col("recent_messages"))
    m = escalation_matches(spark, sf_dir).select("customer_id", "trigger_order", prompt.alias("prompt"))

    def ask(rows):
        return ask_once(rows, "prompt", "rebuttal_text", lambda p: gen.generate(p, F.lit("gpt-4o")), "gpt-4o", ledger)
    ask(m.where(F.pmod(F.xxhash64("customer_id"), F.lit(2)) == 0))
    return ask(m.unionByName(m)).select("customer_id", "trigger_order", "rebuttal_text").distinct()


# ----------------------------------------------------------- data preparation (rows-only)


def _pool(spark, sf_dir):
    from moodwire.sources.pools import user_pool_from_customers
    return user_pool_from_customers(spark, sf_dir)


@query("dp_expand")
def dp_expand(spark, sf_dir):
    from moodwire.plans.dataprep import expand_users
    return expand_users(_pool(spark, sf_dir)).select("customer_id", "is_karen", "n_messages", "seq")


@query("dp_pick_template")
def dp_pick_template(spark, sf_dir):
    from moodwire.plans.dataprep import expand_users, pick_templates
    from moodwire.sources.pools import templates_from_conversations
    rows = expand_users(_pool(spark, sf_dir))
    return pick_templates(rows, templates_from_conversations(spark, sf_dir)).select(
        "customer_id", "seq", "type", "template")


@query("dp_build_message")
def dp_build_message(spark, sf_dir):
    from moodwire.plans.dataprep import generate_messages
    from moodwire.sources.pools import templates_from_conversations
    return generate_messages(_pool(spark, sf_dir), templates_from_conversations(spark, sf_dir),
                             at_ms=F.lit(1_704_067_200_000))


@query("dp_upsample")
def dp_upsample(spark, sf_dir):
    from moodwire.plans.dataprep import upsample
    m = fixtures.messages(spark, sf_dir).drop("kafka_timestamp", "kafka_partition", "kafka_offset")
    return upsample(m, target=2 * m.count() + 7)


@query("dp_replay")
def dp_replay(spark, sf_dir):
    from moodwire.plans.dataprep import keyed_records, replay, shuffle_order
    m = fixtures.messages(spark, sf_dir).drop("kafka_timestamp", "kafka_partition", "kafka_offset")
    return keyed_records(replay(shuffle_order(m), loops=2, at_ms=F.lit(1_704_067_200_000)))


# ------------------------------------------------- sources and sinks, round trip

def _jsonl_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as JSON lines, the way a producer file looks: 'error' events
    are cut short (malformed), 'view' lines are padded with whitespace and a
    whitespace-only line follows every 'click' line."""
    from moodwire import schemas
    from moodwire.sources.codec import JSON_WRITE_OPTS
    m = fixtures.messages(spark, sf_dir)
    js = F.to_json(F.struct(*[m[c] for c in schemas.MESSAGE_PAYLOAD.names]), JSON_WRITE_OPTS)

    def starts(word):
        return F.coalesce(F.col("message_text").startswith(word), F.lit(False))

    line = (F.when(starts("error"), F.expr("substring(_js, 1, length(_js) - 1)"))
            .when(starts("view"), F.concat(F.lit("  "), F.col("_js"), F.lit("\t")))
            .otherwise(F.col("_js")))
    lines = F.when(starts("click"), F.array(line, F.lit(" \t"))).otherwise(F.array(line))
    return m.withColumn("_js", js).select(F.explode(lines).alias("value"))


def _read_back_jsonl(spark: SparkSession, sf_dir: str):
    from moodwire.sources.codec import read_jsonl
    from moodwire.streaming.replay import scratch_path
    path = scratch_path(spark, "jsonl")
    _jsonl_lines(spark, sf_dir).write.text(path)
    return read_jsonl(spark, path)


_NOT_ERROR = "NOT coalesce(starts_with(message_text, 'error'), false)"


@query("src_jsonl", f"""
SELECT message_id, customer_id, customer_name, message_timestamp, message_text, ip_country
FROM ({fixtures.MESSAGES_SQL}) m WHERE {_NOT_ERROR}""")
def src_jsonl(spark, sf_dir):
    good, _ = _read_back_jsonl(spark, sf_dir)
    return good.select("message_id", "customer_id", "customer_name", "message_timestamp", "message_text",
                       F.col("metadata.ip_country").alias("ip_country"))


@query("src_jsonl_quarantine", f"""
SELECT COUNT(*) AS quarantined FROM ({fixtures.MESSAGES_SQL}) m WHERE NOT ({_NOT_ERROR})""")
def src_jsonl_quarantine(spark, sf_dir):
    _, bad = _read_back_jsonl(spark, sf_dir)
    return bad.agg(F.count(F.lit(1)).alias("quarantined"))


SERVING_TABLE = "moodwire_sentiments_rt"


@query("snk_serving_table", S + f"""
SELECT CAST(make_timestamp(message_timestamp * 1000) AS DATE) AS event_date, COUNT(*) AS msgs,
       round(AVG(sentiment_score), {DIGITS}) AS avg_sentiment
FROM s GROUP BY 1""")
def snk_serving_table(spark, sf_dir):
    """Scored rows appended to a date-partitioned serving table, the table
    (re-)registered, then queried per day from the catalog."""
    from moodwire.plans.sentiment import to_serving
    from moodwire.sources.sinks import DATE_COL, recreate_table, write_serving
    from moodwire.streaming.replay import scratch_path
    path = scratch_path(spark, "serving")
    write_serving(to_serving(sentiments(spark, sf_dir)).drop("message_date"), path, "message_timestamp")
    recreate_table(spark, SERVING_TABLE, path, recreate=True)
    return spark.table(SERVING_TABLE).groupBy(DATE_COL).agg(
        F.count(F.lit(1)).alias("msgs"), F.round(F.avg("sentiment_score"), DIGITS).alias("avg_sentiment"))


@query("snk_serving_compacted", ORACLE["snk_serving_table"])
def snk_serving_compacted(spark, sf_dir):
    """The serving table appended to in two parts of many small files, packed in between and once more behind."""
    from moodwire import schemas
    from moodwire.plans.sentiment import to_serving
    from moodwire.sources import segments
    from moodwire.sources.sinks import DATE_COL
    from moodwire.streaming.replay import scratch_path
    root = scratch_path(spark, "segments")
    rows = to_serving(sentiments(spark, sf_dir)).select(schemas.SENTIMENTS_SERVING.names)
    for half in (0, 1):
        segments.append(rows.where(F.pmod(F.xxhash64("message_id"), F.lit(2)) == half), root, "message_timestamp", ("parts", half))
        segments.compact(spark, root, schemas.SENTIMENTS_SERVING)
    return segments.read(spark, root, schemas.SENTIMENTS_SERVING).groupBy(DATE_COL).agg(
        F.count(F.lit(1)).alias("msgs"), F.round(F.avg("sentiment_score"), DIGITS).alias("avg_sentiment"))


@query("m_rollup_days", S + f"""
SELECT message_timestamp // {DAY} * {DAY} AS bucket_ms, COUNT(*) AS msgs,
       CAST(SUM(CAST(sentiment_score AS DECIMAL(28, 9))) AS DOUBLE) / COUNT(sentiment_score) AS avg_sentiment,
       MIN(sentiment_score) AS min_sentiment, MAX(sentiment_score) AS max_sentiment,
       COUNT(*) FILTER (sentiment_category = 'F - Very Negative') AS very_negative,
       COUNT(DISTINCT customer_id) AS customers_exact, true AS estimate_within_bound
FROM s GROUP BY 1""")
def m_rollup_days(spark, sf_dir):
    """Hourly rollups by model and country, stored, merged to days of all models and countries; averages are not rounded."""
    from moodwire.plans import rollup
    from moodwire.streaming.replay import scratch_path
    s, path, by = sentiments(spark, sf_dir), scratch_path(spark, "rollup"), ("model_used", "ip_country")
    rollup.sentiment_rollup(s, HOUR, by).write.parquet(path)
    days = rollup.rollup_metrics(rollup.merge_rollup(spark.read.parquet(path), DAY, ()), ())
    exact = s.groupBy((F.floor(F.col("message_timestamp") / DAY) * DAY).cast("long").alias("bucket_ms")).agg(
        F.countDistinct("customer_id").alias("customers_exact"))
    near = F.abs(F.col("unique_customers") - F.col("customers_exact")) <= F.greatest(F.lit(1.0), F.col("customers_exact") * rollup.ERROR_BOUND)
    return days.join(exact, "bucket_ms").withColumn("estimate_within_bound", near).drop("unique_customers")


_SQL_NAME_QUERY = "SELECT conv_id, turn, {0}(text) AS score, '{1}' AS model FROM conversations_for_scoring"


@query("udf_register_swap", """
SELECT conv_id, turn, CASE length(text) % 5 WHEN 0 THEN -0.8 WHEN 1 THEN -0.4 WHEN 2 THEN 0.0
                      WHEN 3 THEN 0.4 ELSE 0.8 END::DOUBLE AS score, 'classifier' AS model FROM conversations
UNION ALL
SELECT conv_id, turn, CASE WHEN regexp_matches(text, '\\S') THEN greatest(-1.0, least(1.0,
         coalesce(list_sum(list_transform(regexp_split_to_array(lower(text), '[^\\p{L}]+'),
           lambda w: CASE w WHEN 'the' THEN -0.25 WHEN 'and' THEN 0.125 WHEN 'of' THEN 0.5 ELSE 0.0 END)), 0.0))) ELSE 0.0 END::DOUBLE,
       'lexicon' FROM conversations""")
def udf_register_swap(spark, sf_dir):
    """One SQL text, one function name, bound to the native lexicon and then to the batched classifier."""
    from moodwire.functions.scoring import ClassifierScorer, LengthClassifier, register
    fixtures.table(spark, sf_dir, "conversations").createOrReplaceTempView("conversations_for_scoring")
    name, out = "score_sentiment", []
    for model, scorer in (("lexicon", LexiconScorer({"the": -0.25, "and": 0.125, "of": 0.5})),
                          ("classifier", ClassifierScorer(LengthClassifier, cache_key="registry:length"))):
        register(spark, name, scorer)
        out.append(spark.sql(_SQL_NAME_QUERY.format(name, model)))
    return out[0].unionByName(out[1])


# ------------------------------------------- streaming jobs over a replayed table


@query("j1_stream", S + "SELECT message_id, sentiment_score, sentiment_category, model_used, source_partition, "
                        "source_offset FROM s")
def j1_stream(spark, sf_dir):
    from moodwire.streaming import jobs, replay
    msgs = fixtures.messages(spark, sf_dir)
    out = replay.replay(msgs, lambda st: jobs.sentiment_stream(st, dense_scorer()), "j1_stream")
    return out.select("message_id", "sentiment_score", "sentiment_category", "model_used",
                      "source_partition", "source_offset")


@query("st_pattern_stream", f"SELECT * FROM ({M_SQL}) m")
def st_pattern_stream(spark, sf_dir):
    from moodwire.streaming import replay
    from moodwire.streaming.state import match_stream
    return replay.replay(sentiments(spark, sf_dir), match_stream, "st_pattern_stream",
                         key_cols=("customer_id", "customer_name"))


@query("st_pattern_ties_stream", ORACLE["st_pattern_ties"])
def st_pattern_ties_stream(spark, sf_dir):
    from moodwire.streaming import replay
    from moodwire.streaming.state import match_stream
    return replay.replay(tie_scores(spark, sf_dir), match_stream, "st_pattern_ties_stream",
                         key_cols=("customer_id", "customer_name"))


def _very_negative(spark, sf_dir):
    return sentiments(spark, sf_dir).where(F.col("sentiment_category") == VERY_NEGATIVE)


LATE_MS = 3 * DAY


def _late(df, by="message_id"):
    """Rows arrive up to LATE_MS after their time, each by a delay of its own."""
    return df.withColumn("arrival", F.col("message_timestamp") + F.pmod(F.xxhash64(by), F.lit(LATE_MS)))


@query("w_burst_stream", ORACLE["w_burst_rule"])
def w_burst_stream(spark, sf_dir):
    from moodwire.streaming import jobs, replay
    return replay.replay(_very_negative(spark, sf_dir), lambda st: jobs.burst_stream(st, k=BURST_K, window_ms=BURST_WINDOW_MS),
                         "w_burst_stream", end_ms=DAY)


@query("w_burst_stream_late", ORACLE["w_burst_rule"])
def w_burst_stream_late(spark, sf_dir):
    """Rows out of order by up to LATE_MS; the watermark waits as long, and nothing is missed."""
    from moodwire.streaming import jobs, replay
    return replay.replay(_late(_very_negative(spark, sf_dir)),
                         lambda st: jobs.burst_stream(st, k=BURST_K, window_ms=BURST_WINDOW_MS, delay=f"{LATE_MS} milliseconds"),
                         "w_burst_stream_late", arrival="arrival", end_ms=LATE_MS + DAY)


@query("st_pattern_within_stream", ORACLE["st_pattern_within"])
def st_pattern_within_stream(spark, sf_dir):
    """Time-bounded matches of rows that arrive out of order by up to LATE_MS."""
    from moodwire.streaming import jobs, replay
    return replay.replay(_late(sentiments(spark, sf_dir)),
                         lambda st: jobs.within_stream(st, PATTERN_WITHIN_MS, delay=f"{LATE_MS} milliseconds"),
                         "st_pattern_within_stream", key_cols=("customer_id", "customer_name"), arrival="arrival",
                         end_ms=LATE_MS + PATTERN_WITHIN_MS + DAY)


@query("j2_dedup_stream", f"SELECT * FROM ({M_SQL}) m")
def j2_dedup_stream(spark, sf_dir):
    """J2 over a topic that repeats a third of its records later on and brings every second customer's ten days late."""
    from moodwire.streaming import jobs, replay
    from moodwire.streaming.state import match_stream
    rows = sentiments(spark, sf_dir).withColumn("arrival", F.col("message_timestamp") + F.pmod(F.xxhash64("customer_id"), F.lit(2)) * 10 * DAY)
    again = rows.where(F.pmod(F.xxhash64("message_id"), F.lit(3)) == 0).withColumn("arrival", F.col("arrival") + 5 * DAY)
    return replay.replay(rows.unionByName(again), lambda st: match_stream(jobs.dedup_stream(st)), "j2_dedup_stream", key_cols=("customer_id", "customer_name"), arrival="arrival")


# ----------------------------------------- the three jobs over folder topics of JSON lines


def _topics(spark, sf_dir, jobs_to_run: int):
    """Messages as JSON lines in a folder topic, each fifth record cut short on top, and the first ``jobs_to_run`` of J1, J2, J3
    started by topic name. Before J2, a third of the scored records is in its topic twice. Returns (topics, table folder)."""
    from moodwire.sources import codec
    from moodwire.streaming import jobs, launch
    from moodwire.streaming.replay import scratch_path
    base = scratch_path(spark, "topics")
    topics = launch.Topics(root=f"{base}/topics")
    m = fixtures.messages(spark, sf_dir)
    lines = codec.encode_json(m.drop("kafka_timestamp"))
    broken = lines.where(F.pmod(F.xxhash64("value"), F.lit(5)) == 0).select(F.expr("substring(value, 1, length(value) - 2)").alias("value"))
    lines.unionByName(broken).write.text(f"{topics.root}/{jobs.TOPIC_MESSAGES}")

    def drain(query):
        query.processAllAvailable()
        query.stop()
    drain(launch.start_sentiment_job(spark, topics, f"{base}/c1", dense_scorer(), trigger=None))
    if jobs_to_run > 1:
        scored = f"{topics.root}/{jobs.TOPIC_SENTIMENTS}"
        again = spark.read.text(scored).where(F.pmod(F.xxhash64("value"), F.lit(3)) == 0)
        again.write.text(f"{base}/again")
        spark.read.text(f"{base}/again").write.mode("append").text(f"{base}/topics2/{jobs.TOPIC_SENTIMENTS}")
        spark.read.text(scored).write.mode("append").text(f"{base}/topics2/{jobs.TOPIC_SENTIMENTS}")
        topics = launch.Topics(root=f"{base}/topics2")
        drain(launch.start_escalation_job(spark, topics, f"{base}/c2", trigger=None))
    if jobs_to_run > 2:
        for q in launch.start_serving_ingest(spark, topics, f"{base}/tables", f"{base}/c3", trigger=None):
            q.awaitTermination()
    return topics, f"{base}/tables"


@query("src_messages", S + "SELECT message_id, customer_id, customer_name, message_timestamp, message_text, ip_country, sentiment_score, "
                           "sentiment_category, model_used, source_partition, source_offset FROM s")
def src_messages(spark, sf_dir):
    """J1 from the message topic to the topic of scored messages; records that do not parse are dropped."""
    from moodwire.sources import codec
    from moodwire.streaming import jobs
    topics, _ = _topics(spark, sf_dir, 1)
    return codec.decode_sentiments(spark.read.text(f"{topics.root}/{jobs.TOPIC_SENTIMENTS}")).drop("processing_timestamp")


@query("j3_topics", ORACLE["m_sentiments_by_country"])
def j3_topics(spark, sf_dir):
    """J1, J2 and J3 over topics; the ready-made metrics from the serving table that J3 filled, repeats removed."""
    from moodwire import schemas
    from moodwire.streaming import jobs, launch
    _, tables = _topics(spark, sf_dir, 3)
    path = f"{tables}/{launch.SERVING_TABLES[jobs.TOPIC_SENTIMENTS]}"
    return serving.metrics(spark.read.schema(schemas.SENTIMENTS_SERVING).parquet(path), _SM, by=["ip_country"], digits=DIGITS)


@query("st_chain", f"""SELECT customer_id, customer_name, karen_score_total, trigger_message_count, recent_messages FROM ({M_SQL}) m""")
def st_chain(spark, sf_dir):
    """The responses' serving table behind the three jobs: one row per escalation."""
    from moodwire import schemas
    from moodwire.streaming import jobs, launch
    _, tables = _topics(spark, sf_dir, 3)
    path = f"{tables}/{launch.SERVING_TABLES[jobs.TOPIC_RESPONSES]}"
    return spark.read.schema(schemas.ESCALATION_RESPONSES).parquet(path).select(
        "customer_id", "customer_name", "karen_score_total", "trigger_message_count", "recent_messages")


# ---------------------------------- data preparation: what must hold whatever the draws are


_POOL_SQL = """SELECT 'cust_' || lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS customer_id, c_acctbal < 0 AS is_karen FROM customer"""


@query("dp_expand_holds", f"""
SELECT customer_id, is_karen, true AS count_in_range, true AS seq_dense FROM ({_POOL_SQL}) p""")
def dp_expand_holds(spark, sf_dir):
    """Per user: the number of messages is in the range of its kind, and seq counts 1..n."""
    from moodwire.plans.dataprep import KAREN_MESSAGES, REGULAR_MESSAGES, expand_users
    rows = expand_users(_pool(spark, sf_dir))
    g = rows.groupBy("customer_id", "is_karen").agg(
        F.max("n_messages").alias("n"), F.min("n_messages").alias("n0"), F.count(F.lit(1)).alias("rows"),
        F.count_distinct("seq").alias("seqs"), F.min("seq").alias("lo"), F.max("seq").alias("hi"))
    in_range = F.when(F.col("is_karen"), F.col("n").between(*KAREN_MESSAGES)).otherwise(F.col("n").between(*REGULAR_MESSAGES))
    dense = ((F.col("n") == F.col("n0")) & (F.col("rows") == F.col("n")) & (F.col("seqs") == F.col("n"))
             & (F.col("lo") == 1) & (F.col("hi") == F.col("n")))
    return g.select("customer_id", "is_karen", in_range.alias("count_in_range"), dense.alias("seq_dense"))


@query("dp_pick_template_holds", f"""
SELECT customer_id, true AS types_own, true AS templates_of_type FROM ({_POOL_SQL}) p""")
def dp_pick_template_holds(spark, sf_dir):
    """Per user: every type is one of the user's, every template one of that type."""
    from moodwire.plans.dataprep import expand_users, pick_templates
    from moodwire.sources.pools import templates_from_conversations
    templates = templates_from_conversations(spark, sf_dir)
    picked = pick_templates(expand_users(_pool(spark, sf_dir)), templates)
    known = templates.select("type", "template").distinct().withColumn("known", F.lit(True))
    j = picked.join(known, ["type", "template"], "left")
    return j.groupBy("customer_id").agg(F.every(F.array_contains("sentiment_types", F.col("type"))).alias("types_own"),
                                        F.every(F.coalesce("known", F.lit(False))).alias("templates_of_type"))


@query("dp_build_message_holds", "SELECT true AS ids_distinct, true AS ids_shaped, true AS sessions_shaped, true AS agents_known, "
       "(SELECT count(*) FROM customer) AS customers")
def dp_build_message_holds(spark, sf_dir):
    """All message ids differ and look like UUIDs, sessions and agents have the declared forms, every user has messages."""
    from moodwire.plans.dataprep import USER_AGENTS, generate_messages
    from moodwire.sources.pools import templates_from_conversations
    m = generate_messages(_pool(spark, sf_dir), templates_from_conversations(spark, sf_dir), at_ms=F.lit(1_704_067_200_000))
    return m.agg((F.count_distinct("message_id") == F.count(F.lit(1))).alias("ids_distinct"),
                 F.every(F.col("message_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).alias("ids_shaped"),
                 F.every(F.col("metadata.session_id").rlike("^sess_[0-9a-f]{8}$")).alias("sessions_shaped"),
                 F.every(F.col("metadata.user_agent").isin(USER_AGENTS)).alias("agents_known"),
                 F.count_distinct("customer_id").alias("customers"))


@query("dp_upsample_holds", f"""
SELECT 2 * count(*) + 7 AS total, 2 * count(*) + 7 AS ids, count(*) AS originals, 0::BIGINT AS strangers FROM ({fixtures.MESSAGES_SQL}) m""")
def dp_upsample_holds(spark, sf_dir):
    """Exactly the target size, all ids differ, originals stay, and each copy's other columns are those of a source row."""
    from moodwire.plans.dataprep import upsample
    m = fixtures.messages(spark, sf_dir).drop("kafka_timestamp", "kafka_partition", "kafka_offset")
    out = upsample(m, target=2 * m.count() + 7)
    same = ["customer_id", "customer_name", "message_timestamp", "message_text"]
    source = m.select(*same, F.lit(True).alias("known")).distinct()
    ids = m.select("message_id", F.lit(True).alias("original"))
    eq = [out[c].eqNullSafe(source[c]) for c in same]
    j = out.join(source, eq, "left").join(ids, "message_id", "left")
    return j.agg(F.count(F.lit(1)).alias("total"), F.count_distinct("message_id").alias("ids"),
                 F.count("original").alias("originals"), F.count_if(F.col("known").isNull()).alias("strangers"))


@query("dp_replay_holds", f"""
SELECT 2 * count(*) AS records, count(DISTINCT message_id) AS keys, 2 * count(*) AS decoded, 2 * count(*) AS stamped FROM ({fixtures.MESSAGES_SQL}) m""")
def dp_replay_holds(spark, sf_dir):
    """Two loops give two records a message; every value decodes with its key as id and the replay's time."""
    from moodwire.plans.dataprep import keyed_records, replay
    from moodwire.sources.codec import decode_messages
    m = fixtures.messages(spark, sf_dir).drop("kafka_timestamp", "kafka_partition", "kafka_offset")
    rec = keyed_records(replay(m, loops=2, at_ms=F.lit(1_704_067_200_000)))
    d = decode_messages(rec, keep=["key"])
    return d.agg(F.count(F.lit(1)).alias("records"), F.count_distinct("key").alias("keys"),
                 F.count_if(F.col("message_id") == F.col("key")).alias("decoded"),
                 F.count_if(F.col("message_timestamp") == 1_704_067_200_000).alias("stamped"))
