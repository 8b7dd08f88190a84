"""SQL (DuckDB dialect) twins of the fixture-derived tables, for the oracle.

Each builder returns a SQL text for a derived relation; oracle queries use them
as CTEs so both sides compute from the same parquet tables.
"""

from __future__ import annotations

from moodwire.functions.scoring import DEFAULT_LEXICON, SPARSE_LEXICON
from moodwire.functions.text import CATEGORY_BOUNDS, CATEGORY_TOP
from moodwire.sources.fixtures import MESSAGES_SQL


def lexicon_sql(text: str, lexicon: dict[str, float]) -> str:
    cases = " ".join(f"WHEN '{w}' THEN {float(v)!r}" for w, v in sorted(lexicon.items()))
    words = f"regexp_split_to_array(lower({text}), '[^\\p{{L}}]+')"
    total = f"list_reduce(list_prepend(0.0::DOUBLE, list_transform({words}, lambda w: CASE w {cases} ELSE 0.0::DOUBLE END)), lambda a, b: a + b)"
    return f"greatest(-1.0::DOUBLE, least(1.0::DOUBLE, {total}))"


def category_sql(score: str) -> str:
    parts = " ".join(f"WHEN {score} <= {b!r} THEN '{lab}'" for b, lab in CATEGORY_BOUNDS)
    return f"CASE WHEN {score} IS NULL THEN NULL {parts} ELSE '{CATEGORY_TOP}' END"


def sentiments_sql(lexicon: dict[str, float] | None = None, model: str = "lexicon",
                   processed_at: str = "2024-02-01 00:00:00") -> str:
    lex = lexicon or DEFAULT_LEXICON
    score = lexicon_sql("m.message_text", lex)
    return f"""
SELECT message_id, customer_id, customer_name, message_timestamp, message_text, ip_country,
       sentiment_score, {category_sql('sentiment_score')} AS sentiment_category,
       '{model}' AS model_used, TIMESTAMP '{processed_at}' AS processing_timestamp,
       kafka_partition AS source_partition, kafka_offset AS source_offset
FROM (SELECT m.*, {score} AS sentiment_score FROM ({MESSAGES_SQL}) m
      WHERE m.message_text IS NOT NULL AND length(trim(m.message_text)) > 0) s
"""


DENSE_SQL = sentiments_sql(DEFAULT_LEXICON, "lexicon")
SPARSE_SQL = sentiments_sql(SPARSE_LEXICON, "lexicon_sparse")


SEP_SQL = "' \\n '"  # the four characters space, backslash, n, space


def pattern_sql(sentiments: str, threshold: float = -5.0) -> str:
    """Row-pattern matches as a recursive fold over row_number() per key.

    The in-order DOUBLE sum of a match decides and is its total."""
    thr = f"{float(threshold)!r}::DOUBLE"
    start = f"(x IS NOT NULL AND x > {thr})"
    r_start = f"(r.x IS NOT NULL AND r.x > {thr})"
    close = f"(f.st_n > 0 AND r.x IS NOT NULL AND f.st_sum + r.x <= {thr})"
    return f"""
WITH RECURSIVE r AS (
  SELECT customer_id, customer_name, CAST(sentiment_score AS DOUBLE) AS x, message_text AS txt,
         message_timestamp AS ts,
         row_number() OVER (PARTITION BY customer_id, customer_name
                            ORDER BY message_timestamp, source_partition, source_offset) AS rn
  FROM ({sentiments}) src
),
f AS (
  SELECT customer_id, customer_name, rn,
         CASE WHEN {start} THEN x ELSE 0.0::DOUBLE END AS st_sum,
         CASE WHEN {start} THEN 1 ELSE 0 END AS st_n,
         CASE WHEN {start} THEN txt END AS st_txt,
         CAST(NULL AS DOUBLE) AS e_total, CAST(NULL AS BIGINT) AS e_n,
         CAST(NULL AS VARCHAR) AS e_txt, CAST(NULL AS BIGINT) AS e_ts
  FROM r WHERE rn = 1
  UNION ALL
  SELECT r.customer_id, r.customer_name, r.rn,
         CASE WHEN f.st_n = 0 THEN (CASE WHEN {r_start} THEN r.x ELSE 0.0 END)
              WHEN {close} THEN 0.0
              ELSE f.st_sum + coalesce(r.x, 0.0) END,
         CASE WHEN f.st_n = 0 THEN (CASE WHEN {r_start} THEN 1 ELSE 0 END)
              WHEN {close} THEN 0
              ELSE f.st_n + 1 END,
         CASE WHEN f.st_n = 0 THEN (CASE WHEN {r_start} THEN r.txt END)
              WHEN {close} THEN NULL
              WHEN f.st_txt IS NULL THEN r.txt
              WHEN r.txt IS NULL THEN f.st_txt
              ELSE f.st_txt || {SEP_SQL} || r.txt END,
         CASE WHEN {close} THEN f.st_sum + r.x END,
         CASE WHEN {close} THEN f.st_n + 1 END,
         CASE WHEN {close} THEN f.st_txt || {SEP_SQL} || r.txt END,
         CASE WHEN {close} THEN r.ts END
  FROM f JOIN r ON r.customer_id IS NOT DISTINCT FROM f.customer_id
               AND r.customer_name IS NOT DISTINCT FROM f.customer_name AND r.rn = f.rn + 1
)
SELECT customer_id, customer_name, e_total AS karen_score_total, e_n AS trigger_message_count,
       e_txt AS recent_messages, e_ts AS trigger_order
FROM f WHERE e_total IS NOT NULL
"""


def pattern_within_sql(sentiments: str, within_ms: int, threshold: float = -5.0) -> str:
    """Time-bounded matches: every start is followed row by row to its close, then starts are taken in turn.

    Sums are exact decimals of nine places."""
    thr = f"{threshold}::DECIMAL(38, 9)"
    same = "{0}.customer_id IS NOT DISTINCT FROM {1}.customer_id AND {0}.customer_name IS NOT DISTINCT FROM {1}.customer_name"
    return f"""
WITH RECURSIVE r AS MATERIALIZED (
  SELECT customer_id, customer_name, CAST(sentiment_score AS DECIMAL(38, 9)) AS x, message_text AS txt, message_timestamp AS ts,
         row_number() OVER (PARTITION BY customer_id, customer_name
                            ORDER BY message_timestamp, source_partition, source_offset) AS rn
  FROM ({sentiments}) src
),
f AS (
  SELECT customer_id, customer_name, rn AS s, ts AS s_ts, rn AS j, x AS total, false AS closed FROM r WHERE x > {thr}
  UNION ALL
  SELECT f.customer_id, f.customer_name, f.s, f.s_ts, r.rn, f.total + coalesce(r.x, 0), r.x IS NOT NULL AND f.total + r.x <= {thr}
  FROM f JOIN r ON {same.format("r", "f")} AND r.rn = f.j + 1 AND r.ts - f.s_ts < {within_ms}
  WHERE NOT f.closed
),
c AS MATERIALIZED (SELECT customer_id, customer_name, s, j AS e, total FROM f WHERE closed),
n AS MATERIALIZED (
  SELECT a.customer_id, a.customer_name, a.s, a.e, a.total, min(b.s) AS nxt
  FROM c a LEFT JOIN c b ON {same.format("a", "b")} AND b.s > a.e GROUP BY ALL),
p AS (
  SELECT n.* FROM n JOIN (SELECT customer_id, customer_name, min(s) AS s FROM c GROUP BY ALL) m ON {same.format("n", "m")} AND n.s = m.s
  UNION ALL
  SELECT n.* FROM p JOIN n ON {same.format("n", "p")} AND n.s = p.nxt
)
SELECT p.customer_id, p.customer_name, CAST(p.total AS DOUBLE) AS karen_score_total, p.e - p.s + 1 AS trigger_message_count,
       string_agg(r.txt, {SEP_SQL} ORDER BY r.rn) FILTER (r.rn < p.e) || {SEP_SQL} || max(r.txt) FILTER (r.rn = p.e) AS recent_messages,
       max(r.ts) FILTER (r.rn = p.e) AS trigger_order
FROM p JOIN r ON {same.format("r", "p")} AND r.rn BETWEEN p.s AND p.e
GROUP BY p.customer_id, p.customer_name, p.s, p.e, p.total
"""


def response_prompt_sql(name: str, total: str, messages: str) -> str:
    from moodwire.functions.text import RESPONSE_PROMPT_MESSAGE_CHARS as n, RESPONSE_PROMPT_PARTS as p
    q = [x.replace("'", "''") for x in p]
    return (f"'{q[0]}' || {name} || '{q[1]}' || CAST({total} AS VARCHAR) || '{q[2]}' || "
            f"substring({messages}, 1, {n}) || '{q[3]}' || '{q[4]}'")


def responses_sql(sentiments: str, model: str = "gpt-4o") -> str:
    from moodwire.functions.generation import OTHER_FAILURE_TEXT
    return f"""
SELECT customer_id, customer_name, karen_score_total,
       '{OTHER_FAILURE_TEXT}' AS rebuttal_text, '{model}' AS rebuttal_model,
       trigger_order AS generated_timestamp, trigger_message_count, recent_messages
FROM ({pattern_sql(sentiments)}) m
"""
