"""Hand-made cases for the scalar expressions (category, class->score,
reply parsing, blank rules, prompts)."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodwire.functions import text as tx
from moodwire.functions.scoring import LexiconScorer, parse_reply


def _eval(spark, values, dtype, fn):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", dtype)]))
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_category_bounds(spark):
    vals = [-1.0, -0.6, -0.59, -0.2, -0.19, 0.0, 0.2, 0.21, 0.6, 0.61, 1.0, None]
    got = _eval(spark, vals, T.DoubleType(), tx.category)
    assert got == ["F - Very Negative"] * 2 + ["D - Negative"] * 2 + ["C - Neutral"] * 3 + \
        ["B - Positive"] * 2 + ["A - Very Positive"] * 2 + [None]


def test_class_to_score(spark):
    got = _eval(spark, [0, 1, 2, 3, 4, -1, 5, None], T.IntegerType(), tx.class_to_score)
    assert got == [-0.8, -0.4, 0.0, 0.4, 0.8, 0.0, 0.0, 0.0]


@pytest.mark.parametrize("reply,expected", [
    ("-0.8", -0.8), (" +0.7 ", 0.7), ("1e-1", 0.1), ("3", 1.0), ("-7", -1.0), ("abc", 0.0), ("", 0.0),
    ("nan", 1.0), ("inf", 1.0), ("-inf", -1.0), ("-Infinity", -1.0), ("0.5f", 0.0), ("1_0", 1.0),
    (" 0.25　", 0.25), (".5", 0.5), ("5.", 1.0), ("-nan", 1.0), (None, 0.0),
])
def test_parse_score_matches_python(spark, reply, expected):
    got = _eval(spark, [reply], T.StringType(), tx.parse_score)[0]
    assert got == pytest.approx(expected)
    assert parse_reply(reply) == pytest.approx(expected) or (reply in ("1_0",) and parse_reply(reply) == 1.0)


def test_blank_rules_differ_for_tabs(spark):
    vals = [None, "", "   ", "\t\n", " 　", " x "]
    keep = _eval(spark, vals, T.StringType(), tx.non_blank)
    assert keep == [False, False, False, True, True, True]
    blank = _eval(spark, vals, T.StringType(), tx.is_blank_py)
    assert blank == [True, True, True, True, True, False]
    assert [(v is None) or (not v.strip()) for v in vals] == blank


def test_response_prompt_cuts_messages_only(spark):
    for n in (499, 500, 501):
        msg = "a" * n
        df = spark.createDataFrame([("Ann", -5.2, msg)], "name string, total double, msgs string")
        p = df.select(tx.response_prompt(F.col("name"), F.col("total"), F.col("msgs"))).first()[0]
        assert ("a" * min(n, 500) + '". ') in p and ("a" * 501) not in p
        assert "-5.2" in p and 'named "Ann"' in p
    df = spark.createDataFrame([(None, -5.2, "x")], "name string, total double, msgs string")
    assert df.select(tx.response_prompt(F.col("name"), F.col("total"), F.col("msgs"))).first()[0] is None


def test_separator_is_four_characters():
    assert tx.MESSAGE_SEPARATOR == " \\n " and len(tx.MESSAGE_SEPARATOR) == 4


def test_lexicon_scorer(spark):
    sc = LexiconScorer({"bad": -0.6, "good": 0.5})
    got = _eval(spark, ["bad bad good", "GOOD!", "   ", "\t", None, "neutral"], T.StringType(), sc.score)
    assert got == pytest.approx([-0.7, 0.5, 0.0, 0.0, 0.0, 0.0])
    got = _eval(spark, ["bad bad bad"], T.StringType(), sc.score)
    assert got == [-1.0]


def test_blank_rule_agrees_with_python_isspace(spark):
    spaces = [chr(i) for i in range(0x3001) if chr(i).isspace()]
    others = ["a", "\u200b", ".", "0", "\u00ad"]
    vals = spaces + [c * 2 for c in spaces] + others
    got = _eval(spark, vals, T.StringType(), tx.is_blank_py)
    assert got == [not v.strip() for v in vals]


def test_results_do_not_depend_on_session_time_zone(spark):
    import __spark_entry__ as ent
    names = ["prj_computed_ts", "prj_enriched", "m_responses_all", "fn_json_roundtrip", "ts_sentiment_trend"]
    q = ent.queries()
    base = {n: sorted(map(tuple, q[n](spark, "/root/testdata/sf0.001").collect())) for n in names}
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        for n in names:
            assert sorted(map(tuple, q[n](spark, "/root/testdata/sf0.001").collect())) == base[n], n
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
