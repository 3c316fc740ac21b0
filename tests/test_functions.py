import datetime
import re
import sys

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from portledger.functions import classify, text


def test_whitespace_is_what_python_strips():
    assert len(text.WHITESPACE) == 29
    assert all(c.isspace() for c in text.WHITESPACE)


def test_safe_str_strips_every_kind_of_white_space(one):
    padded = [w + "a b" + w for w in text.WHITESPACE] + [" 　 a b \t ", None, "", "  ", "　"]
    got = one(lambda d: [text.safe_str("v")], padded)
    assert got == [(v or "").strip() for v in padded]


def _int(v):
    try:
        return int(v or 0)
    except ValueError:
        return None


def test_lenient_int_reads_what_int_reads(one):
    values = ["2020", " 2020 ", "\t7\n", "+5", "-5", "", None, "  ", "2020.0", "1_000", "1__0", "_1", "1_", "abc",
              "15/0", "２０２０", "٣", "1 2", "0", "007", "99999999999", "　2020", "+", "-", "1e3"]
    assert one(lambda d: [text.lenient_int("v")], values) == [_int(v) for v in values]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet="0123456789+-_ ./a　\t５", max_size=6), min_size=150, max_size=150))
def test_lenient_int_property(one_spark, values):
    got = one_spark(values)
    assert got == [_int(v) for v in values]


import pytest  # noqa: E402


@pytest.fixture(scope="module")
def one_spark(spark):
    def run(values):
        df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
        return [r[1] for r in df.select("i", text.lenient_int("v")).orderBy("i").collect()]

    return run


def test_weekly_date(one):
    cases = {
        "20260515": "2026-05-15", " 20260515 ": "2026-05-15", "2026-05-15": "2026-05-15", "-": "", " - ": "",
        "": "", None: "", "20261399": "2026-13-99", "2026.05.15": "2026.05.15", "202605151": "202605151",
        "15/05/1996": "15/05/1996", "　20260515": "2026-05-15",
    }
    assert one(lambda d: [text.weekly_date("v")], list(cases)) == list(cases.values())


def test_historical_date_keeps_compact_text(one):
    assert one(lambda d: [text.historical_date("v")], ["20260515", " - ", " 2020-01-15 ", None]) == [
        "20260515", "", "2020-01-15", ""]


def test_true_date_cell_goes_before_the_text_rule(one):
    rule = lambda d: [text.weekly_date("v", F.col("is_date")), text.historical_date("v", F.col("is_date"))]
    rows = [("2020-01-15 00:00:00", True), ("2020-01-15 00:00:00", False)]
    assert one(rule, rows, "v string, is_date boolean") == [
        ("2020-01-15", "2020-01-15"),
        ("2020-01-15 00:00:00", "2020-01-15 00:00:00"),
    ]


def test_date_parts_need_ten_characters(one):
    rule = lambda d: [c.alias(n) for n, c in text.date_parts("v").items()]
    assert one(rule, ["2026-05-15", "15/05/1996", "20260515", "", "한국어열글자입니다요"]) == [
        ("2026", "05", "15"), ("15/0", "/1", "96"), ("", "", ""), ("", "", ""), ("한국어열", "자입", "다요"),
    ]


def test_typed_siblings(one):
    rule = lambda d: [text.decimal_value("v").cast("double"), text.date_value("v")]
    assert one(rule, ["500", "N/A", "2026-05-15", "2026-13-99", " 1.5 "]) == [
        (500.0, None), (None, None), (None, datetime.date(2026, 5, 15)), (None, None), (1.5, None),
    ]


def _flags(one, rule, values, schema="v string"):
    names = {(True, False, False): "frozen", (False, True, False): "dried", (False, False, True): "ambiguous"}
    return [names[t] for t in one(lambda d: list(rule().values()), values, schema)]


def test_weekly_type(one):
    cases = {
        "생녹용(냉동)": "frozen", "냉동": "frozen", "건녹용(냉동)": "frozen", "녹용(건조)": "dried", "건녹용": "dried",
        "수건": "dried", "녹용": "ambiguous", "건강식품": "ambiguous", "냉동건조": "ambiguous", "": "ambiguous",
        "건강건": "ambiguous", None: "ambiguous", "건강식품(건조)": "dried",
    }
    assert _flags(one, lambda: classify.weekly_type_flags("v"), list(cases)) == list(cases.values())


def test_historical_type(one):
    cases = {
        ("생녹용(냉동)", ""): "frozen", ("건녹용(냉동)", ""): "ambiguous", ("수건", ""): "ambiguous",
        ("건녹용", "Frozen"): "dried", ("건강식품", ""): "ambiguous", ("", "FROZEN velvet"): "frozen",
        ("  ", "Dried"): "dried", (None, "frozen dried"): "ambiguous", ("", ""): "ambiguous",
        ("녹용", "dried"): "ambiguous", (None, None): "ambiguous",
    }
    rule = lambda: classify.historical_type_flags("ko", "en")
    assert _flags(one, rule, list(cases), "ko string, en string") == list(cases.values())


def test_product_predicates(one):
    rule = lambda d: [classify.is_frozen_product("v"), classify.is_dried_product("v")]
    cases = {
        "녹용": (False, True), "생녹용": (True, False), "녹용(건조)": (False, True), "냉동 녹용": (True, False),
        "냉동건조": (True, True), "인삼": (False, False), "생 녹용": (False, False),
    }
    assert one(rule, list(cases)) == list(cases.values())


def test_type_label_defaults_to_ambiguous(one):
    rule = lambda d: [classify.type_label("f", "d")]
    rows = [(True, True), (False, True), (False, False), (None, None)]
    assert one(rule, rows, "f boolean, d boolean") == ["frozen", "dried", "ambiguous", "ambiguous"]


def test_country_bucket(one):
    rule = lambda d: [classify.country_bucket("en", "ko")]
    cases = {
        ("New Zealand", ""): "NZ", ("", "뉴질랜드"): "NZ", ("Russian Federation", ""): "Russia", ("", "러시아 연방"): "Russia",
        ("China", None): "China", (None, "중국"): "China", ("china", ""): "Other", ("", ""): "Other",
        ("China", "뉴질랜드"): "NZ", (None, None): "Other",
    }
    assert one(rule, list(cases), "en string, ko string") == list(cases.values())


def test_keywords_and_buckets_are_parameters(one):
    rule = lambda d: [classify.country_bucket("v", F.lit(""), {"Fiji": ("Fiji", "피지")}, "Rest")]
    assert one(rule, ["Fiji", "China"]) == ["Fiji", "Rest"]


def test_rules_mention_their_input_few_times(spark):
    # Rules are built on rules; one that repeats its input multiplies the plan at every level.
    df = spark.createDataFrame([("",)], "v string")
    plan = df.select(text.lenient_int(text.weekly_date("v")))._jdf.queryExecution().analyzed().toString()
    assert len(re.findall(r"\bv#\d+", plan)) <= 8


def test_unicode_digit_table_is_aligned():
    assert len(text._DIGITS_FROM) == len(text._DIGITS_TO)
    assert all(int(a) == int(b) for a, b in zip(text._DIGITS_FROM, text._DIGITS_TO))
    assert sys.maxunicode > 0xFFFF
