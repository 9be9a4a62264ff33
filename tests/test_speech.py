import pytest
from pyspark.sql import functions as F

from sonalyze.functions import speech as S

NORMALIZED = {
    "1万亿": "10000100000000", "1亿万": "10000000010000", "007万": "70000", "0万": "0", "14亿": "1400000000", "5千万": "510000000", "1.4亿": "1400000000",
    "一千四百万到两千万种": "14000000到20000000种", "1400万到2000万种": "14000000到20000000种", "哇，这棵树自己就是一片森林？": "哇这棵树自己就是1片森林",
    "先听一个数字。<#0.25#>": "先听1个数字", "（笑）二零二六年 Ab": "6年ab", "12345678901234567890万": "123456789012345678900000", "１２万": "120000",
    "(a\nb)x（未闭": "x未闭", "é!ß": "", "": "", "<#3#>": "", "(un": "un",
}
NUMBERS = {"二零二六": 6, "十": 10, "零万": 10000, "一万亿": 100010000, "一千四百万": 14000000, "两千万": 20000000, "万一": 10001, "三千零五": 3005, "一亿二千万": 120000000}


def column(spark, values, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string").select("i", f(F.col("x")).alias("y")).orderBy("i").collect()
    return [r.y for r in rows]


def test_normalize(spark):
    assert column(spark, NORMALIZED, S.normalize) == list(NORMALIZED.values())


def test_chinese_numbers(spark):
    assert column(spark, NUMBERS, S.chinese_number) == list(NUMBERS.values())


def test_tags(spark):
    raw = ["<|zh|><|Happy|><|Speech|><|withitn|>等等，差这么多？", "　\x1c x <|en|> y \n", "", "a<|b|>c<|d|>", "<|a|b|>"]
    got = [tuple(r) for r in column(spark, raw, S.tags)]
    assert got == [("zh", "HAPPY", "Speech", "withitn", "等等，差这么多？"), ("en", None, None, None, "x  y"), (None, None, None, None, ""), ("b", "D", None, None, "ac"), (None, None, None, None, "<|a|b|>")]


@pytest.mark.parametrize("expected, actual, rate", [
    ("先听一个数字。<#0.25#>", "先听一个数字", 0.0), ("一千四百万到两千万种", "1400万到2000万种", 0.0), ("", "", 0.0), ("。", "x", 1.0), ("abcdefghij", "abcdefghiX", 0.1),
    ("ab", "xyzuvw", 3.0), ("你好世界", "你好", 0.5), ("A", "a", 0.0),
])
def test_error_rate(spark, expected, actual, rate):
    df = spark.createDataFrame([(expected, actual)], "a string, b string")
    assert df.select(S.character_error_rate(F.col("a"), F.col("b"))).first()[0] == pytest.approx(rate, abs=0)


def test_rounding(spark):
    df = spark.createDataFrame([(1 / 32,), (1 / 160,), (None,), (1 / 3,), (1234.5,)], "x double")
    assert [r[0] for r in df.select(S.rounded(F.col("x"))).collect()] == [0.0312, 0.0063, None, 0.3333, 1234.5]


def test_emotions_and_advice(spark):
    assert column(spark, ["HAPPY", "fearful", "Calm", "odd", "", None], S.expected_emotions) == [["HAPPY", "SURPRISED"], ["ANGRY", "FEARFUL", "SAD"], ["CALM", "NEUTRAL"], [], [], []]
    df = spark.createDataFrame([(["emotion_mismatch", "asr_mismatch"],), (["missing_audio"],), ([],)], "f array<string>")
    assert [r[0] for r in df.select(S.suggested_actions(F.col("f"))).collect()] == [list(S.ADVICE.values()), [], []]


def test_pauses_of_other_digits(spark):
    df = spark.createDataFrame([("a<#1１#>b<#０.５#>c<#x#>",)], "t string")
    assert df.select(S.normalize(F.col("t"))).first()[0] == "abcx"
