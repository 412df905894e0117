import math
import random

from pyspark.sql import functions as F

from pagespine.functions import text as T
from pagespine.functions.numbers import round_half_even


def evaluate(spark, make, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.out for r in rows.select("i", make(F.col("text")).alias("out")).orderBy("i").collect()]


def check(spark, make, expected):
    assert dict(zip(expected, evaluate(spark, make, list(expected)))) == expected


def test_strip_and_words(spark):
    texts = ["  a b ", " x　", "\x1ca\x1f", "\n\t", "", "a b\n c", "a\x1db"]
    assert evaluate(spark, T.strip, texts) == [t.strip() for t in texts]
    assert evaluate(spark, T.word_count, texts) == [len(t.split()) for t in texts]


def test_strip_removes_all_that_python_removes(spark):
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    assert evaluate(spark, T.strip, [f"{c}a{c}" for c in spaces]) == ["a"] * len(spaces)
    assert evaluate(spark, T.word_count, [f"a{c}b" for c in spaces]) == [2] * len(spaces)
    other = [c for c in map(chr, range(1, 0x3100)) if not c.isspace() and not 0xD800 <= ord(c) < 0xE000]
    assert evaluate(spark, T.strip, other) == other


def test_first_word(spark):
    check(spark, T.first_word, {
        "Introduction: of": "introduction", "• Overview": "", "•Overview x": "overview", "**Appendix** A": "appendix",
        "OVERVIEW\nx": "overview\nx", "a": "a",
    })
    check(spark, T.starts_with_keyword, {"Appendix: A": True, "Appendices": False, "methodology": True, "An overview": False})


def test_page_number(spark):
    check(spark, T.is_page_number, {
        "Page 3": True, "pg. 12 of 40": True, "PG 1": True, "page 3 of 9": True, "page ３": True,
        "Page three": False, "see page 3": False, "page 3 and": False, "page3": False,
    })


def test_mostly_punctuation(spark):
    check(spark, T.is_mostly_punctuation, {
        "------": True, "-----": False, "----!!a": True, "---aaa": False, "«»…!?—": True, "$$$$$$": False, "....a": False, "........aa": True,
    })


def test_symbols_and_digits(spark):
    check(spark, T.is_only_symbols_or_digits, {
        "(3.14) - 2/7": True, "12:30\n4": True, "12a": False, "": False, "１ 2": True, "1,2": False, "1\x1c2": True,
    })


def test_date(spark):
    check(spark, T.is_date, {
        "Market Overview": True, "DECISION": True, "on 3/4/21": True, "12-03-2021": True, "Ma rch": False, "unmarried": False,
        "Mar1": False, "März": False, "1/2/3": False, "123/04/2021": False, "émar": False, "Augré": False, "x_may": False,
    })


def test_contents_entry(spark):
    check(spark, T.is_contents_entry, {
        "Scope ........ 7": True, "Scope\n....\n7": True, "Scope .. 7": False, "Scope ... seven": False,
        "Chapter 1 ... 7 pages": True, "chapter one\n... 7 p": False, "2.1 Text ... 9a": True, "Just 7": False, "Chapter\r1 ... 7 x": True,
    })


def test_citation(spark):
    check(spark, T.is_citation, {
        "[ABC-Web]": True, "[1] text": True, "[Smith et al., 2021]": True, "[Smith 21]": False, "[]": False, "see [1]": False,
        "[1": False, "[Smith\n2021]": False, "[１]": True,
    })


def test_heading_start(spark):
    check(spark, T.is_valid_heading_start, {"Title": True, "title": False, "1. title": False, "1.2": True, "日本": True, "ét": False, "ǅx": True, "": True})


def test_numbering(spark):
    check(spark, T.numbering_level, {
        "1 A": "H1", "1.2 A": "H2", "1.2.3 A": "H3", "1.2.3.4 A": None, "1. A": None, "2024 report": "H1", "1.2": None,
        "１ A": "H1", "1\nA": "H1", "A 1": None,
    })


def test_case_and_alnum_follow_python(spark):
    texts = ["ABC 1", "Abc", "123", "", "ǅ", "ÉÀ", "Aß", "日本", "Aǅ", "Ⅰ", "Ⓐ"]
    assert evaluate(spark, T.is_upper, texts) == [t.isupper() for t in texts]
    texts = ["abc1", "a b", "", "1.", "日本", "²", "½", "a_", "-", "é"]
    assert evaluate(spark, T.is_alnum, texts) == [t.isalnum() for t in texts]


def test_round_follows_binary_value(spark):
    random.seed(7)
    values = [2.675, 0.125, 0.375, 1.005, 70.865, 0.29, -2.675, -0.125, 1e6 + 0.005, 0.0, 612.0, 99.995]
    values += [random.uniform(-2000, 2000) for _ in range(3000)]
    values += [random.randrange(0, 10**6) / 1000 for _ in range(3000)] + [random.randrange(0, 10**6) / 64 for _ in range(1000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    for digits in (2, 3):
        got = [r.out for r in df.select("i", round_half_even(F.col("v"), digits).alias("out")).orderBy("i").collect()]
        wrong = [(v, g) for v, g in zip(values, got) if not math.isclose(g, round(v, digits), abs_tol=1e-12)]
        assert wrong == []
