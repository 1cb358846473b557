"""Golden values of the scalar operators."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from siltstone import vocab
from siltstone.functions import keys, numbers, text, times


def run(spark, values, make, kind="string"):
    """Results of the expression for each value, in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v")).alias("out")).collect()]


def test_blank_to_null(spark):
    words = ["UNKNOWN", " N/A ", "unknown", "", "  ", "--", "value", None]
    assert run(spark, words, text.blank_to_null) == [None, None, "unknown", None, None, None, "value", None]
    assert run(spark, [" N/A ", "N/A"], lambda c: text.blank_to_null(c, trim=False)) == [" N/A ", None]


def test_strip_control(spark):
    assert run(spark, ["  John  \t", "a\r\nb", None], text.strip_control) == ["John", "ab", None]


def test_casing(spark):
    assert run(spark, ["  aNNa lee "], text.title_trim) == ["Anna Lee"]
    assert run(spark, ["Credit  Card", "credit_card", "CREDIT _CARD"], text.snake_category) == ["credit_card"] * 3


def test_sku_simple(spark):
    assert run(spark, [" sku_ab 12 "], text.sku_simple) == ["SKU-AB-12"]


def test_sku_canonical(spark):
    codes = ["SKU-AB1234CD", "SKUAB1234CD", "sku_ab1234cd", "SKU-AB1234CD-VN", "AB1234CD", "SKU-AB1234CD-HCM", "", None, "--"]
    out = [tuple(r) for r in run(spark, codes, text.sku_canonical)]
    good = "SKU-AB1234CD"
    assert out == [(good, False)] + [(good, True)] * 5 + [("", False), ("", False), ("--", False)]


def test_phone(spark):
    assert run(spark, ["0" + "1234567890" * 3], text.phone_truncate) == ["01234567890123456789"]


def test_enum(spark):
    assert run(spark, [" pending", "PANDING", None], lambda c: text.enum_or_null(c, vocab.ORDER_STATUSES)) == ["PENDING", None, None]


def test_typos(spark):
    assert run(spark, [*vocab.STATUS_TYPOS, " Other "], text.fix_typos) == [*vocab.STATUS_TYPOS.values(), "other"]


def test_nearest_word(spark):
    valid = ["pending", "processing", "shipped", "delivered", "cancelled"]
    typos = ["PANDING", "PROCCESSING", "SHIPED", "DELIVERD", "CANCLED", "bitcoin", None]
    assert run(spark, typos, lambda c: text.nearest_word(c, valid, 2)) == [*valid, None, None]
    assert run(spark, ["aX"], lambda c: text.nearest_word(c, ["ab", "ac"], 2)) == ["ab"]  # first listed wins


def test_email(spark):
    assert run(spark, [" A@b.co ", "annagmail.com", "a b@c.de", "a@b"], text.is_email) == [True, False, False, False]


def test_text_defects(spark):
    assert run(spark, ["WELCO...", "SPRIING", "abc"], text.looks_truncated) == [True, False, False]
    assert run(spark, ["SPRIING", "spring"], text.has_doubled_vowel) == [True, False]
    assert run(spark, ["SALE", "Sale", "123"], text.is_shouting) == [True, False, False]


def test_clean_number(spark):
    given = ["$100.50", "1,234.56", "100.00USD", "-5", "1e3", "abc", "NaN", "Inf", "-Infinity", "#REF!", "1d", "DAS", "", None]
    assert run(spark, given, numbers.clean_number) == [100.5, 1234.56, 100.0, -5.0, 1000.0] + [None] * 9


def test_numeric_or_null(spark):
    assert run(spark, ["-12.", "12.5", "$1", "1e3"], numbers.numeric_or_null) == [-12.0, 12.5, None, None]


def test_money_and_ranges(spark):
    assert [str(v) for v in run(spark, ["10.005", "x", None], numbers.to_money)] == ["10.01", "None", "None"]
    assert run(spark, [-1, 0, 6, 10, 99, 3], lambda c: numbers.in_range(c, 1, 5), "int") == [None] * 5 + [3]
    assert run(spark, [-2.0, 0.0, 3.0], numbers.non_negative, "double") == [None, None, 3.0]
    assert run(spark, [-2.0, 0.0], lambda c: numbers.non_negative(c, "abs"), "double") == [2.0, 0.0]
    with pytest.raises(ValueError):
        numbers.non_negative(F.lit(1), "zero")


def test_to_bool(spark):
    assert run(spark, ["true", " FALSE ", "--", None], numbers.to_bool) == [True, False, None, None]


DATE_SHAPES = ["2024-06-25", "25/06/2024", "06-25-2024", "25.06.2024", "Jun 25, 2024", " 2024-06-25 "]


def test_dates(spark):
    assert run(spark, DATE_SHAPES, times.parse_date_formats) == [datetime(2024, 6, 25)] * len(DATE_SHAPES)
    # A date the old calendar's parser would take must not raise either.
    bad = ["00/00/0000", "2024-13-45", "not a date", "2024-1-5", "", None]
    assert run(spark, bad, times.parse_date_formats) == [None] * len(bad)
    assert run(spark, ["1737787974"], times.parse_date_formats) == [datetime(2025, 1, 25, 6, 52, 54)]
    assert run(spark, ["1737787974"], lambda c: times.parse_date_formats(c, epoch=False)) == [None]


def test_mixed_ts(spark):
    given = ["2024-06-25 10:11:12", "1737787974", "99999999999999999999999", "2024-06-25"]
    assert run(spark, given, times.parse_mixed_ts) == [datetime(2024, 6, 25, 10, 11, 12), datetime(2025, 1, 25, 6, 52, 54), None, None]


def test_epochs(spark):
    assert run(spark, [1500], times.epoch_to_ts, "bigint") == [datetime(1970, 1, 1, 0, 0, 1, 500000)]
    assert run(spark, [1], lambda c: times.epoch_to_ts(c, "d"), "bigint") == [date(1970, 1, 2)]
    assert run(spark, ["2024-01-02T03:04:05.678901", "x"], times.iso_ts) == [datetime(2024, 1, 2, 3, 4, 5, 678901), None]


def test_elapsed(spark):
    out = run(spark, ["2024-01-02 12:00:00"], lambda c: times.elapsed_days(F.lit("2024-01-01").cast("timestamp"), c.cast("timestamp")))
    assert math.isclose(out[0], 1.5)


def test_surrogate_key(spark):
    made = {s: run(spark, [123], lambda c, s=s: keys.surrogate_key(s, c), "bigint")[0] for s in ("erp", "payment_gw", "warehouse")}
    assert made["erp"] == "2476910c0b3a725278152e2567f7fba6"
    assert len(set(made.values())) == 3
