import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hammerprice.functions.bands import band, band_ordinal
from hammerprice.functions.dates import age_in_years, days_since, days_until, previous_month
from hammerprice.functions.parsing import (
    json_text,
    to_bigint,
    to_bigint_strict,
    to_double,
    to_double_strict,
    to_month,
    to_month_or_null,
)
from hammerprice.functions.text import collapse_variants, last_two, title_case, upper_bound_of_range
from hammerprice.schemas import DOMAINS


def one(spark, value, column, type_name="string"):
    return spark.createDataFrame([(value,)], f"x {type_name}").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("250000", 250000.0), ("44.0", 44.0), (" 5 ", 5.0), ("1e3", 1000.0), ("+7", 7.0), (".5", 0.5), ("inf", float("inf")),
        ("n/a", None), ("", None), ("nan", None), ("1d", None), ("2F", None), ("0x10", None), ("0x1p3", None),
        ("1,000", None), ("1_000", None), (None, None),
    ],
)
def test_to_double(spark, text, expected):
    assert one(spark, text, to_double) == expected


@pytest.mark.parametrize("text, expected", [("1984", 1984), ("2e3", 2000), ("1984.0", 1984), ("x", None), (None, None)])
def test_to_bigint(spark, text, expected):
    assert one(spark, text, to_bigint) == expected


def test_strict_cast_stops(spark):
    assert one(spark, "44.0", to_double_strict) == 44.0
    with pytest.raises(PySparkException):
        one(spark, "n/a", to_double_strict)


@pytest.mark.parametrize("text", ["2023-08", "2023-8"])
def test_month(spark, text):
    assert one(spark, text, to_month) == dt.date(2023, 8, 1)


@pytest.mark.parametrize("text", ["2023-08-01", "2023/08", "x"])
def test_bad_month_stops(spark, text):
    with pytest.raises(PySparkException):
        one(spark, text, to_month)
    assert one(spark, text, to_month_or_null) is None


def test_null_month(spark):
    assert one(spark, None, to_month) is None


def test_dates(spark):
    month = dt.date(2023, 8, 1)
    assert one(spark, month, lambda c: age_in_years(c, F.lit(1984)), "date") == 39
    assert one(spark, month, days_since, "date") == 4170
    assert one(spark, dt.date(2025, 3, 31), previous_month, "date") == dt.date(2025, 2, 28)
    assert one(spark, month, lambda c: days_until(dt.date(2012, 3, 11)), "date") == 10


@pytest.mark.parametrize(
    "storey, label, open_label",
    [
        (0, None, "1-15"), (1, "1-15", "1-15"), (15, "1-15", "1-15"), (16, "16-30", "16-30"), (30, "16-30", "16-30"),
        (31, "31+", "31+"), (99, "31+", "31+"), (100, None, "31+"), (None, None, "31+"),
    ],
)
def test_bands(spark, storey, label, open_label):
    assert one(spark, storey, band, "int") == label
    assert one(spark, storey, lambda c: band(c, overflow="last"), "int") == open_label


def test_band_ordinal_and_errors(spark):
    assert [one(spark, x, band_ordinal) for x in ("1-15", "31+")] == [1, 3]
    with pytest.raises(ValueError):
        band(F.col("x"), [0, 1], ["a", "b"])
    with pytest.raises(ValueError):
        band(F.col("x"), overflow="first")


def test_storey_upper_bound(spark):
    assert one(spark, "06 TO 10", upper_bound_of_range) == 10
    assert one(spark, "7", last_two) == "7"
    with pytest.raises(PySparkException):
        one(spark, "06 TO XX", upper_bound_of_range)


@pytest.mark.parametrize(
    "text, expected",
    [("Improved", "Improved"), ("Maisonette XYZ", "Maisonette"), ("MAISONETTE", "MAISONETTE"), (None, None)],
)
def test_collapse(spark, text, expected):
    assert one(spark, text, lambda c: collapse_variants(c, "Maisonette")) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("ANG MO KIO", "Ang Mo Kio"), ("2 ROOM", "2 Room"), ("KALLANG/WHAMPOA", "Kallang/Whampoa"),
        ("MULTI-GENERATION", "Multi-Generation"), ("3Gen", "3Gen"), ("DBSS", "Dbss"), (None, None), ("", ""),
    ],
)
def test_title_case(spark, text, expected):
    assert one(spark, text, title_case) == expected


# Spark and Python follow different Unicode editions, so letters outside Latin-1 and Greek are left out.
_TEXT = st.text(st.characters(max_codepoint=0xFF) | st.sampled_from("αβγΔΩ中文"), max_size=12)


@settings(max_examples=20, deadline=None)
@given(texts=st.lists(_TEXT, min_size=5, max_size=40))
def test_title_case_is_that_of_python(spark, texts):
    # A final Greek sigma and U+0000 differ by design of the JVM; neither occurs in such data.
    texts = [t.replace("\x00", "").replace("\x01", "") for t in texts]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string").select("i", title_case(F.col("x")))
    assert dict(rows.collect()) == {i: t.title() for i, t in enumerate(texts)}


def test_only_one_domain_value_is_not_in_title_case(spark):
    values = [v for domain in DOMAINS.values() for v in domain]
    assert len(values) == 54
    rows = spark.createDataFrame([(v,) for v in values], "x string").where(title_case(F.col("x")) != F.col("x"))
    assert [r[0] for r in rows.collect()] == ["3gen"]


def test_json_text(spark):
    assert one(spark, '{"data": {"url": "a/b"}}', lambda c: json_text(c, "$.data.url")) == "a/b"


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "cast,good,bad",
    [
        (to_double_strict, "12.5", "zz"),
        (to_bigint_strict, "12", "1x"),
        (to_month, "2023-8", "2023/08"),
        (upper_bound_of_range, "06 TO 10", "06 TO XX"),
    ],
)
def test_strict_casts_stop_whatever_the_session_says(spark, ansi, cast, good, bad):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        fine = spark.createDataFrame([(good,), (None,)], "x string").select(cast(F.col("x")).alias("y")).collect()
        assert fine[0].y is not None and fine[1].y is None
        with pytest.raises(Exception, match="not a"):
            spark.createDataFrame([(bad,)], "x string").select(cast(F.col("x")).alias("y")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
