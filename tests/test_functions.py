"""Column functions against pairs worked out by hand."""

import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dossier.functions import addresses, names, text, values


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    "function, given_, expected",
    [
        (text.title_name, "JOHN O'BRIEN JR", "John O'Brien JR"),
        (text.title_name, "MCDONALD", "McDonald"),
        (text.title_name, "MACHADO", "MacHado"),
        (text.title_name, "MACY", "Macy"),
        (text.title_name, "SMITH-JONES  iii", "Smith-Jones III"),
        (text.title_name, "  ", "  "),
        (text.title_name, None, None),
        (text.title_firm, "DOE & ROE, LLP.", "Doe & Roe, LLP."),
        (text.title_address_line, "767 3RD AVE", "767 3rd Ave"),
        (text.title_city, "NEW YORK", "New York"),
        (text.title_law_school, "ANY SCHOOL; LOS ANGELES CA", "Any School; Los Angeles Ca"),
        (text.squeeze, " a\t b c ", "a b c"),
        (values.bar_key, "# 123456 ", "123456"),
        (values.bar_key, "AB-12", "ab-12"),
        (values.bar_key, None, ""),
        (values.stored_bar, " # ", None),
        (values.normalize_phone, "(212) 555-0123", "+12125550123"),
        (values.normalize_phone, "1 212 555 0123", "+12125550123"),
        (values.normalize_phone, "+44 20 5550 1234", "+44 20 5550 1234"),
        (values.normalize_phone, " ", None),
        (values.strict_phone, "+44 20 5550 1234", None),
        (values.coerce_date, "2016", datetime.date(2016, 1, 1)),
        (values.coerce_date, "2016-08", datetime.date(2016, 8, 1)),
        (values.coerce_date, "8/26/2016", datetime.date(2016, 8, 26)),
        (values.coerce_date, "2/30/2016", None),
        (values.coerce_date, "soon", None),
    ],
)
def test_scalar(spark, function, given_, expected):
    assert one(spark, function, given_) == expected


def test_fingerprint_is_the_known_digest(spark):
    row = spark.createDataFrame([(" 123456 ", "CA"), ("#123456", "ca")], "b string, s string").select(values.profile_fingerprint(F.col("b"), F.col("s")).alias("f")).collect()
    assert {r.f for r in row} == {"bac604fe9d3dcb50abd808dae39e93278534cc30ebdcaba97b11956aff98ee03"}


@pytest.mark.parametrize(
    "name, expected",
    [
        ("Doe, Ann Marie", ("Ann", "Marie", "Doe", None)),
        ("Ann Lee, Jr.", ("Jr.", "Ann", "Lee", None)),
        ("Dr. Ann B. Lee III", ("Ann", "B.", "Lee", "III")),
        ("Ann Lee, Suite 4", ("Ann", "Lee, Suite", "4", None)),
        ("Cher", ("Cher", None, None, None)),
    ],
)
def test_parse_name(spark, name, expected):
    assert tuple(one(spark, names.parse_name, name)) == expected


def test_parse_name_of_nothing(spark):
    assert one(spark, names.parse_name, "  ") is None and one(spark, names.parse_name, None) is None


def test_normalize_name_drops_the_middle(spark):
    r = one(spark, names.normalize_name, "Doe,  Ann Marie")
    assert (r.full_name, r.middle_name) == ("Ann Doe", "Marie")


@pytest.mark.parametrize("name, expected", [("Doe, Ann", ["ann", "doe"]), ("Hon. Ann Doe, Esq.", ["ann", "doe"]), ("Doe Law, LLC", ["doe", "law", "llc"]), (None, [])])
def test_name_tokens(spark, name, expected):
    assert one(spark, names.name_tokens, name) == expected


def test_firms_and_individuals(spark):
    firm = ["Doe & Roe LLP", "Doe, Roe & Poe", "", "Franco.", "Ann Doe & Associates"]
    person = ["Ann Doe", "Doe, Ann"]
    assert all(one(spark, names.is_firm, n) for n in firm) and not any(one(spark, names.is_individual, n) for n in firm)
    assert all(one(spark, names.is_individual, n) for n in person)


def test_parse_address(spark):
    a = one(spark, addresses.parse_address, "12  Main Street, Ste 4,  Any Town, ny 10017")
    assert tuple(a) == ("12 Main st", "Ste 4", "Any Town", "NY", "10017")
    assert one(spark, addresses.parse_address, " ") is None


def test_address_similarity(spark):
    rows = [("12 Main Street", "12 Main St, Any Town, NY"), ("12 Main Street", "14 Main St, Any Town, NY"), ("Any Town", "12 Main St")]
    got = [r[0] for r in spark.createDataFrame(rows, "a string, b string").select(addresses.address_similarity(F.col("a"), F.col("b"))).collect()]
    assert got == [1.0, 0.0, 0.0]


@pytest.mark.parametrize("n, expected", [(0, 0), (1, 4), (2, 8), (3, 9), (4, 12), (6, 12)])
def test_practice_points(spark, n, expected):
    assert one(spark, values.practice_points, n, "int") == expected


def test_popularity(spark):
    got = spark.createDataFrame([(0.0, 0), (4.8, 100), (None, None)], "r double, n int").select(F.round(values.popularity(F.col("r"), F.col("n")), 2)).collect()
    assert [r[0] for r in got] == [0.0, 90.0, 0.0]


def test_lists(spark):
    row = spark.createDataFrame([(["A", "b", None], [" a", "C"])], "x array<string>, y array<string>")
    assert row.select(values.ordered_union(F.col("x"), F.col("y"))).first()[0] == ["A", "b", None, "C"]
    assert spark.createDataFrame([(["a", "b", "c", "d"], ["A", "B", "C", "D", "e"])], "x array<string>, y array<string>").select(values.list_overlap(F.col("x"), F.col("y"))).first()[0] == 0.8


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet=" \t\nAbc'-.,1é", max_size=12), min_size=1, max_size=30))
def test_squeeze_and_tokens_agree_with_python(spark, texts):
    import re

    rows = spark.createDataFrame([(t,) for t in texts], "x string").select("x", text.squeeze(F.col("x")).alias("s"), names.word_tokens(F.col("x")).alias("w")).collect()
    for r in rows:
        assert r.s == " ".join(r.x.split()) and r.w == re.findall("[a-z0-9]+", r.x.lower())
