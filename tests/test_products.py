import pytest
from pyspark.sql import functions as F

from clickrev.fixed_values import PRODUCT_LEVEL_COLUMNS
from clickrev.functions import finite_double, whole_number
from clickrev.operators import clean_hits, product_entries, product_hits, product_level
from data import column, frame, hits


PRODUCT_LISTS = [
    ("Garden;Rake;3;44.85;", [("Garden", "Rake", 3, 44.85, None)]),
    ("Garden;Seeds;12;6;9|17=3", [("Garden", "Seeds", 12, 6.0, "9|17=3")]),
    (
        "Tools;Saw;2;31;5,Paint;Blue 2l;7;63.70;8|9,Paint;Brush;1;2.2;",
        [
            ("Tools", "Saw", 2, 31.0, "5"),
            ("Paint", "Blue 2l", 7, 63.7, "8|9"),
            ("Paint", "Brush", 1, 2.2, None),
        ],
    ),
    ("Paint;Roller;2;;", [("Paint", "Roller", 2, None, None)]),
    ("Paint;Roller;2;15.5", [("Paint", "Roller", 2, 15.5, None)]),
    ("  Paint;Roller;2;15.5; ", [("Paint", "Roller", 2, 15.5, None)]),
    ("A;B;1;5;7|8, ,C;D;2;1.25", [("A", "B", 1, 5.0, "7|8"), ("C", "D", 2, 1.25, None)]),
    ("Cat;Name", [("Cat", "Name", None, None, None)]),
    ("Only", [("Only", None, None, None, None)]),
    ("A;B;x;y;", [("A", "B", None, None, None)]),
    ("A;B;1.5;2;", [("A", "B", 1, 2.0, None)]),
    ("A;B;1;NaN;", [("A", "B", 1, None, None)]),
    ("A;B;1;Infinity;", [("A", "B", 1, None, None)]),
    ("A;B;1;2; ;eVar1", [("A", "B", 1, 2.0, " ")]),
    ("A;B, with comma;1;2;", [("A", "B", None, None, None), ("with comma", "1", 2, None, None)]),
    (",,", []),
    ("", []),
    ("   ", []),
    (None, []),
]


@pytest.fixture(scope="module")
def products(spark):
    """Parsed products per packed text, all in one job."""
    rows = [{"product_list": text, "hit_time_gmt": n} for n, (text, _) in enumerate(PRODUCT_LISTS)]
    parsed = {text: [] for text, _ in PRODUCT_LISTS}
    df = product_level(clean_hits(hits(spark, *rows))).select(
        "hit_time_gmt",
        "product_category",
        "product_name",
        "product_quantity",
        "product_total_revenue",
        "product_custom_events",
    )
    for n, *product in df.collect():
        parsed[PRODUCT_LISTS[n][0]].append(tuple(product))
    return parsed


@pytest.mark.parametrize(("product_list", "expected"), PRODUCT_LISTS)
def test_product_list(products, product_list, expected):
    assert products[product_list] == expected


def test_types_and_columns(spark):
    df = product_level(hits(spark, {}))
    assert df.columns == PRODUCT_LEVEL_COLUMNS
    types = dict(df.dtypes)
    assert types["product_quantity"] == "int"
    assert types["product_total_revenue"] == "double"
    assert types["product_custom_events"] == "string"


def test_the_other_columns_of_the_hit_are_repeated(spark):
    df = product_level(hits(spark, {"ip": "10.9.9.9", "product_list": "A;B;1;2;,C;D;1;3;"}))
    assert column(df, "ip") == ["10.9.9.9", "10.9.9.9"]
    assert "product_list" not in df.columns


def test_hits_without_products_give_no_entries(spark):
    raw = clean_hits(hits(spark, {"product_list": None}, {"product_list": " "}, {"product_list": "A"}))
    assert column(product_hits(raw), "product_list") == ["A"]
    assert column(product_entries(raw), "product_entry") == ["A"]


WHOLE_NUMBERS = [
    ("7", 7), (" 7 ", 7), ("\t7", 7), ("+7", 7), ("-7", -7), ("1.5", 1), ("-1.9", -1), ("5.", 5),
    (".5", 0), ("-.5", 0), (".", 0), ("007", 7), ("2147483647", 2147483647),
    ("2147483648", None), ("1e3", None), ("1.5x", None), ("1 2", None), ("", None),
    ("+", None), ("--1", None), ("1.2.3", None), (None, None),
]


def test_whole_number_is_the_lenient_cast(spark):
    df = frame(spark, "t string, expected int", *WHOLE_NUMBERS)
    found = df.select("t", whole_number(F.col("t")).alias("n"))
    assert [tuple(row) for row in found.collect()] == WHOLE_NUMBERS
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert column(df.select(F.col("t").cast("int").alias("n")), "n") == column(df, "expected")
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


FINITE_DOUBLES = [
    ("190", 190.0), (" 4.00 ", 4.0), ("1e3", 1000.0), ("1d", 1.0), ("-2.5", -2.5),
    ("NaN", None), ("inf", None), ("-Infinity", None), ("1e999", None), ("12,5", None),
    ("", None), ("abc", None), (None, None),
]


def test_finite_double(spark):
    df = frame(spark, "t string, expected double", *FINITE_DOUBLES)
    found = df.select("t", finite_double(F.col("t")).alias("n"))
    assert [tuple(row) for row in found.collect()] == FINITE_DOUBLES
