"""Interval joins against plain Python."""
import random

import pytest

from clickrev.functions import order_total
from clickrev.operators import interval_join, offer_hits, offer_report, product_level, purchase_hits
from data import GOOGLE, frame, hits, rows_of
from pyspark.sql import functions as F

INT_MIN, INT_MAX = -(1 << 31), (1 << 31) - 1
POINTS, INTERVALS = "k string, t int, x int", "k string, a bigint, b bigint, name string"


def plain(points, intervals, keyed):
    return sorted(
        (
            (*point, a, b, name)
            for point in points
            for k, a, b, name in intervals
            if None not in (point[1], a, b) and a <= point[1] <= b and (not keyed or (k is not None and k == point[0]))
        ),
        key=repr,
    )


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("seed", range(3))
def test_against_plain_python(spark, seed, keyed):
    rng = random.Random(seed)

    def time():
        return rng.choice([INT_MIN, INT_MAX, -17, -1, 0, 15, 16, 17, rng.randint(-70_000, 70_000), rng.randint(-20, 20)])

    def key():
        return "hot" if rng.random() < 0.4 else rng.choice(["a", "b", None])

    points = [(key(), rng.choice([None, time(), time(), time()]), i // 2) for i in range(200)]
    intervals = []
    for i in range(80):
        start = rng.choice([None, time(), time(), time(), time(), -(1 << 40)])
        length = rng.choice([0, 1, 15, 16, 17, 255, 256, 257, 70_000, 1 << 32, -1])
        end = rng.choice([None] + [start if start is None else start + length] * 6)
        intervals.append((key(), start, end, f"n{i // 2}"))
    found = interval_join(
        frame(spark, POINTS, *points), frame(spark, INTERVALS, *intervals), "t", "a", "b", by=["k"] if keyed else []
    )
    assert found.columns == ["k", "t", "x", "a", "b", "name"]
    assert rows_of(found) == plain(points, intervals, keyed)


def test_empty_sides_and_names_that_clash(spark):
    points = frame(spark, "k string, t int, _key0 int, _row int, __second int", ("a", 5, 1, 2, 3))
    intervals = frame(spark, "k string, a int, b int, _row int, _first int", ("a", 0, 9, 7, 8))
    found = interval_join(points, intervals, "t", "a", "b", by=["k"])
    assert found.columns == ["k", "t", "_key0", "_row", "__second", "a", "b", "_first"]
    assert rows_of(found) == [("a", 5, 1, 2, 3, 0, 9, 8)]
    assert interval_join(points.limit(0), intervals, "t", "a", "b").count() == 0
    assert interval_join(points, intervals.limit(0), "t", "a", "b").count() == 0


def test_an_interval_has_at_most_17_pieces(spark):
    intervals = frame(spark, INTERVALS, *[("a", -5, -5 + (1 << bits) + more, f"{bits} {more}") for bits in range(33) for more in (-1, 0, 1)])
    plan = interval_join(frame(spark, POINTS, ("a", -5, 0)), intervals, "t", "a", "b", by=["k"])
    assert plan.count() == 99
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text


ORDER = "Tools;Rake;1;5;,Tools;Hose;2; 2.5 ;x, ,Tools;Bad;1;NaN;,Tools;Back;1;-9;,Tools"


def test_order_total_is_the_sum_of_the_products_bought(spark):
    table = hits(
        spark,
        {"ip": "a", "event_list": "2, 1", "product_list": ORDER},
        {"ip": "b", "event_list": "12", "product_list": ORDER},
        {"ip": "c", "event_list": None, "product_list": ORDER},
        {"ip": "d", "event_list": "1"},
    )
    spent = table.select("ip", order_total(F.col("event_list"), F.col("product_list")))
    assert rows_of(spent) == [("a", 7.5), ("b", 0.0), ("c", 0.0), ("d", 0.0)]
    unpacked = purchase_hits(product_level(table)).filter("product_total_revenue > 0")
    assert unpacked.agg(F.sum("product_total_revenue")).first()[0] == 7.5


def test_offers(spark):
    table = hits(
        spark,
        {"hit_time_gmt": 10, "referrer": GOOGLE + "x"},
        {"hit_time_gmt": 20, "event_list": "1", "product_list": "T;R;1;5;"},
        {"hit_time_gmt": 20},
        {"hit_time_gmt": 21},
        {"hit_time_gmt": 15, "ip": "other"},
        {"hit_time_gmt": 15, "ip": None},
    )
    offers = frame(
        spark, "offer string, ip string, starts bigint, ends bigint",
        ("long", "10.1.1.1", 10, 20), ("short", "10.1.1.1", 20, 20), ("nobody", None, 0, 99), ("missed", "other", 16, 99),
    )
    assert rows_of(offer_hits(table, offers).select("hit_time_gmt", "offer")) == [
        (10, "long"), (20, "long"), (20, "long"), (20, "short"), (20, "short"),
    ]
    assert rows_of(offer_report(table, offers)) == [
        ("long", "10.1.1.1", 10, 20, 3, 5.0), ("short", "10.1.1.1", 20, 20, 2, 5.0),
    ]
