import random

from clickrev.operators import (
    attributed_purchases,
    clean_hits,
    product_level,
    purchase_revenue,
    revenue_by_keyword,
    search_keyword_performance,
)
from clickrev.plans import keyword_report
from data import (
    DOUBLE_ORDER_REPORT,
    DOUBLE_ORDERS,
    GOOGLE,
    PURCHASES,
    SESSIONS,
    SHOP,
    SHOP_VISITS,
    SINGLE_ORDER_REPORT,
    SINGLE_ORDERS,
    frame,
    hits,
    rows_of,
)


def report(spark, *rows):
    return [tuple(row) for row in keyword_report(clean_hits(hits(spark, *rows))).collect()]


def test_single_product_orders(spark):
    assert report(spark, *SHOP_VISITS, *SINGLE_ORDERS) == SINGLE_ORDER_REPORT


def test_two_product_orders(spark):
    assert report(spark, *SHOP_VISITS, *DOUBLE_ORDERS) == DOUBLE_ORDER_REPORT


def test_visitors_from_inside_the_shop_are_left_out(spark):
    assert report(
        spark,
        {"hit_time_gmt": 100, "referrer": SHOP},
        {"hit_time_gmt": 200, "referrer": GOOGLE + "x"},
        {"hit_time_gmt": 300, "event_list": "1", "product_list": "A;B;1;10;"},
    ) == []


def test_revenue_is_the_line_total_whatever_the_quantity(spark):
    assert report(
        spark,
        {"referrer": GOOGLE + "x", "event_list": "1", "product_list": "A;B;5;10;"},
    ) == [("google.com", "x", 10.0)]


def test_headings_and_types(spark):
    df = keyword_report(hits(spark, {}))
    assert df.dtypes == [
        ("Search Engine Domain", "string"), ("Search Keyword", "string"), ("Revenue", "double"),
    ]


def test_only_purchases_of_more_than_nothing_count(spark):
    df = hits(
        spark,
        {"event_list": "1", "product_list": "A;bought;1;5;"},
        {"event_list": "2, 1 ,12", "product_list": "A;also bought;1;6;"},
        {"event_list": "2", "product_list": "A;seen;1;5;"},
        {"event_list": "12", "product_list": "A;in cart;1;5;"},
        {"event_list": None, "product_list": "A;no event;1;5;"},
        {"event_list": "1", "product_list": "A;free;1;0;,A;returned;1;-5;,A;unpriced;1;;"},
    )
    assert rows_of(purchase_revenue(product_level(df))) == [
        ("10.1.1.1", "also bought", 6.0), ("10.1.1.1", "bought", 5.0),
    ]


SESSION_ROWS = [
    ("a", "google.com", "x"), ("b", "google.com", "x"), ("c", "bing.com", "y"), (None, "ask.com", "z"),
]
PURCHASE_ROWS = [("a", "P", 1.5), ("a", "Q", 2.5), ("b", "P", 3.0), ("d", "P", 9.0), (None, "P", 7.0)]


def test_left_join_keeps_every_session(spark):
    joined = attributed_purchases(
        frame(spark, SESSIONS, *SESSION_ROWS), frame(spark, PURCHASES, *PURCHASE_ROWS)
    )
    assert joined.columns == [
        "ip", "search_engine_domain", "search_keyword", "product_name", "product_total_revenue",
    ]
    assert rows_of(joined) == sorted(
        [
            ("a", "google.com", "x", "P", 1.5),
            ("a", "google.com", "x", "Q", 2.5),
            ("b", "google.com", "x", "P", 3.0),
            ("c", "bing.com", "y", None, 0.0),
            (None, "ask.com", "z", None, 0.0),
        ],
        key=repr,
    )


def test_revenue_sums_and_zero_rows(spark):
    revenue = revenue_by_keyword(
        frame(spark, SESSIONS, *SESSION_ROWS), frame(spark, PURCHASES, *PURCHASE_ROWS)
    )
    assert rows_of(revenue) == [
        ("ask.com", "z", 0.0), ("bing.com", "y", 0.0), ("google.com", "x", 7.0),
    ]


def test_equal_revenue_is_ordered_by_engine_and_keyword(spark):
    rows = [("1", "msn.com", "b"), ("2", "msn.com", "a"), ("3", "ask.com", "c"), ("4", "aol.com", "d")]
    sessions = frame(spark, SESSIONS, *rows).repartition(4)
    table = search_keyword_performance(sessions, frame(spark, PURCHASES, ("4", "P", 1.0)))
    assert [tuple(row) for row in table.collect()] == [
        ("aol.com", "d", 1.0), ("ask.com", "c", 0.0), ("msn.com", "a", 0.0), ("msn.com", "b", 0.0),
    ]


def test_a_visitor_with_a_third_of_all_purchases(spark):
    rng = random.Random(7)
    visitors = [*"abcdefgh", None]
    sessions = frame(spark, SESSIONS, *[(v, "google.com", f"k{v}") for v in ["hot", "idle", *visitors]])
    purchases = frame(
        spark,
        PURCHASES,
        *[
            ("hot" if rng.random() < 1 / 3 else rng.choice([*visitors, "unknown"]), f"P{i % 3}", i % 5 + 0.5)
            for i in range(600)
        ],
    ).repartition(6)
    plain = sessions.join(purchases, "ip", "left").fillna(0.0, ["product_total_revenue"])
    joined = attributed_purchases(sessions, purchases)
    assert rows_of(joined) == rows_of(plain)
    summed = plain.groupBy("search_engine_domain", "search_keyword").sum("product_total_revenue")
    assert rows_of(revenue_by_keyword(sessions, purchases)) == rows_of(summed)


def test_attribution_is_lazy_and_splits_a_busy_visitor(spark, tmp_path):
    """Equal purchases of one visitor, which no hash of the row could spread."""
    rows = [("bot", "P", 1.0)] * 40_000 + [(f"v{i}", "P", 1.0) for i in range(2000)]
    frame(spark, PURCHASES, *rows).repartition(8).write.parquet(f"{tmp_path}/p")
    purchases = spark.read.parquet(f"{tmp_path}/p")
    sessions = frame(spark, SESSIONS, ("bot", "a.com", "x"), *[(f"v{i}", "a.com", "y") for i in range(3000)])
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = attributed_purchases(sessions, purchases)
        assert "isFinalPlan=false" in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 43_000
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert "skew=true" in plan
