import random

import pytest
from pyspark.sql import Window, functions as F

from clickrev.operators import first_hits, rank_hits, session_search_origin, with_search_origin
from data import BING, GOOGLE, SHOP, SHOP_SESSIONS, SHOP_VISITS, YAHOO, column, frame, hits, rows_of


def sessions(spark, *rows):
    return rows_of(session_search_origin(hits(spark, *rows)))


def test_the_earliest_hit_counts_with_or_without_products(spark):
    assert sessions(spark, *SHOP_VISITS) == SHOP_SESSIONS


def test_a_later_search_does_not_count(spark):
    assert sessions(
        spark,
        {"hit_time_gmt": 100, "referrer": SHOP},
        {"hit_time_gmt": 200, "referrer": GOOGLE + "x"},
    ) == []


@pytest.mark.parametrize("referrer", [None, SHOP, GOOGLE, GOOGLE + "+", "http://www.google.com/"])
def test_no_search_or_no_keyword_is_no_session(spark, referrer):
    assert sessions(spark, {"referrer": referrer}) == []


def test_of_tied_entry_hits_a_search_goes_first_then_the_smallest(spark):
    tied = [
        {"referrer": SHOP},
        {"referrer": YAHOO + "a"},
        {"referrer": GOOGLE + "b"},
        {"referrer": GOOGLE + "a"},
        {"referrer": None},
        {"hit_time_gmt": 2000, "referrer": BING + "early-letter"},
    ]
    for rows in (tied, tied[::-1]):
        assert sessions(spark, *rows) == [("10.1.1.1", "google.com", "a")]


def test_a_hit_without_a_time_is_the_entry_hit(spark):
    with_time = {"hit_time_gmt": 1, "referrer": GOOGLE + "x"}
    assert sessions(spark, with_time, {"hit_time_gmt": None, "referrer": SHOP}) == []
    assert sessions(spark, with_time, {"hit_time_gmt": None, "referrer": BING + "y"}) == [
        ("10.1.1.1", "bing.com", "y")
    ]


def test_hits_without_an_ip_are_one_visitor(spark):
    assert sessions(
        spark,
        {"ip": None, "hit_time_gmt": 1, "referrer": GOOGLE + "x"},
        {"ip": None, "hit_time_gmt": 2, "referrer": GOOGLE + "y"},
    ) == [(None, "google.com", "x")]


def random_hits(spark, seed, n=1500):
    """Heavy ties, missing times, missing visitors, and one visitor with a third of all hits."""
    rng = random.Random(seed)
    urls = [None, SHOP, GOOGLE, GOOGLE + "a", GOOGLE + "b", BING + "a", YAHOO + "c", GOOGLE + "+"]
    return frame(
        spark,
        "id int, ip string, hit_time_gmt int, referrer string",
        *[
            (
                i,
                "hot" if rng.random() < 1 / 3 else rng.choice([None, *"abcdefghijklmnopqrstuvwxyz"]),
                rng.choice([None, *[rng.randrange(-200_000, 200_000) for _ in range(6)], 5, 5, 7]),
                rng.choice(urls),
            )
            for i in range(n)
        ],
    ).repartition(7)


def window_rank(df):
    return df.withColumn(
        "hit_rank",
        F.rank().over(Window.partitionBy("ip").orderBy(F.col("hit_time_gmt").asc())).cast("long"),
    )


@pytest.mark.parametrize("seed", range(3))
def test_sessions_equal_rank_filter_and_minimum(spark, seed):
    df = random_hits(spark, seed)
    smallest = (
        with_search_origin(window_rank(df).filter("hit_rank = 1"))
        .filter("search_engine_domain is not null and search_keyword <> ''")
        .groupBy("ip")
        .agg(F.min(F.struct("search_engine_domain", "search_keyword")).alias("s"))
        .select("ip", "s.*")
    )
    assert rows_of(session_search_origin(df)) == rows_of(smallest)


@pytest.mark.parametrize("seed", range(2))
def test_rank_equals_the_window(spark, seed):
    df = random_hits(spark, seed)
    ranked = rank_hits(df)
    assert ranked.columns == [*df.columns, "hit_rank"]
    assert rows_of(ranked) == rows_of(window_rank(df))


@pytest.mark.parametrize("seed", range(2))
def test_first_hits_equal_rank_one_of_the_window(spark, seed):
    df = random_hits(spark, seed)
    found = first_hits(df)
    assert found.columns == df.columns
    assert rows_of(found) == rows_of(window_rank(df).filter("hit_rank = 1").drop("hit_rank"))


def test_ranks_of_the_whole_int_range(spark):
    times = [-(2**31), -1, 0, 65535, 65536, 2**31 - 1, None]
    df = frame(spark, "ip string, hit_time_gmt int", *[("a", time) for time in times])
    ranked = rank_hits(df).orderBy("hit_time_gmt")
    assert column(ranked, "hit_rank") == [1, 2, 3, 4, 5, 6, 7]


def test_columns_with_the_names_of_internal_ones(spark):
    names = ["_ip", "_time", "_entry", "_span", "_hits", "_url", "_host", "hit_rank", "_visitor", "span_ip", "time"]
    table = hits(spark, {"hit_time_gmt": 1, "referrer": GOOGLE + "x"}, {"hit_time_gmt": 2})
    for name in names:
        table = table.withColumn(name, F.lit(name))
    ranked = rank_hits(table)
    assert sorted(ranked.columns) == sorted(table.columns)
    assert sorted(column(ranked, "hit_rank")) == [1, 2] and set(column(ranked, "_ip")) == {"_ip"}
    first = first_hits(table)
    assert first.columns == table.columns and rows_of(first)[0][0] == 1
    origin = with_search_origin(table)
    assert origin.columns == [*table.columns, "search_engine_domain", "search_keyword"]
    assert set(column(origin, "_url")) == {"_url"} and set(column(origin, "_host")) == {"_host"}
