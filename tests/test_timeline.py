"""As-of joins and sessions by gaps, against plain Python."""
import random

import pytest

from clickrev.operators import (
    as_of,
    asof_attribution,
    asof_revenue_by_keyword,
    gap_session_report,
    gap_sessions,
    session_numbers,
)
from clickrev.operators.names import own_names
from data import BING, GOOGLE, SHOP, YAHOO, frame, hits, rows_of

INT_MIN, INT_MAX = -(1 << 31), (1 << 31) - 1
# seconds around the bounds of spans, and the ends of an INT
TIMES = [INT_MIN, -65537, -65536, -1, 0, 1, 65535, 65536, 65537, 10 * 65536, INT_MAX]
LEFT, RIGHT = "k string, t int, x int", "k string, t int, v string, w int"


def plain_as_of(left, right):
    out = []
    for k, t, x in left:
        best = None
        for rk, rt, v, w in right:
            if k is not None and rk == k and t is not None and rt is not None and rt <= t:
                row = (-rt, v is not None, v or "", w is not None, w or 0, v, w)
                best = row if best is None or row < best else best
        out.append((k, t, x, *((best[5], best[6], -best[0]) if best else (None, None, None))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_as_of_against_plain_python(spark, seed):
    rng = random.Random(seed)

    def time():
        return rng.choice([None, *TIMES, rng.randint(-200_000, 200_000), rng.randint(0, 50)])

    def key():
        return "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None])

    left = [(key(), time(), i) for i in range(300)]
    right = [(key(), time(), rng.choice(["p", "q", None]), rng.randint(0, 3)) for _ in range(200)]
    found = as_of(frame(spark, LEFT, *left), frame(spark, RIGHT, *right), "k", "t", ["v", "w"], since="at")
    assert found.columns == ["k", "t", "x", "v", "w", "at"]
    assert rows_of(found) == plain_as_of(left, right)


def test_names_do_not_clash(spark):
    left = frame(spark, "k string, t int, _key int, __known string, _span int, at int", ("a", 5, 1, "x", 2, 7))
    right = frame(spark, "k string, t int, v string, _time int", ("a", 3, "v", 9))
    assert rows_of(as_of(left, right, "k", "t", ["v"])) == [("a", 5, 1, "x", 2, 7, "v")]
    assert own_names(left)("x") == "___x"


def test_a_table_as_of_itself(spark):
    df = frame(spark, "k string, t int, v string", ("a", 1, "x"), ("a", 70_000, "y"))
    found = as_of(df.select("k", "t"), df, "k", "t", ["v"])
    assert rows_of(found) == [("a", 1, "x"), ("a", 70_000, "y")]


def test_empty_sides(spark):
    left, right = frame(spark, LEFT, ("a", 1, 1)), frame(spark, RIGHT, ("a", 1, "v", 1))
    assert rows_of(as_of(left, right.limit(0), "k", "t", ["v"])) == [("a", 1, 1, None)]
    assert as_of(left.limit(0), right, "k", "t", ["v"]).count() == 0


def bought(time, name="Rake", amount="5", **more):
    return {"hit_time_gmt": time, "event_list": "1", "product_list": f"Tools;{name};1;{amount};", **more}


def test_a_purchase_counts_for_the_last_search_until_then(spark):
    visits = [
        {"hit_time_gmt": 100, "referrer": GOOGLE + "first"},
        {"hit_time_gmt": 200, "referrer": SHOP},
        bought(250, "A"),
        {"hit_time_gmt": 300, "referrer": BING + "second"},
        {"hit_time_gmt": 300, "referrer": YAHOO + "other"},
        bought(300, "B"),
        bought(200_000, "C"),
        bought(50, "D"),
        bought(90, "E", ip="10.9.9.9"),
        bought(None, "F"),
        bought(260, "free", "0"),
    ]
    found = rows_of(asof_attribution(hits(spark, *visits)).select("product_name", "search_engine_domain", "search_keyword", "search_time"))
    assert found == [
        ("A", "google.com", "first", 100),
        ("B", "bing.com", "second", 300),
        ("C", "bing.com", "second", 300),
        ("D", None, None, None),
        ("E", None, None, None),
        ("F", None, None, None),
    ]
    revenue = rows_of(asof_revenue_by_keyword(hits(spark, *visits)))
    assert revenue == [("bing.com", "second", 10.0, 2), ("google.com", "first", 5.0, 1), (None, None, 15.0, 3)]


def test_a_search_that_buys_counts_for_itself(spark):
    found = asof_attribution(hits(spark, bought(7, referrer=GOOGLE + "rake")))
    assert [row.search_keyword for row in found.collect()] == ["rake"]


def plain_numbers(rows, gap):
    out = []
    for visitor in {ip for ip, _ in rows}:
        number, last = 0, None
        for time in sorted(t for ip, t in rows if ip == visitor and t is not None):
            number += last is None or time - last > gap
            last = time
            out.append((visitor, time, number))
        out += [(visitor, None, None) for ip, t in rows if ip == visitor and t is None]
    return sorted(out, key=repr)


@pytest.mark.parametrize("gap", [0, 30, 1800, 65536, 300_000])
def test_sessions_against_plain_python(spark, gap):
    rng = random.Random(gap)
    rows = []
    for _ in range(600):
        ip = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", None])
        rows.append((ip, rng.choice([None, *TIMES, *[rng.randint(-300_000, 300_000) for _ in range(30)]])))
    table = hits(spark, *[{"ip": ip, "hit_time_gmt": t} for ip, t in rows])
    found = gap_sessions(table, gap).select("ip", "hit_time_gmt", "session_number")
    assert rows_of(found) == plain_numbers(rows, gap)


def test_an_earlier_number_is_replaced(spark):
    table = gap_sessions(hits(spark, {"hit_time_gmt": 1}, {"hit_time_gmt": 9}), 3)
    again = gap_sessions(table, 100)
    assert again.columns == table.columns and sorted(r.session_number for r in again.collect()) == [1, 1]


def test_seconds_of_a_busy_visitor(spark):
    table = hits(spark, *[{"ip": "bot", "hit_time_gmt": t % 7} for t in range(700)])
    assert rows_of(session_numbers(table, 3)) == [("bot", t, 1, 100) for t in range(7)]


def test_session_report(spark):
    visits = [
        {"hit_time_gmt": 100, "referrer": SHOP},
        {"hit_time_gmt": 100, "referrer": YAHOO + "b"},
        {"hit_time_gmt": 100, "referrer": GOOGLE + "c"},
        bought(110, amount="2.5"),
        bought(110, amount="1"),
        {"hit_time_gmt": 5000, "referrer": SHOP},
        {"hit_time_gmt": 5010, "referrer": GOOGLE + "late"},
        {"ip": None, "hit_time_gmt": 7, "referrer": BING + "x"},
        bought(7, ip=None),
        {"hit_time_gmt": None, "referrer": BING + "never"},
    ]
    assert rows_of(gap_session_report(hits(spark, *visits))) == [
        ("10.1.1.1", 1, 100, 110, 5, "google.com", "c", 3.5),
        ("10.1.1.1", 2, 5000, 5010, 2, None, None, 0.0),
        (None, 1, 7, 7, 2, "bing.com", "x", 5.0),
    ]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("operator", [asof_attribution, gap_sessions, gap_session_report])
def test_windows_hold_a_span_or_one_row_per_span(spark, tmp_path, operator):
    hits(spark, bought(1)).write.parquet(f"{tmp_path}/hits")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(operator(spark.read.parquet(f"{tmp_path}/hits")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows
    for line in windows:
        assert "span" in line
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
