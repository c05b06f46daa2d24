"""Streams of hit files: restarts, late hits, open and closed sessions."""
import random

import pytest

from clickrev.fixed_values import RAW_HIT_SCHEMA
from clickrev.operators import clean_hits, gap_session_report, product_level
from clickrev.sources import read_all_hits, read_hits_tsv, read_product_level
from clickrev.streaming import closed_sessions, conform_stream, open_sessions, session_stream, stream_sessions
from clickrev.streaming.conform import main
from data import BING, GOOGLE, SHOP, hits, rows_of

INT_MIN = -(1 << 31)


class Shop:
    """A folder of raw files and the tables that a stream makes of it."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.lots = spark, folder, 0
        self.raw, self.out, self.state = [f"{folder}/{name}" for name in ("raw", "out", "state")]

    def arrive(self, *rows, files=1):
        df = hits(self.spark, *rows).repartition(files)
        df.write.csv(f"{self.raw}/lot-{self.lots}", sep="\t", header=True, timestampFormat="yyyy-MM-dd HH:mm:ss")
        self.lots += 1

    def run(self, gap=10, delay=5, **more):
        conform_stream(self.spark, f"{self.raw}/lot-*", self.out, self.state, gap=gap, delay=delay, **more)

    def sessions(self):
        return rows_of(stream_sessions(self.spark, self.out, self.state))

    def all_raw(self):
        return clean_hits(read_hits_tsv(self.spark, f"{self.raw}/lot-*"))


@pytest.fixture
def shop(spark, scratch):
    return Shop(spark, scratch)


def batch_sessions(table, gap):
    return rows_of(gap_session_report(table, gap).drop("session_number"))


def some_visits(seed, start, n=150):
    rng = random.Random(seed)
    for _ in range(n):
        yield {
            "ip": "bot" if rng.random() < 0.4 else f"10.0.0.{rng.randint(1, 9)}",
            "hit_time_gmt": start + rng.randint(0, 400),
            "referrer": rng.choice([None, SHOP, GOOGLE + "Rake", GOOGLE + "hose", BING]),
            **rng.choice([{}, {"event_list": "1", "product_list": f"T;R;1;{rng.randint(1, 9)};,T;H;1;2.5;"}]),
        }


def test_two_runs_equal_one_and_the_batch_job(shop, spark):
    shop.arrive(*some_visits(1, 0), files=3)
    shop.run()
    shop.arrive(*some_visits(2, 500), files=3)
    shop.run()
    table = shop.all_raw()
    assert rows_of(read_all_hits(spark, f"{shop.out}/all_hits")) == rows_of(table)
    assert rows_of(read_product_level(spark, f"{shop.out}/product_level")) == rows_of(product_level(table))
    assert shop.sessions() == batch_sessions(table, 10)
    assert closed_sessions(spark, shop.out).count() > 50 and open_sessions(spark, shop.state).count() > 0


def test_a_run_without_new_files_changes_nothing(shop):
    shop.arrive(*some_visits(3, 0, 40))
    shop.run()
    before = shop.sessions()
    shop.run()
    assert shop.sessions() == before


def test_batches_of_one_file(shop):
    # files of increasing time, so that no hit is late
    for lot in range(3):
        shop.arrive(*some_visits(lot, 500 * lot, 30))
    shop.run(files_per_batch=1, delay=2000)
    assert shop.sessions() == batch_sessions(shop.all_raw(), 10)


def test_a_session_goes_on_in_the_next_run(shop, spark):
    shop.arrive({"hit_time_gmt": 100, "referrer": GOOGLE + "rake"}, {"hit_time_gmt": 108})
    shop.run()
    assert shop.sessions() == [("10.1.1.1", 100, 108, 2, "google.com", "rake", 0.0)]
    shop.arrive({"hit_time_gmt": 118, "event_list": "1", "product_list": "T;R;1;5;"})
    shop.run()
    assert shop.sessions() == [("10.1.1.1", 100, 118, 3, "google.com", "rake", 5.0)]
    assert closed_sessions(spark, shop.out).count() == 0


def test_the_watermark_closes_sessions_of_all_visitors(shop, spark):
    shop.arrive({"ip": "a", "hit_time_gmt": 100}, {"ip": "b", "hit_time_gmt": 114})
    shop.run()
    # 114 - 5 has not reached 100 + 10
    assert closed_sessions(spark, shop.out).count() == 0
    shop.arrive({"ip": "b", "hit_time_gmt": 115})
    shop.run()
    assert rows_of(closed_sessions(spark, shop.out).select("ip", "session_end")) == [("a", 100)]
    assert rows_of(open_sessions(spark, shop.state).select("ip", "session_end")) == [("b", 115)]


def test_hits_that_come_late(shop, spark):
    shop.arrive({"ip": "a", "hit_time_gmt": 100}, {"ip": "b", "hit_time_gmt": 200})
    shop.run()
    # the watermark is at 195: 196 is in time, 190 opens a session of its own, 185 would be closed at once
    shop.arrive(*[{"ip": "a", "hit_time_gmt": time} for time in (196, 185)], {"ip": "c", "hit_time_gmt": 190}, {"ip": "d", "hit_time_gmt": 101})
    shop.run()
    found = [(ip, start, end) for ip, start, end, *_ in shop.sessions()]
    assert found == [("a", 100, 100), ("a", 196, 196), ("b", 200, 200), ("c", 190, 190)]
    assert read_all_hits(spark, f"{shop.out}/all_hits").count() == 6


def test_odd_hits(shop, spark):
    rows = [
        {"hit_time_gmt": None, "referrer": GOOGLE + "never"},
        {"ip": None, "hit_time_gmt": INT_MIN, "referrer": GOOGLE + "b"},
        {"ip": None, "hit_time_gmt": INT_MIN, "referrer": GOOGLE + "a"},
        {"ip": "x", "hit_time_gmt": -3},
        {"ip": "x", "hit_time_gmt": -3},
    ]
    shop.arrive(*rows)
    shop.run()
    assert shop.sessions() == batch_sessions(shop.all_raw(), 10)
    assert read_all_hits(spark, f"{shop.out}/all_hits").count() == 5


def test_an_empty_file_and_then_hits(shop, spark):
    (spark.createDataFrame([], RAW_HIT_SCHEMA).coalesce(1).write.csv(f"{shop.raw}/lot-empty", sep="\t", header=True))
    shop.run()
    assert closed_sessions(spark, shop.out).count() == 0
    shop.arrive({"hit_time_gmt": 1})
    shop.run()
    assert [row[:4] for row in shop.sessions()] == [("10.1.1.1", 1, 1, 1)]


def test_a_table_has_the_same_sessions_as_a_stream(spark):
    table = clean_hits(hits(spark, *some_visits(5, 0)))
    assert rows_of(session_stream(table, 10)) == batch_sessions(table, 10)


def test_columns_with_names_of_the_operator(spark):
    table = hits(spark, {"hit_time_gmt": 7}).selectExpr("*", "1 AS _at", "2 AS _spent", "3 AS session_window")
    assert rows_of(session_stream(table, 10)) == [("10.1.1.1", 7, 7, 1, None, None, 0.0)]


def test_command_line(shop, spark):
    shop.arrive(*some_visits(6, 0, 20))
    main(["--input-dir", f"{shop.raw}/lot-*", "--output-dir", shop.out, "--checkpoint-dir", shop.state, "--gap", "10", "--delay", "5"])
    assert shop.sessions() == batch_sessions(shop.all_raw(), 10)
