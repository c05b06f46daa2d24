import importlib
import logging
import os
from datetime import date

import pytest

from clickrev.fixed_values import ALL_HITS_COLUMNS
from clickrev.plans import conform, curate
from clickrev.session import sizing_for
from clickrev.sources import read_all_hits, read_product_level
from data import (
    DOUBLE_ORDER_REPORT,
    DOUBLE_ORDERS,
    HIT_DEFAULTS,
    SHOP_VISITS,
    SINGLE_ORDER_REPORT,
    SINGLE_ORDERS,
    rows_of,
)


def raw_file(folder, rows, name="hits.tsv"):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as file:
        file.write("\t".join(ALL_HITS_COLUMNS) + "\n")
        for row in rows:
            values = (HIT_DEFAULTS | {"date_time": "2024-01-02 03:04:05"} | row).values()
            file.write("\t".join("" if value is None else str(value) for value in values) + "\n")
    return path


def report_rows(path):
    with open(path, encoding="utf-8") as file:
        rows = [line.rstrip("\n").split("\t") for line in file][1:]
    return [(engine, keyword, float(revenue)) for engine, keyword, revenue in rows]


@pytest.mark.parametrize(
    ("orders", "products", "report"),
    [(SINGLE_ORDERS, 8, SINGLE_ORDER_REPORT), (DOUBLE_ORDERS, 9, DOUBLE_ORDER_REPORT)],
)
def test_raw_file_to_report(spark, scratch, caplog, orders, products, report):
    caplog.set_level(logging.INFO)
    rows = [*SHOP_VISITS, *orders]
    raw, conformed = raw_file(scratch, rows), f"{scratch}/conformed"
    counts = conform(spark, raw, conformed)
    assert counts == {
        "all_hits": len(rows), "all_hits_csv": len(rows),
        "product_level": products, "product_level_csv": products,
    }
    assert sorted(os.listdir(conformed)) == sorted(counts)
    path = curate(spark, conformed, f"{scratch}/curated", date(2024, 1, 2))
    assert os.path.basename(path) == "2024-01-02_SearchKeywordPerformance.tab"
    assert report_rows(path) == report
    assert "4 visitors came from a search engine" in caplog.text
    assert f"{products - 3} products were bought" in caplog.text


def test_the_csv_copies_hold_the_same_rows(spark, scratch):
    conform(spark, raw_file(scratch, [*SHOP_VISITS, *DOUBLE_ORDERS]), scratch)
    for read, table in ((read_all_hits, "all_hits"), (read_product_level, "product_level")):
        df = read(spark, f"{scratch}/{table}")
        copy = spark.read.csv(f"{scratch}/{table}_csv", header=True, schema=df.schema)
        assert rows_of(copy) == rows_of(df)


def test_running_again_replaces_everything(spark, scratch):
    conformed = f"{scratch}/conformed"
    for orders, report in ((SINGLE_ORDERS, SINGLE_ORDER_REPORT), (DOUBLE_ORDERS, DOUBLE_ORDER_REPORT)):
        raw = raw_file(scratch, [*SHOP_VISITS, *orders])
        conform(spark, raw, conformed, csv_copies=False)
        path = curate(spark, conformed, scratch, date(2024, 1, 2))
        assert report_rows(path) == report
    assert sorted(os.listdir(conformed)) == ["all_hits", "product_level"]


@pytest.mark.parametrize(
    ("rows", "report", "sessions", "purchases"),
    [
        (SHOP_VISITS, [(e, k, 0.0) for e, k, _ in sorted(SINGLE_ORDER_REPORT)], 4, 0),
        (SINGLE_ORDERS, [], 0, 5),
        ([{"ip": "10.2.0.5"}], [], 0, 0),
    ],
    ids=["no purchase", "no search", "neither"],
)
def test_a_day_without_purchases_or_searches(spark, scratch, caplog, rows, report, sessions, purchases):
    caplog.set_level(logging.INFO)
    conform(spark, raw_file(scratch, rows), f"{scratch}/conformed", csv_copies=False)
    path = curate(spark, f"{scratch}/conformed", f"{scratch}/curated", date(2024, 1, 2))
    assert report_rows(path) == report
    assert f"read {len(rows)} hits" in caplog.text
    assert f"{sessions} visitors came from a search engine" in caplog.text
    assert f"{purchases} products were bought" in caplog.text


def test_command_lines(spark, scratch, monkeypatch):
    # the package exports functions of the same names
    conform_module = importlib.import_module("clickrev.plans.conform")
    curate_module = importlib.import_module("clickrev.plans.curate")
    for module in (conform_module, curate_module):
        monkeypatch.setattr(module, "build_session", lambda name: spark)
        monkeypatch.setattr(module, "apply_sizing", lambda session, size: None)
    raw = raw_file(scratch, [*SHOP_VISITS, *SINGLE_ORDERS])
    conform_module.main(["--input-file", raw, "--output-dir", f"{scratch}/c", "--no-csv"])
    curate_module.main(
        ["--input-dir", f"{scratch}/c", "--output-dir", f"{scratch}/r", "--run-date", "2024-05-06"]
    )
    path = f"{scratch}/r/2024-05-06_SearchKeywordPerformance.tab"
    assert report_rows(path) == SINGLE_ORDER_REPORT


def test_a_report_that_cannot_be_published_fails_the_job(spark, scratch):
    conform(spark, raw_file(scratch, SHOP_VISITS), scratch, csv_copies=False)
    blocked = os.path.join(scratch, "file")
    with open(blocked, "w", encoding="utf-8"):
        pass
    with pytest.raises(Exception):
        curate(spark, scratch, blocked, date(2024, 1, 2))


def test_settings_grow_with_the_input():
    partitions = [int(sizing_for(n << 40)["spark.sql.shuffle.partitions"]) for n in (0, 2, 100, 300)]
    assert partitions == [200, 712, 25_800, 77_000]
