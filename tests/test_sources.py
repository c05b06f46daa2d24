import os
import subprocess
import sys
from datetime import date, datetime
from types import SimpleNamespace

import pytest

from clickrev.fixed_values import ALL_HITS_COLUMNS, REPORT_HEADINGS
from clickrev.sources import writers
from clickrev.sources import (
    publish_report,
    read_all_hits,
    read_hits_tsv,
    read_product_level,
    report_file_name,
    write_csv,
    write_parquet,
)
from clickrev.sources.files import total_bytes
from clickrev.sources.workspace import discard, scratch as scope, shared_folder, workspace
from data import column, frame, hits, rows_of

REPORT = ", ".join(f"`{name}` string" for name in list(REPORT_HEADINGS.values())[:2]) + ", Revenue double"


def write_lines(folder, *lines, name="hits.tsv"):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as file:
        file.write("\n".join(["\t".join(ALL_HITS_COLUMNS), *lines]) + "\n")
    return path


GOOD = '5\t2024-01-02 03:04:05\t"Agent (a, b)"\t10.1.1.1\t2\tSalem\tOR\tUS\tHome\thttp://s\tA;B;1;;\thttp://r'


def test_a_raw_line(spark, scratch):
    row = read_hits_tsv(spark, write_lines(scratch, GOOD)).first()
    assert tuple(row) == (
        5, datetime(2024, 1, 2, 3, 4, 5), "Agent (a, b)", "10.1.1.1", "2", "Salem", "OR", "US",
        "Home", "http://s", "A;B;1;;", "http://r",
    )


def test_raw_schema_and_header_of_every_file(spark, scratch):
    write_lines(scratch, GOOD, name="1.tsv")
    write_lines(scratch, GOOD, GOOD, name="2.tsv")
    df = read_hits_tsv(spark, scratch)
    assert df.columns == ALL_HITS_COLUMNS
    assert [kind for _, kind in df.dtypes] == ["int", "timestamp"] + ["string"] * 10
    assert df.count() == 3


def test_dirty_lines_are_kept(spark, scratch):
    lines = [
        GOOD.replace("5\t", "five\t", 1),
        GOOD.replace("2024-01-02 03:04:05", "yesterday"),
        "7\t2024-01-02 03:04:05\tshort",
        GOOD + "\tsurplus\tfields",
        "\t".join(["", " ", *[""] * 10]),  # white space only: Spark's reader skips it
        "0" + "\t" * 11,
        GOOD.replace("Salem", "  Salem "),
    ]
    rows = read_hits_tsv(spark, write_lines(scratch, *lines)).collect()
    assert len(rows) == 6
    assert rows[0].hit_time_gmt is None and rows[0].ip == "10.1.1.1"
    assert rows[1].date_time is None and rows[1].hit_time_gmt == 5
    assert rows[2].hit_time_gmt == 7 and rows[2].user_agent == "short" and rows[2].ip is None
    assert rows[3].referrer == "http://r"
    assert tuple(rows[4]) == (0, *[None] * 11)
    assert rows[5].geo_city == "  Salem "


def test_parquet_round_trip_replaces_and_counts(spark, scratch):
    path = f"{scratch}/all_hits"
    assert write_parquet(hits(spark, {}, {}), path) == 2
    df = hits(spark, {"hit_time_gmt": None, "date_time": datetime(2024, 1, 1, 5)})
    assert write_parquet(df, path) == 1
    assert rows_of(read_all_hits(spark, path)) == rows_of(df)


def test_an_empty_table_counts_zero(spark, scratch):
    assert write_parquet(hits(spark, {}).filter("ip is null"), f"{scratch}/none") == 0


def test_a_table_without_the_right_columns_is_refused(spark, scratch):
    write_parquet(hits(spark, {}), f"{scratch}/all_hits")
    with pytest.raises(Exception, match="product_category"):
        read_product_level(spark, f"{scratch}/all_hits")


def test_csv_copy(spark, scratch):
    df = hits(spark, {"geo_city": 'a "quoted", city', "geo_region": None, "pagename": "back\\slash"})
    assert write_csv(df, f"{scratch}/csv") == 1
    copy = spark.read.csv(f"{scratch}/csv", header=True, schema=df.schema)
    assert rows_of(copy) == rows_of(df)


def read_text(path):
    with open(path, encoding="utf-8") as file:
        return file.read()


def test_the_report_is_one_sorted_file(spark, scratch):
    report = frame(
        spark, REPORT,
        ("b.com", "k", 1.0), ("a.com", "low", 0.0), ("a.com", "k", 1.0), ("c.com", "big", 12345678.9),
    ).repartition(4)
    name = report_file_name(date(2024, 2, 3))
    assert name == "2024-02-03_SearchKeywordPerformance.tab"
    path = publish_report(report, scratch + "/", name)
    assert read_text(path).splitlines() == [
        "Search Engine Domain\tSearch Keyword\tRevenue",
        "c.com\tbig\t12345678.90",
        "a.com\tk\t1.00",
        "b.com\tk\t1.00",
        "a.com\tlow\t0.00",
    ]
    assert [entry for entry in os.listdir(scratch) if not entry.startswith(".")] == [name]


def test_a_large_report_is_a_folder_of_ordered_parts(spark, scratch):
    rows = [("e.com", f"k{i:03}", float(i * 7 % 101)) for i in range(100)]
    report = frame(spark, REPORT, *rows).repartition(5)
    path = publish_report(report, scratch, "big.tab", single_file=False)
    assert os.path.isdir(path)
    parts = sorted(entry for entry in os.listdir(path) if entry.startswith("part-"))
    lines = [line for part in parts for line in read_text(os.path.join(path, part)).splitlines()]
    expected = sorted(rows, key=lambda row: (-row[2], row[0], row[1]))
    assert lines == [f"{engine}\t{keyword}\t{revenue:.2f}" for engine, keyword, revenue in expected]


@pytest.mark.parametrize("first", [True, False])
@pytest.mark.parametrize("second", [True, False])
def test_publishing_again_replaces_file_or_folder(spark, scratch, first, second):
    for revenue, single_file in ((1.0, first), (2.0, second)):
        report = frame(spark, REPORT, ("a.com", "k", revenue))
        path = publish_report(report, scratch, "r.tab", single_file=single_file)
        read = spark.read.csv(path, sep="\t", header=single_file, schema=REPORT)
        assert rows_of(read) == [("a.com", "k", revenue)]


def test_a_failed_publish_keeps_the_earlier_report_and_the_staged_rows(spark, scratch, monkeypatch):
    path = publish_report(frame(spark, REPORT, ("a.com", "k", 1.0)), scratch, "r.tab")
    before = read_text(path)
    monkeypatch.setattr(writers, "joined_parts", lambda *_: None)
    with pytest.raises(Exception):  # the file system's own error or ours
        publish_report(frame(spark, REPORT, ("a.com", "k", 2.0)), scratch, "r.tab")
    assert read_text(path) == before
    staging = [entry for entry in os.listdir(scratch) if entry.startswith("_staging-")]
    assert rows_of(spark.read.parquet(f"{scratch}/{staging[0]}/rows")) == [("a.com", "k", 2.0)]


def test_an_empty_report_is_a_header(spark, scratch):
    report = frame(spark, REPORT, ("a.com", "k", 1.0)).filter("Revenue > 1")
    path = publish_report(report, scratch, "empty.tab")
    assert read_text(path).splitlines() == ["Search Engine Domain\tSearch Keyword\tRevenue"]


def test_size_of_files_folders_and_globs(spark, scratch):
    path = write_lines(scratch, GOOD)
    size = os.path.getsize(path)
    assert total_bytes(spark, path) == size
    assert total_bytes(spark, f"{scratch}/*.tsv", f"{scratch}/nothing") == size


def session_stub(**settings):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, *default: settings.get(name, *default)))


def test_shared_folder_is_the_one_the_cluster_names():
    assert shared_folder(session_stub(**{"spark.checkpoint.dir": "hdfs://shared/"})) == "hdfs://shared/"


def test_without_the_setting_only_a_local_master_gets_a_folder():
    local = {"spark.sql.warehouse.dir": "file:/warehouse", "spark.master": "local[8]"}
    assert shared_folder(session_stub(**local)) == "file:/warehouse/_clickrev"
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session_stub(**local | {"spark.master": master}))


def test_scratch_deletes_what_was_opened_inside(spark):
    outer = workspace(spark, "outer")
    spark.range(3).write.parquet(f"{outer}/t")
    with pytest.raises(KeyError), scope(spark):
        inner = workspace(spark, "inner")
        spark.range(3).write.parquet(f"{inner}/t")
        with scope(spark):
            innermost = workspace(spark, "inner")
            spark.range(3).write.parquet(f"{innermost}/t")
        assert total_bytes(spark, innermost) == 0 < total_bytes(spark, inner)
        raise KeyError
    assert total_bytes(spark, inner) == 0 < total_bytes(spark, outer)
    discard(spark, outer)


@pytest.mark.parametrize("stopped", ["", "spark.stop()"])
def test_no_workspace_is_left_when_the_driver_ends(scratch, stopped):
    code = f"""
from clickrev.session import build_session
from clickrev.sources.workspace import discard, scratch as scope, shared_folder, workspace
spark = build_session("t", **{{"spark.master": "local[1]", "spark.ui.enabled": "false", "spark.checkpoint.dir": {scratch!r}}})
spark.range(3).write.parquet(workspace(spark, "x") + "/t")
import os
assert any(name.startswith('clickrev-') for name in os.listdir({scratch!r}))
{stopped}
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
    # Spark itself leaves an empty folder of its own there
    assert not [name for name in os.listdir(scratch) if name.startswith("clickrev-")]


def test_columns_are_read_back_by_name(spark, scratch):
    df = hits(spark, {"ip": "10.2.2.2"})
    write_parquet(df.select(*reversed(df.columns)), f"{scratch}/t")
    assert column(read_all_hits(spark, f"{scratch}/t"), "ip") == ["10.2.2.2"]
    assert read_all_hits(spark, f"{scratch}/t").columns == ALL_HITS_COLUMNS
