"""Sinks. Row counts come from the footers of the files written."""
import logging
from collections.abc import Sequence
from datetime import date
from uuid import uuid4

from pyspark.sql import Column, DataFrame, functions as F

from clickrev.fixed_values import (
    REPORT_DATE_FORMAT,
    REPORT_FILE_SUFFIX,
    REPORT_HEADINGS,
    REPORT_SEPARATOR,
)
from clickrev.sources.files import delete, join_path, joined_parts, replace

log = logging.getLogger(__name__)


def write_parquet(df: DataFrame, path: str) -> int:
    """Write ``df`` as Parquet, replacing what was there; returns the number of rows.

    The count comes from the footers of the files just written, so it holds whatever
    adaptive execution made of the plan, also for an empty table.
    """
    df.write.mode("overwrite").parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path).count()
    log.info("wrote %d rows to %s", rows, path)
    return rows


def write_csv(df: DataFrame, path: str) -> int:
    """Write ``df`` as CSV with a header, replacing what was there; returns the number of rows.

    ``df`` is counted apart, which costs next to nothing if it is a Parquet table.
    """
    df.write.mode("overwrite").option("header", True).csv(path)
    rows = df.count()
    log.info("wrote %d rows to %s", rows, path)
    return rows


def report_file_name(run_date: date) -> str:
    return run_date.strftime(REPORT_DATE_FORMAT) + REPORT_FILE_SUFFIX


def _best_first() -> Sequence[Column]:
    engine, keyword, revenue = [F.col(f"`{name}`") for name in REPORT_HEADINGS.values()]
    return [revenue.desc(), engine.asc(), keyword.asc()]


def publish_report(
    report: DataFrame, out_dir: str, file_name: str, *, single_file: bool = True
) -> str:
    """Write the report as tab-delimited text, best keyword first.

    ``report`` may come in any order. It is computed once, in parallel, into a staging
    table beside the target, and sorted in parallel into ordered part files. By default these
    are joined, as a stream of bytes, into one file called ``file_name`` with a header. With
    ``single_file=False`` the report is a folder of that name whose part files, read in the
    order of their names, hold the rows in order and no header. Amounts are printed with two
    decimals, never in scientific notation.

    Replaces an earlier report of the same name, and raises if it cannot; the earlier
    report then is still there, and so are the staged rows. Returns the path.
    """
    spark = report.sparkSession
    target = join_path(out_dir, file_name)
    staging = join_path(out_dir, f"_staging-{uuid4().hex}")
    revenue = REPORT_HEADINGS["revenue"]

    rows = write_parquet(report, join_path(staging, "rows"))
    staged = spark.read.schema(report.schema).parquet(join_path(staging, "rows"))
    text = join_path(staging, "text")
    staged.orderBy(*_best_first()).withColumn(revenue, F.col(revenue).cast("decimal(38,2)")).write.csv(
        text, header=False, sep=REPORT_SEPARATOR
    )
    if single_file:
        whole = join_path(staging, "whole")
        joined_parts(spark, text, whole, REPORT_SEPARATOR.join(report.columns) + "\n")
        text = whole
    replace(spark, text, target)
    delete(spark, staging)
    log.info("published %d report rows as %s", rows, target)
    return target
