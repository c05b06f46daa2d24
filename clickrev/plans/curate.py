"""Job 2: conformed tables to the keyword report.

    python -m clickrev.plans.curate --input-dir CONFORMED --output-dir CURATED
"""
import argparse
import logging
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from clickrev.fixed_values import ALL_HITS, PRODUCT_LEVEL, REPORT_HEADINGS, SEARCH_ENGINES
from clickrev.functions.referrer import Engines
from clickrev.operators.attribution import (
    purchase_revenue,
    revenue_by_keyword,
    search_keyword_performance,
)
from clickrev.operators.products import product_level
from clickrev.operators.sessions import session_search_origin
from clickrev.session import apply_sizing, build_session
from clickrev.sources.files import join_path, total_bytes
from clickrev.sources.readers import read_all_hits, read_product_level
from clickrev.sources.workspace import discard, workspace
from clickrev.sources.writers import publish_report, report_file_name, write_parquet

log = logging.getLogger(__name__)


def keyword_report(hits: DataFrame, engines: Engines = SEARCH_ENGINES) -> DataFrame:
    """The whole analysis as one plan: cleaned hits to the sorted report."""
    return search_keyword_performance(
        session_search_origin(hits, engines), purchase_revenue(product_level(hits))
    )


def curate(
    spark: SparkSession,
    conformed_dir: str,
    out_dir: str,
    run_date: date | None = None,
    *,
    engines: Engines = SEARCH_ENGINES,
) -> str:
    """Publish the report of the conformed tables; returns its path.

    ``run_date`` (today by default) is part of the file name. Sessions and purchases are
    stored on the way, in the shared folder: their counts are logged, none is observed in
    a plan that adaptive execution may cut.
    """
    hits = read_all_hits(spark, join_path(conformed_dir, ALL_HITS))
    products = read_product_level(spark, join_path(conformed_dir, PRODUCT_LEVEL))
    log.info("read %d hits", hits.count())  # counts of Parquet tables: from their footers
    log.info("read %d products", products.count())

    folder = workspace(spark, "curate")
    tables = {
        "sessions": session_search_origin(hits, engines),
        "purchases": purchase_revenue(products),
    }
    rows, stored = {}, {}
    for name, df in tables.items():
        path = join_path(folder, name)
        rows[name] = write_parquet(df, path)
        stored[name] = spark.read.schema(df.schema).parquet(path)
    log.info("%d visitors came from a search engine", rows["sessions"])
    log.info("%d products were bought", rows["purchases"])

    report = revenue_by_keyword(stored["sessions"], stored["purchases"])
    path = publish_report(
        report.withColumnsRenamed(REPORT_HEADINGS), out_dir, report_file_name(run_date or date.today())
    )
    discard(spark, folder)
    return path


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Publish the search keyword report.")
    parser.add_argument("--input-dir", required=True, help="folder of the conformed tables")
    parser.add_argument("--output-dir", required=True, help="folder for the report")
    parser.add_argument("--run-date", type=date.fromisoformat, help="YYYY-MM-DD, today by default")
    args = parser.parse_args(argv)

    logging.basicConfig(level=logging.INFO)
    spark = build_session("publish keyword report")
    tables = [join_path(args.input_dir, name) for name in (ALL_HITS, PRODUCT_LEVEL)]
    apply_sizing(spark, total_bytes(spark, *tables))
    curate(spark, args.input_dir, args.output_dir, args.run_date)


if __name__ == "__main__":
    main()
