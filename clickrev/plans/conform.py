"""Job 1: raw hit files to the two conformed tables.

    python -m clickrev.plans.conform --input-file RAW --output-dir CONFORMED
"""
import argparse
import logging

from pyspark.sql import SparkSession

from clickrev.fixed_values import ALL_HITS, ALL_HITS_CSV, PRODUCT_LEVEL, PRODUCT_LEVEL_CSV
from clickrev.operators.clean import clean_hits
from clickrev.operators.products import product_level
from clickrev.session import apply_sizing, build_session
from clickrev.sources.files import join_path, total_bytes
from clickrev.sources.readers import read_all_hits, read_hits_tsv, read_product_level
from clickrev.sources.writers import write_csv, write_parquet


def conform(
    spark: SparkSession, input_path: str, out_dir: str, *, csv_copies: bool = True
) -> dict[str, int]:
    """Write ``all_hits`` (every hit, cleaned) and ``product_level`` (one row per product).

    The text is parsed once. Everything after reads the Parquet table just
    written: columnar, with ``product_list IS NOT NULL`` pushed into the scan, and
    safe against the loss of executors. ``csv_copies`` adds both tables as CSV.
    Returns the number of rows per table.
    """
    hits_path = join_path(out_dir, ALL_HITS)
    products_path = join_path(out_dir, PRODUCT_LEVEL)

    rows = {ALL_HITS: write_parquet(clean_hits(read_hits_tsv(spark, input_path)), hits_path)}
    hits = read_all_hits(spark, hits_path)
    rows[PRODUCT_LEVEL] = write_parquet(product_level(hits), products_path)
    if csv_copies:
        rows[ALL_HITS_CSV] = write_csv(hits, join_path(out_dir, ALL_HITS_CSV))
        rows[PRODUCT_LEVEL_CSV] = write_csv(
            read_product_level(spark, products_path), join_path(out_dir, PRODUCT_LEVEL_CSV)
        )
    return rows


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Conform raw hit files.")
    parser.add_argument("--input-file", required=True, help="file, folder or glob of raw hits")
    parser.add_argument("--output-dir", required=True, help="folder for the conformed tables")
    parser.add_argument("--no-csv", action="store_true", help="leave out the CSV copies")
    args = parser.parse_args(argv)

    logging.basicConfig(level=logging.INFO)
    spark = build_session("conform hits")
    apply_sizing(spark, total_bytes(spark, args.input_file))
    conform(spark, args.input_file, args.output_dir, csv_copies=not args.no_csv)


if __name__ == "__main__":
    main()
