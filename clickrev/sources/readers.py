"""Raw hit files and the conformed tables."""
from pyspark.sql import DataFrame, SparkSession

from clickrev.fixed_values import (
    ALL_HITS_COLUMNS,
    PRODUCT_LEVEL_COLUMNS,
    RAW_HIT_SCHEMA,
    RAW_SEPARATOR,
    RAW_TIMESTAMP_FORMAT,
)


def read_hits_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Tab-delimited hits with a header line, read with a fixed schema.

    An empty field and an unreadable number or time are NULL, a short line is
    filled up with NULLs and surplus fields are ignored. Only lines of nothing
    but white space are skipped.
    """
    return spark.read.csv(
        path,
        schema=RAW_HIT_SCHEMA,
        sep=RAW_SEPARATOR,
        header=True,
        timestampFormat=RAW_TIMESTAMP_FORMAT,
    )


def read_all_hits(spark: SparkSession, path: str) -> DataFrame:
    """The conformed table of all hits."""
    return spark.read.parquet(path).select(*ALL_HITS_COLUMNS)


def read_product_level(spark: SparkSession, path: str) -> DataFrame:
    """The conformed table of products."""
    return spark.read.parquet(path).select(*PRODUCT_LEVEL_COLUMNS)
