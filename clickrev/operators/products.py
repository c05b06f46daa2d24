"""Unpacking of ``product_list``: one row per product of a hit."""
from pyspark.sql import DataFrame, functions as F

from clickrev.fixed_values import (
    ATTRIBUTE_SEPARATOR,
    PRODUCT_LEVEL_COLUMNS,
    PRODUCT_SEPARATOR,
)
from clickrev.functions.numbers import finite_double, whole_number


def product_hits(hits: DataFrame) -> DataFrame:
    """Hits that carry products."""
    return hits.filter(F.col("product_list").isNotNull())


def product_entries(hits: DataFrame) -> DataFrame:
    """One row per product, its packed text in ``product_entry``; blank entries are dropped.

    The format knows no quoting, so a comma in a product name splits the product.
    """
    entry = F.explode(F.split("product_list", PRODUCT_SEPARATOR))
    return (
        product_hits(hits)
        .withColumn("product_entry", entry)
        .withColumn("product_entry", F.trim("product_entry"))
        .filter(F.col("product_entry") != "")
    )


def product_level(hits: DataFrame) -> DataFrame:
    """Cleaned hits to ``product_level``. Narrow: no shuffle.

    An attribute that is missing or unreadable is NULL. Custom events stay one
    string (``200|201``), so that the table can be written as CSV.
    """
    category, name, quantity, revenue, custom_events = [
        F.get("_attributes", F.lit(position)) for position in range(5)
    ]
    return (
        product_entries(hits)
        .withColumn("_attributes", F.split("product_entry", ATTRIBUTE_SEPARATOR))
        .withColumns(
            {
                "product_category": category,
                "product_name": name,
                "product_quantity": whole_number(quantity),
                "product_total_revenue": finite_double(revenue),
                "product_custom_events": F.nullif(custom_events, F.lit("")),
            }
        )
        .select(*PRODUCT_LEVEL_COLUMNS)
    )
