"""Cleaning of raw hits. No row is dropped: a visitor's entry hit often has no product."""
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from clickrev.fixed_values import ALL_HITS_COLUMNS, BLANK_MEANS_NULL


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip blanks from both ends of every string column."""
    return df.select(
        *[
            F.trim(field.name).alias(field.name)
            if isinstance(field.dataType, StringType)
            else F.col(field.name)
            for field in df.schema
        ]
    )


def blank_to_null(df: DataFrame, columns: Sequence[str] = BLANK_MEANS_NULL) -> DataFrame:
    """Turn empty strings in ``columns`` into NULL."""
    return df.withColumns({name: F.nullif(F.col(name), F.lit("")) for name in columns})


def clean_hits(hits: DataFrame) -> DataFrame:
    """Raw hits to ``all_hits``: trimmed, blanks nulled, columns in their fixed order."""
    return hits.transform(trim_strings).transform(blank_to_null).select(*ALL_HITS_COLUMNS)
