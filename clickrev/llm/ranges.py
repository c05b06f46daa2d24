"""Documents in the order of their ids, cut into ranges that overlap by one document."""
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType

import numpy as np
import pandas as pd


def range_bounds(df: DataFrame, column: str, ranges: int) -> list[int]:
    """At most ``ranges - 1`` ascending cut points: bounds of ranges of about equal counts."""
    shares = [k / ranges for k in range(1, ranges)]
    if not shares:
        return []
    row = df.agg(F.percentile_approx(column, shares, 50 * ranges).alias("cuts")).first()
    return sorted(set(row["cuts"] or []))


def with_successor_ranges(df: DataFrame, ranges: int) -> DataFrame:
    """Deal rows out by descending ranges of ``doc_id``, each with the next one's first row.

    Returns the rows with ``_range`` (0 holds the largest ids) and ``_borrowed``: true for
    the copy of a row that only serves as the successor of its range's last row. The last
    range borrows the first row of all. Partitions are sorted by range, own rows first, by
    descending id, null ids last; equal ids by text.

    One shuffle of the rows. What is borrowed is one row per range, picked from the ids
    alone, so the list of them is as long as there are ranges.
    """
    ids = df.select(F.col("doc_id").cast("long").alias("doc_id"))
    cuts = np.array(range_bounds(ids, "doc_id", ranges), np.int64)

    def range_of(doc_id: pd.Series) -> pd.Series:
        place = len(cuts) - np.searchsorted(cuts, doc_id.fillna(0).to_numpy(np.int64), "right")
        return pd.Series(np.where(doc_id.isna(), len(cuts), place), dtype="int32")

    range_udf = F.pandas_udf(range_of, IntegerType())
    heads = (
        ids.withColumn("_range", range_udf("doc_id"))
        .groupBy("_range")
        .agg(F.max("doc_id").alias("doc_id"))
        .collect()  # one row per range
    )
    filled = sorted(row["_range"] for row in heads)
    before = {r: filled[k - 1] for k, r in enumerate(filled)}  # the first one's is the last
    lenders = {row["_range"]: row["doc_id"] for row in heads}

    lends = F.lit(False)
    borrower = F.lit(None).cast("int")
    if filled:
        borrowers = F.create_map(*[F.lit(x) for r in filled for x in (r, before[r])])
        first_ids = F.create_map(*[F.lit(x) for r in filled for x in (r, lenders[r] or 0)])
        borrower = F.element_at(borrowers, F.col("_range"))
        # a range of null ids only lends any of its rows
        lends = F.coalesce(F.col("doc_id"), F.lit(0)) == F.element_at(first_ids, F.col("_range"))
    own = F.struct(F.col("_range"), F.lit(False).alias("_borrowed"))
    lent = F.struct(borrower.alias("_range"), F.lit(True).alias("_borrowed"))
    copies = F.explode(F.when(lends, F.array(own, lent)).otherwise(F.array(own)))
    return (
        df.withColumn("doc_id", F.col("doc_id").cast("long"))
        .withColumn("_range", range_udf("doc_id"))
        .withColumn("_copy", copies)
        .drop("_range")
        .select("*", "_copy.*")
        .drop("_copy")
        .repartitionByRange(max(1, len(filled)), "_range")
        .sortWithinPartitions("_range", "_borrowed", F.col("doc_id").desc_nulls_last(), "text")
    )
