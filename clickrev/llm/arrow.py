"""Arrow batches in and out of the operators' map functions."""
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from clickrev.sources.files import join_path
from clickrev.sources.workspace import workspace

#: Rows a map function takes from a batch at a time, which bounds what it holds beside the batch.
ROWS_AT_ONCE = 1024


def slices(batches: Iterable[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [text or "" for text in batch.column(column).to_pylist()]


def map_arrow(
    df: DataFrame, columns: Sequence[str], function: Callable, schema: str
) -> DataFrame:
    """``mapInArrow`` over the named columns only, so the scan reads no others."""
    return df.select(*columns).mapInArrow(function, schema)


def staged(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again.

    Cuts the lineage: what a lost executor held is read again, not computed again.
    """
    path = join_path(workspace(spark, label), "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
