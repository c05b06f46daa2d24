"""Job 1 as a stream: new hit files are appended to the conformed tables and the sessions.

    python -m clickrev.streaming.conform --input-dir RAW --output-dir CONFORMED --checkpoint-dir STATE

Run it again whenever files have come: each run takes what no earlier run has taken, and ends.
"""
import argparse
import logging

from pyspark.sql import DataFrame, SparkSession

from clickrev.fixed_values import (
    ALL_HITS,
    PRODUCT_LEVEL,
    RAW_HIT_SCHEMA,
    RAW_SEPARATOR,
    RAW_TIMESTAMP_FORMAT,
    SEARCH_ENGINES,
)
from clickrev.functions.referrer import Engines
from clickrev.operators.clean import clean_hits
from clickrev.operators.products import product_level
from clickrev.operators.timeline import GAP
from clickrev.session import build_session
from clickrev.sources.files import join_path
from clickrev.streaming.sessions import DELAY, SESSIONS, merge_before_shuffle, session_stream

log = logging.getLogger(__name__)


def read_hit_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Hit files as they appear in a folder (or the folders of a glob), rows as ``read_hits_tsv`` reads them.

    A file must be moved in whole. ``files_per_batch`` bounds a batch, and so the memory a
    long backlog takes.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(
        path, schema=RAW_HIT_SCHEMA, sep=RAW_SEPARATOR, header=True, timestampFormat=RAW_TIMESTAMP_FORMAT
    )


def _append_all(df: DataFrame, path: str, checkpoint: str) -> int:
    """Append what is new of ``df`` to a Parquet table, exactly once, and return the rows taken in."""
    query = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    taken = sum(progress.numInputRows for progress in query.recentProgress)
    log.info("took %d rows into %s", taken, path)
    return taken


def conform_stream(
    spark: SparkSession,
    input_path: str,
    out_dir: str,
    checkpoint_dir: str,
    *,
    gap: int = GAP,
    delay: int = DELAY,
    files_per_batch: int | None = None,
    engines: Engines = SEARCH_ENGINES,
) -> None:
    """Bring ``all_hits``, ``product_level`` and ``sessions`` up to date with the files there are.

    The text is parsed once: products and sessions stream from the table of hits. Each table
    has a checkpoint of its own below ``checkpoint_dir``, which must be shared by driver and
    executors. A run that breaks off is finished by the next one, whose readers see no row
    twice: only files in a table's commit log are read. ``gap`` and ``delay``
    must stay the same as long as the checkpoint does, and only one run may use it at a time.
    """
    merge_before_shuffle(spark)
    hits_path = join_path(out_dir, ALL_HITS)
    cleaned = clean_hits(read_hit_stream(spark, input_path, files_per_batch))
    _append_all(cleaned, hits_path, join_path(checkpoint_dir, ALL_HITS))

    def new_hits() -> DataFrame:
        reader = spark.readStream.schema(cleaned.schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return reader.parquet(hits_path)

    derived = {PRODUCT_LEVEL: product_level(new_hits()), SESSIONS: session_stream(new_hits(), gap, delay, engines)}
    for table, df in derived.items():
        _append_all(df, join_path(out_dir, table), join_path(checkpoint_dir, table))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Conform the hit files that are new.")
    parser.add_argument("--input-dir", required=True, help="folder into which raw hit files are moved")
    parser.add_argument("--output-dir", required=True, help="folder of the conformed tables")
    parser.add_argument("--checkpoint-dir", required=True, help="shared folder for progress and open sessions")
    parser.add_argument("--gap", type=int, default=GAP, help="seconds without a hit that end a session")
    parser.add_argument("--delay", type=int, default=DELAY, help="seconds a hit may come late")
    parser.add_argument("--files-per-batch", type=int, help="bound of a batch, none by default")
    args = parser.parse_args(argv)

    logging.basicConfig(level=logging.INFO)
    spark = build_session("conform new hits")
    conform_stream(
        spark, args.input_dir, args.output_dir, args.checkpoint_dir,
        gap=args.gap, delay=args.delay, files_per_batch=args.files_per_batch,
    )


if __name__ == "__main__":
    main()
