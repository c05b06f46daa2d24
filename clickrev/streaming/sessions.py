"""Sessions by gaps over a stream of hits.

Spark's session windows are the keyed state: one row per visitor and open session, which
holds a count, two times, a sum and the smallest entry, never the hits. The watermark is the
timer that closes a session.

A hit at most ``gap`` after the one before joins its session. A session is closed, written and
forgotten once the latest hit seen is ``gap + delay`` after its last one. So a hit that arrives
less than ``delay`` behind the latest hit seen before its batch is counted as if it had come in
order. One that comes later is late: it either opens a session of its own, or, if that session
would be closed at once, is in none. ``all_hits`` holds it in any case.
"""
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickrev.fixed_values import SEARCH_ENGINES
from clickrev.functions.orders import order_total
from clickrev.functions.referrer import Engines
from clickrev.operators.names import own_names
from clickrev.operators.sessions import with_search_origin
from clickrev.operators.timeline import GAP
from clickrev.sources.files import join_path

SESSIONS = "sessions"
SESSION_SCHEMA = """
    ip STRING, session_start BIGINT, session_end BIGINT, n_hits BIGINT,
    search_engine_domain STRING, search_keyword STRING, revenue DOUBLE
"""
#: Seconds a hit may come behind the latest one and still be counted in order.
DELAY = 7200
# A watermark starts at 1970. Times are moved so that the earliest INT lies there.
_EARLIEST = -(1 << 31)
# The state of an open session: visitor, window, entry, last time, hits, revenue.
_ENTRY = "struct<time: bigint, other: boolean, search_engine_domain: string, search_keyword: string>"
_STATE = (
    "struct<ip: string, extent: struct<opened: timestamp, closes: timestamp>, "
    f"entry: {_ENTRY}, session_end: bigint, n_hits: bigint, revenue: double>"
)
_MERGE_FIRST = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def _with_entry() -> list[Column]:
    return [
        F.col("ip"),
        F.col("entry.time").alias("session_start"),
        F.col("session_end"),
        F.col("n_hits"),
        F.col("entry.search_engine_domain").alias("search_engine_domain"),
        F.col("entry.search_keyword").alias("search_keyword"),
        F.col("revenue"),
    ]


def session_stream(
    hits: DataFrame, gap: int = GAP, delay: int = DELAY, engines: Engines = SEARCH_ENGINES
) -> DataFrame:
    """One row per visitor and session of the hits, a stream or a table.

    ``ip, session_start, session_end, n_hits, search_engine_domain, search_keyword, revenue``:
    the columns of ``gap_session_report`` without its number, which no stream can know of a
    visitor it has forgotten. The search is that of the first second, the smallest of
    several. Hits without a time belong to no session; those without an ``ip`` are one
    visitor's.
    """
    hits = hits.select("ip", "hit_time_gmt", "event_list", "product_list", "referrer")
    _ = own_names(hits)
    at, time = _("at"), F.col("hit_time_gmt").cast("long")
    from_search = F.coalesce(F.col("search_keyword") != "", F.lit(False))
    entry = F.struct(
        time.alias("time"),
        (~from_search).alias("other"),
        F.when(from_search, F.col("search_engine_domain")).alias("search_engine_domain"),
        F.when(from_search, F.col("search_keyword")).alias("search_keyword"),
    )
    return (
        hits.filter(F.col("hit_time_gmt").isNotNull())
        .withColumn(at, F.timestamp_seconds(time - _EARLIEST))
        .withWatermark(at, f"{delay} seconds")
        .transform(with_search_origin, "referrer", engines)
        .withColumn(_("spent"), order_total(F.col("event_list"), F.col("product_list")))
        .groupBy("ip", F.session_window(at, f"{gap} seconds"))
        .agg(
            F.min(entry).alias("entry"),
            F.max(time).alias("session_end"),
            F.count(F.lit(1)).alias("n_hits"),
            F.sum(_("spent")).alias("revenue"),
        )
        .select(*_with_entry())
    )


def merge_before_shuffle(spark: SparkSession) -> None:
    """Let each task reduce its hits to sessions, so a busy visitor is a few rows per task."""
    spark.conf.set(_MERGE_FIRST, "true")


def closed_sessions(spark: SparkSession, out_dir: str) -> DataFrame:
    """The sessions that :func:`clickrev.streaming.conform_stream` has closed and written."""
    return spark.read.schema(SESSION_SCHEMA).parquet(join_path(out_dir, SESSIONS))


def open_sessions(spark: SparkSession, checkpoint_dir: str) -> DataFrame:
    """The sessions still open after the last batch, read from the stream's state."""
    state = spark.read.format("statestore").load(join_path(checkpoint_dir, SESSIONS))
    return state.select(F.col("value").cast(_STATE).alias("state")).select("state.*").select(*_with_entry())


def stream_sessions(spark: SparkSession, out_dir: str, checkpoint_dir: str) -> DataFrame:
    """All sessions so far, closed or open. For use while no stream is running."""
    return closed_sessions(spark, out_dir).unionByName(open_sessions(spark, checkpoint_dir))


