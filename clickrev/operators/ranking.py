"""Rank of hits within a visitor, and the entry hits."""
from pyspark.sql import Column, DataFrame, Window, functions as F

from clickrev.operators.names import own_names

# Width of a time span as a power of two: an INT time has 2^16 spans of 2^16
# seconds, so no window over a visitor ever holds more than 65,536 rows.
_SPAN_BITS = 16
# Below every INT time: a hit without a time comes first.
_BEFORE_ALL = -(1 << 40)


def ordered_time() -> Column:
    return F.coalesce(F.col("hit_time_gmt").cast("long"), F.lit(_BEFORE_ALL))


def rank_hits(hits: DataFrame) -> DataFrame:
    """Add ``hit_rank``, the rank of a hit among those of its ``ip`` by ascending time.

    An earlier ``hit_rank`` is replaced. Equal to ``rank() over (partition by ip order by hit_time_gmt)``: ties share a rank and
    hits without a time come first. The rank is a BIGINT: one visitor may have more hits
    than an INT can count.

    It is one more than the number of earlier hits, which is found from counts: hits are
    counted per visitor and second, the counts summed up in two steps (within a span of
    time, then over the spans), and the sums joined back. So no task ever needs all hits of
    a visitor; a skewed second in the last join is split by adaptive execution.
    """
    _ = own_names(hits)
    seconds = (
        hits.groupBy(F.col("ip").alias("ip"), F.col("hit_time_gmt").alias("time"))
        .agg(F.count(F.lit(1)).alias("hits"))
        .withColumn("span", F.shiftright("time", _SPAN_BITS))
    )
    within_span = (
        Window.partitionBy("ip", "span")
        .orderBy(F.col("time").asc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    over_spans = (
        Window.partitionBy("span_ip")
        .orderBy(F.col("span_of").asc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    spans = (
        seconds.groupBy(F.col("ip").alias("span_ip"), F.col("span").alias("span_of"))
        .agg(F.sum("hits").alias("span_hits"))
        .withColumn("earlier_spans", F.coalesce(F.sum("span_hits").over(over_spans), F.lit(0)))
    )
    ranks = (
        seconds.withColumn("earlier", F.coalesce(F.sum("hits").over(within_span), F.lit(0)))
        .join(
            spans,
            F.col("ip").eqNullSafe(F.col("span_ip")) & F.col("span").eqNullSafe(F.col("span_of")),
        )
        .select(
            F.col("ip").alias(_("ip")),
            F.col("time").alias(_("time")),
            (F.col("earlier_spans") + F.col("earlier") + 1).alias("hit_rank"),
        )
    )
    same = hits["ip"].eqNullSafe(F.col(_("ip"))) & hits["hit_time_gmt"].eqNullSafe(F.col(_("time")))
    columns = [hits[name] for name in hits.columns if name != "hit_rank"]
    return hits.join(ranks, same).select(*columns, ranks["hit_rank"])


def first_hits(hits: DataFrame) -> DataFrame:
    """The entry hits of every visitor: all hits at its earliest time.

    The earliest times, one row per visitor from a hash aggregate of two columns, are joined
    to the hits. A busy visitor is a skewed key of that join, which adaptive execution splits.
    """
    _ = own_names(hits)
    entries = hits.groupBy(F.col("ip").alias(_("ip"))).agg(F.min(ordered_time()).alias(_("entry")))
    same = F.col("ip").eqNullSafe(F.col(_("ip"))) & (ordered_time() == F.col(_("entry")))
    return hits.join(entries, same).select(*hits.columns)
